"""A sandboxed template language, compiled to Python closures.

``{{ expression }}`` writes a value, ``{# ... #}`` is a comment, and ``{% ... %}`` holds ``for``/``endfor``,
``if``/``elif``/``else``/``endif`` and ``generation``/``endgeneration``, which mark what a model
should learn to write. A ``-`` inside a mark takes away the white space beside it. Expressions have
strings, integers, ``true``, ``false``, ``none``, names, ``a.b`` and ``a['b']`` on mappings, ``a[0]`` on
lists, ``== != in + and or not``, parentheses and filters ``a | name``. Inside a loop ``loop`` has ``index``, ``first`` and ``last``.
What is missing is none, none holds nothing, and what makes no sense, such as a loop over a number, is a ``TemplateError``. There are no calls, no attributes of Python objects and no names from outside, so a template
can only arrange what it is given. Constant parts are folded when it is compiled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

Env = dict[str, Any]


class TemplateError(ValueError):
    pass


class Sink:
    """Collects output and the spans under generation markers; ``pause`` is called after each turn of the outermost loop."""

    def __init__(self, pause: Callable[[Sink], None] | None = None):
        self.parts: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.size = 0
        self.pause = pause

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def drain(self) -> tuple[str, list[tuple[int, int]]]:
        """Output so far and its spans, forgotten afterwards."""
        text, spans = "".join(self.parts), self.spans
        self.parts, self.spans, self.size = [], [], 0
        return text, spans


# Syntax tree. ``value`` nodes are expressions, the others write output.


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Item:
    of: Any
    name: str


@dataclass
class At:
    of: Any
    key: Any


@dataclass
class Apply:
    work: str
    args: list[Any]


@dataclass
class Write:
    value: Any


@dataclass
class Loop:
    name: str
    over: Any
    body: list[Any]


@dataclass
class Branch:
    cases: list[tuple[Any, list[Any]]] = field(default_factory=list)


@dataclass
class Marked:
    body: list[Any]


_TOKEN = re.compile(r"""\s*(?:(?P<text>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[|.()+\[\]]))""")
_OPEN = re.compile(r"\{[{%#]")
_QUOTED = re.compile(r""""(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'""", re.S)
_CLOSE = {"{{": "}}", "{%": "%}", "{#": "#}"}
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}

_WORK: dict[str, Callable[..., Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: _text(a) + _text(b),
    "in": lambda a, b: _holds(b, a),
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def _text(value: Any) -> str:
    return "" if value is None else str(value)


def _holds(whole: Any, part: Any) -> bool:
    if whole is None or (part is None and isinstance(whole, str)):
        return False
    if isinstance(whole, str):
        return _text(part) in whole
    if isinstance(whole, (list, tuple, dict)):
        return part in whole
    raise TemplateError(f"nothing can be in {whole!r}")


def _at(owner: Any, key: Any) -> Any:
    if isinstance(owner, dict):
        return owner.get(key) if isinstance(key, (str, int)) else None
    if owner is None:
        return None
    if isinstance(owner, (list, tuple, str)) and isinstance(key, int):
        return owner[key] if -len(owner) <= key < len(owner) else None
    raise TemplateError(f"{owner!r} has no {key!r}")


def _things(value: Any) -> Iterable[Any]:
    if value is None:
        return ()
    if isinstance(value, (bool, int)):
        raise TemplateError(f"cannot go over {value!r}")
    return value


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """Plain text ("", text) and marks (their opening, what they hold) in order, white space beside a ``-`` gone."""
    at, trim = 0, False
    while True:
        found = _OPEN.search(source, at)
        plain = source[at : found.start() if found else len(source)]
        if trim:
            plain = plain.lstrip()
        if not found:
            yield "", plain
            return
        opening, end = found[0], found.end()
        close = _CLOSE[opening]
        while not source.startswith(close, end):
            if end >= len(source):
                raise TemplateError(f"{opening} is not closed")
            # A mark does not end inside a string.
            quoted = _QUOTED.match(source, end) if opening != "{#" else None
            end = quoted.end() if quoted else end + 1
        held = source[found.end() : end]
        yield "", plain.rstrip() if held.startswith("-") else plain
        trim = held.endswith("-") and len(held) > 0
        if opening != "{#":
            yield opening, held.removeprefix("-").removesuffix("-").strip()
        at = end + 2


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable[[str], str]]):
        self.tokens: list[tuple[str, str]] = []
        self.filters = filters
        at = 0
        source = source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def whole(self) -> Any:
        node = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def _take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _chain(self, below: Callable[[], Any], *signs: str) -> Any:
        node = below()
        while sign := self._take(*signs):
            node = Apply(sign, [node, below()])
        return node

    def _or(self) -> Any:
        return self._chain(self._and, "or")

    def _and(self) -> Any:
        return self._chain(self._not, "and")

    def _not(self) -> Any:
        return Apply("not", [self._not()]) if self._take("not") else self._compare()

    def _compare(self) -> Any:
        return self._chain(self._sum, "==", "!=", "in")

    def _sum(self) -> Any:
        return self._chain(self._filtered, "+")

    def _filtered(self) -> Any:
        node = self._atom()
        while sign := self._take("|", ".", "["):
            if sign == "[":
                node = At(node, self._or())
                if not self._take("]"):
                    raise TemplateError("missing ]")
                continue
            if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
                raise TemplateError(f"a name must follow {sign!r}")
            name = self.tokens[self.at][1]
            self.at += 1
            if sign == ".":
                node = Item(node, name)
            elif name in self.filters:
                node = Apply(name, [node])
            else:
                raise TemplateError(f"unknown filter {name!r}")
        return node

    def _atom(self) -> Any:
        if self._take("("):
            node = self._or()
            if not self._take(")"):
                raise TemplateError("missing )")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1]))
        if kind == "number":
            return Const(int(text))
        if kind == "name":
            return Const(_WORDS[text]) if text in _WORDS else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str, filters: Mapping[str, Callable[[str], str]]) -> list[Any]:
    """The syntax tree of a template."""
    root: list[Any] = []
    open_: list[tuple[str, Any]] = []
    body = root
    bodies = [root]

    def expression(text: str) -> Any:
        return _Expression(text, filters).whole()

    def descend(kind: str, node: Any, inner: list[Any]) -> None:
        open_.append((kind, node))
        bodies.append(inner)

    for opening, held in _pieces(source):
        body = bodies[-1]
        if not opening:
            if held:
                body.append(Write(Const(held)))
            continue
        if opening == "{{":
            body.append(Write(expression(held)))
            continue
        word, _, rest = held.partition(" ")
        if word == "for":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not found:
                raise TemplateError(f"cannot read for {rest!r}")
            node = Loop(found[1], expression(found[2]), [])
            body.append(node)
            descend("for", node, node.body)
        elif word == "generation":
            node = Marked([])
            body.append(node)
            descend("generation", node, node.body)
        elif word == "if":
            node = Branch([(expression(rest), [])])
            body.append(node)
            descend("if", node, node.cases[-1][1])
        elif word in ("elif", "else") and open_ and open_[-1][0] == "if":
            node = open_[-1][1]
            node.cases.append((expression(rest) if word == "elif" else Const(True), []))
            bodies[-1] = node.cases[-1][1]
        elif word in ("endfor", "endif", "endgeneration") and open_ and open_[-1][0] == word[3:]:
            open_.pop()
            bodies.pop()
        else:
            raise TemplateError(f"unexpected {{% {held} %}}")
    if open_:
        raise TemplateError(f"{open_[-1][0]} is not closed")
    return root


def fold(nodes: list[Any], filters: Mapping[str, Callable[[str], str]]) -> list[Any]:
    """The tree with constant expressions computed, dead branches gone and fixed texts joined."""

    def value(node: Any) -> Any:
        if isinstance(node, Item):
            return Item(value(node.of), node.name)
        if isinstance(node, At):
            of, key = value(node.of), value(node.key)
            return Const(_at(of.value, key.value)) if isinstance(of, Const) and isinstance(key, Const) else At(of, key)
        if isinstance(node, Apply):
            args = [value(a) for a in node.args]
            if all(isinstance(a, Const) for a in args):
                values = [a.value for a in args]
                return Const(filters[node.work](_text(*values)) if node.work in filters else _WORK[node.work](*values))
            return Apply(node.work, args)
        return node

    out: list[Any] = []

    def add(node: Any) -> None:
        before = out[-1] if out else None
        if all(isinstance(n, Write) and isinstance(n.value, Const) for n in (before, node)):
            out[-1] = Write(Const(_text(before.value.value) + _text(node.value.value)))
        else:
            out.append(node)

    for node in nodes:
        if isinstance(node, Write):
            add(Write(value(node.value)))
        elif isinstance(node, Loop):
            add(Loop(node.name, value(node.over), fold(node.body, filters)))
        elif isinstance(node, Marked):
            add(Marked(fold(node.body, filters)))
        else:
            cases = []
            for test, inner in ((value(t), fold(b, filters)) for t, b in node.cases):
                if isinstance(test, Const) and not test.value:
                    continue
                cases.append((test, inner))
                if isinstance(test, Const):
                    break
            if cases and isinstance(cases[0][0], Const):
                for inner in cases[0][1]:
                    add(inner)
            elif cases:
                add(Branch(cases))
    return out


def _evaluator(node: Any, filters: Mapping[str, Callable[[str], str]]) -> Callable[[Env], Any]:
    if isinstance(node, Const):
        fixed = node.value
        return lambda env: fixed
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Item):
        of, name = _evaluator(node.of, filters), node.name

        def item(env: Env) -> Any:
            owner = of(env)
            return owner.get(name) if isinstance(owner, dict) else None

        return item
    if isinstance(node, At):
        of, key = _evaluator(node.of, filters), _evaluator(node.key, filters)
        return lambda env: _at(of(env), key(env))
    args = [_evaluator(a, filters) for a in node.args]
    if node.work in filters:
        work, only = filters[node.work], args[0]
        return lambda env: work(_text(only(env)))
    if node.work == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.work == "or":
        return lambda env: args[0](env) or args[1](env)
    plain = _WORK[node.work]
    return lambda env: plain(*[a(env) for a in args])


_END = object()


def _parts_of(node: Any) -> Iterator[Any]:
    """A node and all below it."""
    yield node
    if isinstance(node, Branch):
        below = [x for test, body in node.cases for x in (test, *body)]
    elif isinstance(node, (Loop, Marked)):
        below = [*node.body, *([node.over] if isinstance(node, Loop) else [])]
    else:
        below = [node.of] if isinstance(node, Item) else [node.of, node.key] if isinstance(node, At) else node.args if isinstance(node, Apply) else [node.value] if isinstance(node, Write) else []
    for x in below:
        yield from _parts_of(x)


def _mentions(nodes: Iterable[Any], wanted: Callable[[Any], bool]) -> int:
    return sum(wanted(x) for node in nodes for x in _parts_of(node))


def _is_last(node: Any) -> bool:
    return isinstance(node, (Item, At)) and node.of == Name("loop") and (isinstance(node, At) or node.name == "last")


def _writer(nodes: list[Any], filters: Mapping[str, Callable[[str], str]], outer: bool) -> Callable[[Env, Sink], None]:
    steps: list[Callable[[Env, Sink], None]] = []
    for node in nodes:
        if isinstance(node, Write):
            if isinstance(node.value, Const):
                steps.append(lambda env, sink, text=_text(node.value.value): sink.write(text))
            else:
                steps.append(lambda env, sink, get=_evaluator(node.value, filters): sink.write(_text(get(env))))
        elif isinstance(node, Marked):

            def marked(env: Env, sink: Sink, body=_writer(node.body, filters, False)) -> None:
                start = sink.size
                body(env, sink)
                sink.spans.append((start, sink.size))

            steps.append(marked)
        elif isinstance(node, Branch):
            tests = [(_evaluator(t, filters), _writer(b, filters, outer)) for t, b in node.cases]

            def branch(env: Env, sink: Sink, tests=tests) -> None:
                for test, body in tests:
                    if test(env):
                        body(env, sink)
                        return

            steps.append(branch)
        else:

            def loop(env: Env, sink: Sink, name=node.name, ahead=_mentions(node.body, _is_last) > 0, over=_evaluator(node.over, filters), body=_writer(node.body, filters, False)) -> None:
                before = {k: env.get(k) for k in (name, "loop")}
                things = iter(_things(over(env)))
                i, thing = 0, next(things, _END)
                while thing is not _END:
                    # The next thing is only asked for early where the template wants to know.
                    after = next(things, _END) if ahead else None
                    env[name], env["loop"] = thing, {"index": i + 1, "first": i == 0, "last": after is _END if ahead else None}
                    body(env, sink)
                    if outer and sink.pause:
                        sink.pause(sink)
                    i, thing = i + 1, after if ahead else next(things, _END)
                env.update(before)

            steps.append(loop)

    def run(env: Env, sink: Sink) -> None:
        for step in steps:
            step(env, sink)

    return run


def compile_template(source: str, filters: Mapping[str, Callable[[str], str]]) -> Callable[[Iterable[dict], Sink], None]:
    """A function that renders messages (mappings) to a sink, one message at a time."""
    tree = fold(parse(source, filters), filters)
    run = _writer(tree, filters, True)
    # Messages are taken one at a time unless the template looks at them in another way than by one loop.
    loops = sum(isinstance(n, Loop) and n.over == Name("messages") for n in tree)
    held = _mentions(tree, lambda n: n == Name("messages")) != loops or loops > 1
    return lambda messages, sink: run({"messages": list(messages) if held else messages}, sink)
