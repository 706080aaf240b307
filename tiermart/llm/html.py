"""Main text of web pages by a maximum-scoring stretch of words and tags.

A page is a sequence of tags and text runs. Each has a score, the log odds of lying
inside the article, learned by kind of element and the section it lies in; words inside
articles score positive, tags and the words of menus negative. Parts of names such as
``site-footer`` make sections of their own, so that their scores are learned. One linear scan finds the
contiguous stretch with the largest sum. Labelled pages are those whose markup says where
the article is; they teach the scores for all pages. Within the stretch, elements
that never hold article text are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 2000  # labelled pages at most, in the mean
TAG_COST = 0.5
WORD = 0.5  # of a word whose surroundings no labelled page has

# Kinds of elements, by the HTML standard or by common use.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
SECTIONS = frozenset("article aside body dialog footer form head header main nav section".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript iframe template xmp title".split())
NEVER = frozenset("script style textarea noscript iframe template title head nav aside footer form button select svg math object canvas audio video dialog menu search".split())
NEVER_NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies disqus "
    "footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related reply replies share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
LABELS = ("article", "main")
WHOLE = frozenset(["html", "body", *LABELS])  # names do not matter here
CLOSED_BY = {
    "p": BLOCKS - frozenset("body html head title option".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}

#: Open elements that a new element of a name closes.
CLOSES = {name: [k for k, by in CLOSED_BY.items() if name in by] for name in frozenset().union(*CLOSED_BY.values())}

_SPECIAL = re.compile("[>\"']")
_NAME_END = re.compile(r"[\s/>]")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass
class Part:
    """A tag or a run of text: its kind for scoring, words, text, block number, and flags."""

    kind: str
    words: int
    text: str
    block: int
    inside: bool  # of an element that the markup labels as the article
    never: bool


def _hidden(name: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether an element never holds article text by its kind or state, or by its whole names, and a telling part of a name."""
    if name in NEVER:
        return True, False, ""
    named, part = False, ""
    for found in _ATTRIBUTE.finditer(attributes) if attributes else ():
        key, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
        if key == "hidden":
            return True, False, ""
        if key == "role":
            if value.strip() in NEVER_ROLES:
                return True, False, ""
        elif key in ("class", "id") and name not in WHOLE:
            named = named or not NEVER_NAMED.isdisjoint(value.split())
            part = part or next((x for x in re.split(r"[\s_-]+", value) if x in NEVER_NAMED), "")
    return False, named, part


class _Tags:
    """Finds the tags of a page from left to right.

    Every place is looked at a bounded number of times, however many tags have no end: what was found
    behind a quote, and that nothing follows, is remembered.
    """

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[int, int] = {}  # of a tag in which a quote begins here
        self.none = {'"': len(page), "'": len(page)}  # from here on no such quote follows
        self.special = (0, -1)  # from the first place to the second there is no special character
        self.name_end = (0, -1)

    def _next(self, pattern: re.Pattern, known: tuple[int, int], at: int) -> tuple[int, int]:
        if known[0] <= at <= known[1]:
            return known
        found = pattern.search(self.page, at)
        return at, found.start() if found else len(self.page)

    def _end(self, at: int) -> int:
        """The place of the mark that ends a tag whose attributes begin at ``at``; -1 without one."""
        page, seen = self.page, []
        self.special = self._next(_SPECIAL, self.special, at)
        at = self.special[1]
        while True:
            if at in self.ends:
                end = self.ends[at]
                break
            if at >= len(page) or page[at] == ">":
                end = at if at < len(page) else -1
                break
            seen.append(at)
            quote = page[at]
            close = page.find(quote, at + 1) if at < self.none[quote] else -1
            if close < 0:
                self.none[quote] = min(self.none[quote], at)
                end = -1
                break
            at = self._next(_SPECIAL, (0, -1), close + 1)[1]
        for place in seen:
            self.ends[place] = end
        return end

    def find(self, scan: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name, whether it closes, and attributes of the next tag; comments and declarations have no name."""
        page = self.page
        while (begin := page.find("<", scan)) >= 0:
            scan = begin + 1
            if page.startswith("<!--", begin):
                stop = page.find("-->", begin + 4)
                return begin, stop + 3 if stop >= 0 else len(page), "", False, ""
            closing = page.startswith("/", begin + 1)
            at = begin + 1 + closing
            if page[at : at + 1].isascii() and page[at : at + 1].isalpha():
                self.name_end = self._next(_NAME_END, self.name_end, at)
                stop = self.name_end[1]
                end = self._end(stop)
                if end >= 0:
                    return begin, end + 1, page[at:stop].lower(), closing, page[stop:end]
            if page[begin + 1 : begin + 2] in ("!", "?", "/"):
                stop = page.find(">", begin + 2)
                return begin, stop + 1 if stop >= 0 else len(page), "", False, ""
        return None


@dataclass(slots=True)
class _Article:
    """An element that the markup labels: the places of elements around it that names drop, linked, its words, and the next one around it."""

    around: tuple | None
    words: int
    outer: _Article | None


@dataclass(slots=True)
class _Open:
    """An open element with what its place in the page means for the text in it."""

    name: str
    never: bool
    labelled: bool
    around: tuple | None
    section: str
    part: str
    holder: str
    article: _Article | None
    barrier: int  # number of the innermost open element that others do not close

    def kind(self) -> str:
        return f"{self.section}.{self.part}" if self.part else self.section


_OUTSIDE = _Open("", False, False, None, "", "", "", None, -1)


def parts(page: str) -> list[Part]:
    """Tags and text runs of a page in order. Unclosed and misplaced tags do no harm.

    Names do not drop an element around the article of most words (without any, the ``main``).
    """
    out, labelled = _parts(page, frozenset())
    for label in LABELS:
        if labelled[label]:
            around, places = max(labelled[label], key=lambda x: x.words).around, set()
            while around:
                places.add(around[0])
                around = around[1]
            return _parts(page, frozenset(places))[0] if places else out
    return out


def _parts(page: str, spared: frozenset[int]) -> tuple[list[Part], dict[str, list[_Article]]]:
    """Parts of a page, and its labelled elements by name.

    Elements are numbered by the place of their tag; names do not drop those in ``spared``. The time is linear in
    the page: an element knows its section and holder, and open elements are found by name.
    """
    out: list[Part] = []
    stack: list[_Open] = []
    places: dict[str, list[int]] = {}  # of the open elements of a name
    labelled: dict[str, list[_Article]] = {label: [] for label in LABELS}
    articles: list[_Article] = []
    tags = _Tags(page)
    top = _OUTSIDE
    block = 0
    at = 0

    def text(until: int) -> None:
        nonlocal at
        if until > at:
            run = html.unescape(page[at:until])
            words = len(run.split())
            if top.article:
                top.article.words += words
            out.append(Part(f"{top.kind()}/{top.holder}", words, run, block, top.labelled, top.never))
        at = until

    def close(depth: int) -> None:
        nonlocal top
        while len(stack) > depth:
            places[stack.pop().name].pop()
        top = stack[-1] if stack else _OUTSIDE

    scan = 0
    while found := tags.find(scan):
        start, scan, name, closing, attributes = found
        text(start)
        at = scan
        if not name:
            continue
        block += name in BLOCKS
        if name == "br":
            out.append(Part("br", 0, "\n", block, top.labelled, top.never))
            continue
        if closing:
            if places.get(name):
                close(places[name][-1])
        else:
            # The innermost one that this element closes, unless another block lies between.
            closed = max((places[k][-1] for k in CLOSES.get(name, ()) if places.get(k)), default=-1)
            if closed > top.barrier:
                close(closed)
        if not closing and name not in VOID:
            gone, named, part = _hidden(name, attributes)
            named = named and start not in spared
            around = (start, top.around) if named else top.around
            article = top.article
            # An element that stays dropped for another reason holds no article.
            if name in LABELS and not gone and (not top.never or around):
                article = _Article(around, 0, top.article)
                articles.append(article)
                labelled[name].append(article)
            section = name in SECTIONS
            barrier = len(stack) if name in BLOCKS and name not in CLOSED_BY else top.barrier
            places.setdefault(name, []).append(len(stack))
            top = _Open(
                name, top.never or gone or named, top.labelled or name in LABELS, around, name if section else top.section,
                part if section else part or top.part, name if name in BLOCKS else top.holder, article, barrier,
            )
            stack.append(top)
        out.append(Part(f"{top.kind()}/{'end ' if closing else ''}{name}", 0, "", block, top.labelled, top.never))
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}[\s>/]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if name == "title":
                text(stop)
            scan = at = stop
    text(len(page))
    for article in reversed(articles):
        if article.outer:
            article.outer.words += article.words
    return out, labelled


def _odds(inside: float, outside: float, all_inside: float, all_outside: float) -> float:
    return math.log((inside + 1) / (all_inside + 2)) - math.log((outside + 1) / (all_outside + 2))


def _kinds(kind: str, alone: bool = False) -> Iterator[str]:
    """A kind and what stands for it if it was not learned: maybe its section alone, then both without the part of a name."""
    section, slash, holder = kind.partition("/")
    plain = section.partition(".")[0]
    for s in (section, plain) if plain != section else (section,):
        yield s + slash + holder
        if alone:
            yield s


@dataclass
class Model:
    """Scores of tags and of words by their section of the page and the element; of words also by section alone."""

    tags: dict[str, float]
    words: dict[str, float]

    def score(self, part: Part) -> float:
        if part.text and not part.words:
            return 0.0
        if not part.words:
            if part.never:
                return -TAG_COST
            return next((self.tags[k] for k in _kinds(part.kind) if k in self.tags), -TAG_COST)
        if part.never:
            return -part.words * WORD
        return part.words * next((self.words[k] for k in _kinds(part.kind, alone=True) if k in self.words), WORD)

    def extract(self, page: str | None) -> str:
        """The main text: blocks in page order joined by line feeds; empty without one."""
        found = parts(page or "")
        best, best_range, now, begin = 0.0, (0, 0), 0.0, 0
        for i, part in enumerate(found):
            if now <= 0:
                now, begin = 0.0, i
            now += self.score(part)
            if now > best:
                best, best_range = now, (begin, i + 1)
        blocks: dict[int, list[str]] = {}
        for part in found[best_range[0] : best_range[1]]:
            if part.text and not part.never:
                blocks.setdefault(part.block, []).append(part.text)
        lines = (" ".join("".join(texts).split()) for texts in blocks.values())
        return "\n".join(line for line in lines if line)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, seed: int = 3) -> Model:
    """Scores from pages whose markup names an article, about ``sample`` of them.

    Pages are chosen by a hash of their ids. Without such pages every word scores the same
    positive value and every tag the same negative one.
    """
    labelled = pages.filter(F.lower(html_col).rlike(r"<(article|main)[\s>]")).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    n = labelled.count()
    scale = 1 << 20
    bar = min(scale, int(scale * sample / max(n, 1)) + 1)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                for part in parts(page):
                    good = part.inside and not part.never
                    if part.words:
                        found["word", part.kind, good] += part.words
                        found["word", part.kind.partition("/")[0], good] += part.words
                    elif not part.text:
                        found["tag", part.kind, good] += 1
        rows = [(*k, v) for k, v in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.int64())], ["sort", "kind", "inside", "n"])

    chosen = labelled.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(scale)) < bar)
    rows = chosen.mapInArrow(counts, "sort string, kind string, inside boolean, n long").groupBy("sort", "kind", "inside").agg(F.sum("n").alias("n")).collect()
    both: dict[str, dict[str, list[int]]] = {"word": {}, "tag": {}}
    for r in rows:
        both[r.sort].setdefault(r.kind, [0, 0])[not r.inside] += r.n
    scores = {}
    for sort, kinds in both.items():
        totals = np.array(list(kinds.values()) or [[0, 0]]).sum(0)
        # Tags only ever cost; what an article's words gain comes from what holds them.
        scores[sort] = {k: float(np.clip(_odds(a, b, *totals), -3, 3)) for k, (a, b) in kinds.items()}
    return Model({k: min(v, 0.0) - TAG_COST for k, v in scores["tag"].items()}, scores["word"])


def extract(pages: DataFrame, model: Model, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out_col``, which replaces a column of that name.

    A null page gives an empty text. No page is cut or dropped.
    """
    pages = pages.drop(out_col)
    place = pages.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([model.extract(page) for page in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out_col])

    schema = T.StructType([*pages.schema.fields]).add(out_col, T.StringType())
    return pages.mapInArrow(run, schema)
