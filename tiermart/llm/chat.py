"""Conversations as text for training, by a compiled template.

The template marks turns with control strings. Inside texts and roles those strings and the
backslash are escaped, so that a text that looks like a turn stays text and the output
can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tiermart.llm.template import Sink, compile_template

TEMPLATE = (
    "{% for message in messages %}### {{ message.role | guard }}: "
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | guard }}{% endgeneration %}"
    "{% else %}{{ message.text | guard }}{% endif %}</turn>\n{% endfor %}"
)
HELD = 1 << 20  # characters of a conversation rendered before they are handed on

_GUARD = re.compile(r"\\|###|:|</turn>")
_FREE = re.compile(r"\\(\\|###|:|</turn>)")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def guard(text: str) -> str:
    """``text`` with a backslash before control strings, colons and backslashes."""
    return _GUARD.sub(lambda m: "\\" + m[0], text)


def free(text: str) -> str:
    """What ``guard`` was given."""
    return _FREE.sub(lambda m: m[1], text)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn in a formatted piece of whole turns."""
    at = 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        yield free(found[1]), free(found[2])
        at = found.end()


def _conversations(batches: Iterator[pa.RecordBatch], id_name: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Conversations of rows sorted by id; the messages of each are read as they are used."""
    rows = (
        row
        for batch in batches
        for row in zip(*(batch.column(c).to_pylist() for c in (id_name, "role", "text")), strict=True)
    )
    ahead = next(rows, None)

    def messages(own: object) -> Iterator[dict]:
        nonlocal ahead
        while ahead is not None and ahead[0] == own:
            now, ahead = ahead, None
            ahead = next(rows, None)
            yield {"role": now[1] or "", "text": now[2] or ""}

    while ahead is not None:
        mine = messages(ahead[0])
        yield ahead[0], mine
        for _ in mine:  # whatever the template did not ask for
            pass


def _sorted(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Conversations whole and in order; rows of the same turn by role and text."""
    chosen = rows.select(F.col(id_col).alias("conversation"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chosen.repartition(parts, "conversation").sortWithinPartitions("conversation", "turn", "role", "text")


def format_chats(rows: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per piece of a conversation: the id, ``piece``, ``formatted`` and ``loss_spans``.

    A piece holds whole turns, about a million characters at most; nearly all conversations
    are one piece. Spans are [start, end) in code points of the piece. Null roles and texts
    are empty, rows of a null id form one conversation, and repeated rows are turns of their own.
    """
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"guard": guard})
        for own, messages in _conversations(batches, "conversation"):
            pieces: list[tuple[str, list[tuple[int, int]]]] = []
            sink = Sink(lambda s, pieces=pieces: pieces.append(s.drain()) if s.size >= HELD else None)
            render(messages, sink)
            if sink.size or not pieces:
                pieces.append(sink.drain())
            for i, (text, spans) in enumerate(pieces):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own], kind), pa.array([i]), pa.array([text]), pa.array([[list(s) for s in spans]], pa.list_(pa.list_(pa.int64())))],
                    [id_col, "piece", "formatted", "loss_spans"],
                )

    kind = to_arrow_type(rows.schema[id_col].dataType)
    ordered = _sorted(rows, id_col, turn_col, role_col, text_col)
    return ordered.mapInArrow(run, f"`{id_col}` {id_type}, piece long, formatted string, loss_spans array<array<long>>")


class _Digest:
    """Sums and digests of a conversation, read back from its formatted pieces."""

    def __init__(self) -> None:
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[tuple[int, int]]) -> None:
        self.formatted_chars += len(formatted)
        for role, text in turns(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for a, b in spans:
            text = free(formatted[a:b])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))


def chat_digests(rows: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation, read back from what ``format_chats`` would give.

    Conversations are streamed in order of turns: a very long one is never held whole, since its
    digests are taken piece by piece.
    """
    kind = to_arrow_type(rows.schema[id_col].dataType)
    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"guard": guard})
        found: list[tuple] = []

        def rows_of() -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for own, messages in _conversations(batches, "conversation"):
            digest = _Digest()
            sink = Sink(lambda s, digest=digest: digest.add(*s.drain()) if s.size >= HELD else None)
            render(messages, sink)
            digest.add(*sink.drain())
            found.append((own, digest.n_turns, digest.turns.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.formatted_chars))
            if len(found) == 5000:
                yield rows_of()
                found.clear()
        if found:
            yield rows_of()

    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _sorted(rows, id_col, turn_col, role_col, text_col).mapInArrow(run, schema)
