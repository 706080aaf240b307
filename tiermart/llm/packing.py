"""Best-fit packing of token pieces into sequences, in rounds.

Pieces are dealt to groups of bounded size. Every group packs its own, largest first, each
into the fullest bin that still has room. Bins that are nearly full are done. The others go on as single items
into fewer, larger groups, where they are packed again, until one group is left or a
round no longer joins anything. A round's group is bounded in items, and only
bin sizes move between rounds, never texts.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm import words as W
from tiermart.llm.common import give_back, stored

CAPACITY = 2048
SLACK = 8
GROUP = 20_000
LOCAL = 200_000
WORDS_HELD = 60_000
SEPARATOR = 0


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids of texts by a byte-level tokenizer file; words seen before are looked up.

    Words of the last two generations are held, at most ``WORDS_HELD`` in each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        split = kind["pre_tokenizer"] or {}
        if kind["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("a byte-level tokenizer without a normalizer is needed")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = _byte_alphabet()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            tokens = self.tokenizer.model.tokenize(word.encode("utf-8", "replace").decode("latin-1").translate(self.alphabet))
            found = array("I", [t.id for t in tokens]).tobytes()
        self.young[word] = found
        return found

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Special strings inside a text get their own ids."""
        odd = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        cut = W.cut(["" if i in odd else t for i, t in enumerate(texts)])
        if len(self.young) > WORDS_HELD:
            self.old, self.young = self.young, {}
        young = self.young
        coded = [young.get(w) or self._word(w) for w in cut.unique]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ids, counts = W.gather(np.frombuffer(b"".join(coded), np.uint32), bounds, cut.inverse)
        ends = np.concatenate([[0], np.cumsum(counts)])[cut.offsets]
        found = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in odd:
            found[i] = np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return found


@cache
def word_ids(path: str) -> WordIds:
    """One for each Python worker, so that its words serve all its tasks."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document: a document's ids, then the separator id.

    Only a document longer than ``capacity`` is cut, so that all pieces but the first
    are full. Columns: row id ``piece_key``, the id, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, if asked for, the ``ids``. A null text counts as empty and gives
    one piece with the separator only.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_path)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in W.chunks(texts):
                rows, part, start, length, crc, kept = [], [], [], [], [], []
                for i, ids in enumerate(encode(texts[a:b]), a):
                    ids = np.append(ids, np.uint32(SEPARATOR)).astype("<u4")
                    left = len(ids) % capacity or capacity
                    edges = [0, *range(left, len(ids) + 1, capacity)]
                    for p, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        rows.append(i)
                        part.append(p)
                        start.append(x)
                        length.append(y - x)
                        crc.append(zlib.crc32(ids[x:y]))
                        if keep_ids:
                            kept.append(ids[x:y].astype(np.int32))
                keys = pa.array(np.arange(key, key + len(rows)))
                key += len(rows)
                columns = [keys, batch.column(0).take(pa.array(rows, pa.int64())), pa.array(part, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["piece_key", id_col, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
            give_back()

    schema = f"piece_key long, `{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(cut, schema + (", ids array<int>" if keep_ids else ""))


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item and the fill of each bin, largest items first."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: a bin has r places left
    bins, offsets, fills = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            room, at = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = at, fills[at]
        fills[at] += size
        if room > size:
            rooms[room - size].append(at)
            open_rooms |= 1 << (room - size)
    return bins, offsets, np.asarray(fills, np.int64)


def _packed(items: DataFrame, capacity: int, level: int) -> DataFrame:
    """Items (key, length) of each partition with their bin, offset and the bin's fill."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = (level << 56) | (TaskContext.get().partitionId() << 32)
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal name
            both = pa.Table.from_batches(held).sort_by("key")
            bins, offsets, fills = best_fit(both["length"].to_numpy(), capacity)
            columns = [both["key"].to_numpy(), bins + name, offsets, fills[bins]]
            name += len(fills)
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "bin", "offset", "fill"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= LOCAL:
                yield from done()
        if held and any(b.num_rows for b in held):
            yield from done()

    return items.mapInArrow(pack, "key long, bin long, offset long, fill long")


def assign(items: DataFrame, key_col: str, length_col: str, capacity: int = CAPACITY, slack: int = SLACK, group: int = GROUP) -> DataFrame:
    """Sequence of every item: ``key_col``, ``sequence_id``, ``offset``.

    Keys are unique longs and lengths lie between 1 and ``capacity``. ``items`` should be
    a stored table: it is read again for the result, and its keys must not change.
    """
    level = 1
    narrow = items.select(F.col(key_col).alias("key"), F.col(length_col).alias("length"))
    groups = max(1, -(-items.count() // group))
    placed = stored(_packed(narrow.repartition(groups, F.xxhash64("key")), capacity, level), "pack")
    bins = placed.filter("offset = 0").select("bin", "fill")
    moves = None  # bin of the first round -> its bin now and its offset there
    under = bins.filter(F.col("fill") < capacity - slack)
    left = under.count()
    while left > 1:
        level += 1
        parts = -(-left // group)
        dealt = under.select(F.col("bin").alias("key"), F.col("fill").alias("length")).repartition(parts, F.xxhash64("key"))
        merged = stored(_packed(dealt, capacity, level), "pack")
        step = merged.select(F.col("key").alias("child"), F.col("bin").alias("to"), F.col("offset").alias("by"))
        if moves is None:
            moves = step.select(F.col("child").alias("bin"), "to", "by")
        else:
            # Bins that were done stay where they are.
            further = step.select("child", F.col("to").alias("next"), F.col("by").alias("more"))
            moves = moves.join(further, F.col("to") == F.col("child"), "left").select(
                "bin", F.coalesce("next", "to").alias("to"), (F.col("by") + F.coalesce("more", F.lit(0))).alias("by")
            )
        moves = stored(moves, "pack")
        bins_now = merged.filter("offset = 0").select("bin", "fill")
        now, least = bins_now.agg(F.count("bin"), F.min("fill")).first()
        if parts == 1 or now == left:
            break
        # Bins that not even the emptiest one fits into are done too.
        under = bins_now.filter((F.col("fill") < capacity - slack) & (F.col("fill") <= capacity - least))
        left = under.count()
    if moves is None:
        return placed.select(F.col("key").alias(key_col), F.col("bin").alias("sequence_id"), "offset")
    return placed.join(moves, "bin", "left").select(
        F.col("key").alias(key_col),
        F.coalesce("to", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with ``sequence_id`` and ``offset``.

    Sequences have no gaps. Repeated rows and ids are packed as often as they occur; an
    empty table gives no pieces. Other columns of ``docs`` are not looked at.
    """
    cut = stored(pieces(docs, tokenizer_path, id_col, text_col, capacity), "pieces")
    return cut.join(assign(cut, "piece_key", "length", capacity), "piece_key").drop("piece_key")
