"""Importance resampling of documents towards a target's distribution of hashed n-grams.

A document's features are its runs of one and two words, and a feature counts in the bucket
of its checksum. How much likelier a bucket is in the target than in the corpus is
its gain; a document weighs the mean gain of its features, and a Gumbel number drawn from its id turns
the largest scores into a sample without replacement.

Features are interned block by block in an open-addressed table: xxhash64 of a feature's bytes picks
the place, the bytes are compared wherever keys meet, and a place has slots for a bucket
and a count. So a checksum is taken once for each different feature of a block, and the
places of all occurrences gather counts or gains. Texts are read as bytes in parts of
bounded size, so that a very long text needs no more memory than others.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import stored

BUCKETS = 10_000
PERCENT = 25
SEED = 7
LEAST_WORDS = 20
PART = 1 << 20  # bytes of text in a block, about
SHORT = 32  # bytes; xxhash64 mixes shorter inputs in one simple way

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# The five primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _crc_steps() -> np.ndarray:
    """What one byte does to a crc32, for every byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & np.uint32(1), (steps >> np.uint32(1)) ^ np.uint32(0xEDB88320), steps >> np.uint32(1))
    return steps


_CRC = _crc_steps()


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


class Spans:
    """Runs of bytes in one buffer, given by where they start and how long they are."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.starts, self.sizes = starts, sizes
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.bytes = memoryview(self.data)
        n = len(self.data)
        # Eight and four bytes from every place on.
        self.eight = np.ndarray(n - 7, "<u8", self.data, strides=(1,))
        self.four = np.ndarray(n - 3, "<u4", self.data, strides=(1,))

    def __getitem__(self, i: int) -> memoryview:
        return self.bytes[self.starts[i] : self.starts[i] + self.sizes[i]]

    def keys(self) -> np.ndarray:
        """xxhash64 of every run."""
        starts, sizes = self.starts, self.sizes
        h = _P5 + sizes.astype(np.uint64)
        for lane in range(SHORT // 8 - 1):
            at = np.flatnonzero((sizes >= 8 * lane + 8) & (sizes < SHORT))
            if not len(at):
                break
            mixed = _rotated(self.eight[starts[at] + 8 * lane] * _P2, 31) * _P1
            h[at] = _rotated(h[at] ^ mixed, 27) * _P1 + _P4
        done = sizes & ~7
        at = np.flatnonzero(((sizes & 4) > 0) & (sizes < SHORT))
        h[at] = _rotated(h[at] ^ (self.four[starts[at] + done[at]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        done = sizes & ~3
        for byte in range(3):
            at = np.flatnonzero(((sizes & 3) > byte) & (sizes < SHORT))
            h[at] = _rotated(h[at] ^ (self.data[starts[at] + done[at] + byte].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(sizes >= SHORT).tolist():
            h[i] = xxhash.xxh64_intdigest(self[i])
        return h

    def crc32(self, which: np.ndarray) -> np.ndarray:
        """Checksums of some runs, a byte of all of them at a time."""
        which = which[np.argsort(-self.sizes[which], kind="stable")]
        starts, sizes = self.starts[which], self.sizes[which]
        crc = np.full(len(which), 2**32 - 1, np.uint32)
        shorter = int(np.searchsorted(-sizes, -SHORT, side="right"))  # runs before it are long
        for byte in range(int(sizes[shorter]) if shorter < len(which) else 0):
            part = slice(shorter, int(np.searchsorted(-sizes, -byte)))
            crc[part] = (crc[part] >> np.uint32(8)) ^ _CRC[(crc[part] ^ self.data[starts[part] + byte]) & np.uint32(255)]
        crc = ~crc
        crc[:shorter] = [zlib.crc32(self[i]) for i in which[:shorter].tolist()]
        found = np.zeros(len(self.starts), np.uint32)
        found[which] = crc
        return found

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of runs ``a`` and ``b`` are the same, one by one."""
        sizes = self.sizes[a]
        equal = (sizes == self.sizes[b]) & (a != b)
        result = equal | (a == b)
        todo = np.flatnonzero(equal & (sizes < SHORT))
        for lane in range(SHORT // 8):
            todo = todo[sizes[todo] > 8 * lane]
            if not len(todo):
                break
            left = np.minimum(sizes[todo] - 8 * lane, 8).astype(np.uint64)
            mask = ~np.uint64(0) >> (np.uint64(64) - left * np.uint64(8))
            differ = (self.eight[self.starts[a[todo]] + 8 * lane] ^ self.eight[self.starts[b[todo]] + 8 * lane]) & mask
            result[todo[differ != 0]] = False
            todo = todo[differ == 0]
        for i in np.flatnonzero(equal & (sizes >= SHORT)).tolist():
            result[i] = self[a[i]] == self[b[i]]
        return result


class Interned:
    """The different runs of ``spans`` in an open-addressed table.

    ``place`` is the place of every run in the table; ``used`` are the places in use, and ``bucket`` and ``count`` the
    slots of every place.
    """

    def __init__(self, spans: Spans, buckets: int = BUCKETS, keys: np.ndarray | None = None):
        n = len(spans.starts)
        keys = spans.keys() if keys is None else keys
        size = 1 << max(4, (2 * n).bit_length())
        last = np.uint64(size - 1)
        owner = np.full(size, -1, np.int64)
        self.place = np.zeros(n, np.int64)
        todo, at = np.arange(n), (keys & last).astype(np.int64)
        while len(todo):
            free = owner[at] < 0
            owner[at[free]] = todo[free]  # of several runs at one place, one stays
            holder = owner[at]
            met = keys[holder] == keys[todo]
            met[met] = spans.same(holder[met], todo[met])
            self.place[todo[met]] = at[met]
            todo, at = todo[~met], (at[~met] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.place, minlength=size) if n else np.zeros(size, np.int64)
        self.bucket = np.zeros(size, np.int64)
        first = owner[self.used]
        self.bucket[self.used] = spans.crc32(first)[first] % buckets


@dataclass
class Features:
    """Features of a block: feature k belongs to text ``text[k]``; ``words`` counts new words by text."""

    spans: Spans
    text: np.ndarray
    words: np.ndarray


def _features(texts: list[bytes], carried: bool) -> tuple[Features, bytes]:
    """Features of lower-cased texts, and the last word.

    carried: the first word was counted before and only begins a pair here.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    word = _WORD[joined]
    after = np.append(False, word[:-1]) & ~word  # the byte behind a word
    keep = word | after
    data = np.where(word, joined, np.uint8(32))[keep]
    ends = np.flatnonzero(~word[keep])
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    sizes = ends - starts
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), np.flatnonzero(after), side="left")
    pair = np.flatnonzero(text[1:] == text[:-1])
    first = 1 if carried else 0
    spans = Spans(data, np.concatenate([starts[first:], starts[pair]]), np.concatenate([sizes[first:], ends[pair + 1] - starts[pair]]))
    words = np.bincount(text[first:], minlength=len(texts))
    last = data[starts[-1] : ends[-1]].tobytes() if len(ends) else b""
    return Features(spans, np.concatenate([text[first:], text[pair]]), words), last


def _blocks(texts: list[bytes | None], part: int) -> Iterator[tuple[int, Features]]:
    """Blocks of about ``part`` bytes: the number of the first text and the features.

    Short texts share a block; a long one is cut behind words and goes on with the word before the cut.
    """
    held: list[bytes] = []
    size = begin = 0
    for i, text in enumerate(texts):
        text = (text or b"").lower()
        if held and size + len(text) > part:
            yield begin, _features(held, False)[0]
            held, size = [], 0
        if not held:
            begin = i
        if len(text) <= part:
            held.append(text)
            size += len(text)
            continue
        codes = np.frombuffer(text, np.uint8)
        at, last = 0, b""
        while at < len(text):
            end = min(at + part, len(text))
            while end < len(text):  # not within a word
                stops = np.flatnonzero(~_WORD[codes[end : end + part]])
                end += int(stops[0]) if len(stops) else len(codes[end : end + part])
                if len(stops):
                    break
            found, newest = _features([last + b" " + text[at:end] if last else text[at:end]], bool(last))
            yield i, found
            at, last = end, newest or last
    if held:
        yield begin, _features(held, False)[0]


def _counted(buckets: int, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, features in _blocks(batch.column(0).to_pylist(), part):
                table = Interned(features.spans, buckets)
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, part: int = PART) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any; counted in every task first."""
    texts = docs.select(F.col(text_col).cast("string").cast("binary"))
    return texts.mapInArrow(_counted(buckets, part), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, from counts (bucket, n); at most ``buckets`` rows of each come to the driver."""

    def dense(counts: DataFrame) -> np.ndarray:
        found = np.zeros(buckets, np.int64)
        for bucket, n in counts.collect():
            found[bucket] = n
        return found

    s, t = dense(source), dense(target)
    whole, wanted = float(s.sum() + buckets), float(t.sum() + buckets)
    shares = (((y + 1.0) * whole) / ((x + 1.0) * wanted) for x, y in zip(s.tolist(), t.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(share)) for share in shares], np.int64)


def gumbel(seed: int, name: object) -> int:
    """A Gumbel number in thousandths that depends on ``seed`` and ``name`` only; a null name is an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, part: int = PART) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row of ``docs``."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, total = (np.zeros(n, np.int64) for _ in range(3))
            for begin, features in _blocks(batch.column(1).to_pylist(), part):
                table = Interned(features.spans, buckets)
                slots = np.zeros(len(table.count), np.int64)
                slots[table.used] = gains[table.bucket[table.used]]
                np.add.at(total, begin + features.text, slots[table.place])
                np.add.at(count, begin + features.text, 1)
                words[begin : begin + len(features.words)] += features.words
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            noise = np.fromiter((gumbel(seed, name) for name in batch.column(0).to_pylist()), np.int64, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, count, weight, weight + noise))], ["id", "n_words", "n_features", "weight", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (id, n_words, score, ...) with ``rank``: 1, 2, 3, ... of the rows drawn, null for others.

    Of the N rows with ``least_words`` words or more, the floor(percent * N / 100) highest scores are
    drawn, ties to smaller ids, null ids last; of equal rows any. Rows are sorted across the cluster and counted
    by task, so no task holds more than its range. ``scored`` should be stored: it is read twice.
    """
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("id")]
    ranged = scored.withColumn("_fit", F.col("n_words") >= least_words).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number of a row tells its task and its place there.
    placed = stored(ranged.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    task, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    before, fit = {}, 0
    for r in placed.groupBy(task.alias("task")).agg(F.count_if("_fit").alias("n")).orderBy("task").collect():
        before[r.task] = fit
        fit += r.n
    starts = scored.sparkSession.createDataFrame(list(before.items()), "task long, before long")
    rank = F.col("before") + place + 1
    drawn = F.col("_fit") & (rank <= percent * fit // 100)
    return placed.withColumn("task", task).join(F.broadcast(starts), "task").withColumn("rank", F.when(drawn, rank)).select(*scored.columns, "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every row of ``docs`` with id, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    Words are runs of 0-9, a-z and characters above ASCII once A-Z is lower-cased. Null and empty texts
    have no features and weigh 0. Repeated rows and ids are rows of their own; a null id draws
    the number of an empty name. An empty table gives an empty one, an empty target gains for rare buckets. Other columns of ``docs`` are not looked at.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets), buckets)
    scored = stored(weighed(docs, gains, id_col, text_col, seed), "weights")
    return draw(scored, percent, least_words).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
