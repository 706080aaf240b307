"""Document fingerprints by prefix polynomial hashes.

A prefix array holds, for every place of a text, the hash of all code points before it: a
polynomial in a fixed base, modulo two primes. The hash of any span is the difference of two
entries, moved to the origin by a power of the base's inverse; so equal spans are
found without looking at them, and the longest common extension of two places by
binary search. Long texts are taken in slices whose hashes combine, so that the arrays
stay bounded.

A fingerprint is the length, the hash of the whole text, and a sketch of its windows: window
hashes fall into ``BINS`` bins, and a bin keeps the low bits of its least one. The share of equal
bins estimates how many windows two texts have in common.

Neighbours in the order of ids are found without one global window: ids are
cut into slots by sampled splitters, rows move once to their slot and are sorted there, and a copy of a
slot's first row closes the slot before it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import stored

# Two primes below 2^31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1048583019, 716290441)

WINDOW = 24  # code points
BINS = 64
SLICE = 1 << 17
OVERSAMPLE = 16
REPEATED = 4096  # equal rows written out together


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@cache
def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo ``prime``; n is a power of two."""
    found = np.ones(1, np.uint64)
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), prime)) % np.uint64(prime)])
    return found


class Prefixes:
    """Prefix hashes of a bounded stretch of code points, one array for each prime."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        room = 1 << max(8, self.n.bit_length())
        self.sums, self.back = [], []
        for base, prime in zip(BASES, PRIMES, strict=True):
            terms = (codes.astype(np.uint64) + np.uint64(1)) * _powers(base, prime, room)[: self.n] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % np.uint64(prime)]))
            self.back.append(_powers(pow(base, -1, prime), prime, room))

    def windows(self, size: int) -> np.ndarray:
        """64 bits for every window of ``size`` code points, equal for equal windows wherever they are."""
        n = max(self.n - size + 1, 0)
        parts = []
        for sums, back, prime in zip(self.sums, self.back, PRIMES, strict=True):
            parts.append((sums[size : size + n] + np.uint64(prime) - sums[:n]) % np.uint64(prime) * back[:n] % np.uint64(prime))
        return parts[0] << np.uint64(32) | parts[1]


class Text:
    """Any span of a text: the prefix hash at every slice, and the arrays of the two slices last used.

    A slice's array goes on for a window less one place, so that every window lies in one array.
    """

    def __init__(self, codes: np.ndarray, window: int = WINDOW, slice_size: int = SLICE):
        self.codes, self.window, self.step = codes, window, slice_size
        self.open: dict[int, Prefixes] = {}
        self.marks: list[tuple[int, ...]] = [(0,) * len(PRIMES)]
        self.shifts: list[tuple[int, ...]] = []
        for k in range(-(-len(codes) // slice_size)):
            self.shifts.append(tuple(pow(b, k * slice_size, p) for b, p in zip(BASES, PRIMES, strict=True)))
            self.marks.append(self._within(k, min(slice_size, len(codes) - k * slice_size)))

    def __len__(self) -> int:
        return len(self.codes)

    def slice(self, k: int) -> Prefixes:
        found = self.open.get(k)
        if found is None:
            if len(self.open) > 1:
                self.open.pop(next(iter(self.open)))
            found = self.open[k] = Prefixes(self.codes[k * self.step : (k + 1) * self.step + self.window - 1])
        return found

    def _within(self, k: int, place: int) -> tuple[int, ...]:
        part = self.slice(k)
        return tuple((mark + int(sums[place]) * shift) % p for mark, sums, shift, p in zip(self.marks[k], part.sums, self.shifts[k], PRIMES, strict=True))

    def prefix(self, end: int) -> tuple[int, ...]:
        """The hash of the first ``end`` code points, modulo each prime."""
        k, place = divmod(end, self.step)
        return self._within(k, place) if place else self.marks[k]

    def span(self, begin: int, end: int) -> tuple[int, ...]:
        """The hash of [begin, end), the same for equal spans of any text."""
        both = zip(self.prefix(end), self.prefix(begin), BASES, PRIMES, strict=True)
        return tuple((x - y) * pow(b, -begin, p) % p for x, y, b, p in both)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Text) and len(self) == len(other) and self.marks[-1] == other.marks[-1]

    __hash__ = None


def common_extension(a: Text, b: Text, i: int = 0, j: int = 0) -> int:
    """How many code points from place i of ``a`` and place j of ``b`` on are equal, by binary search over span hashes."""
    if i > j:
        return common_extension(b, a, j, i)
    moved = [pow(base, j - i, p) for base, p in zip(BASES, PRIMES, strict=True)]
    low, high = 0, min(len(a) - i, len(b) - j)
    x, y = a.prefix(i), b.prefix(j)  # what lies before ``low`` is known to be equal
    while low < high:
        middle = (low + high + 1) // 2
        u, v = a.prefix(i + middle), b.prefix(j + middle)
        if all(((e - d) * m - (g - f)) % p == 0 for d, e, f, g, m, p in zip(x, u, y, v, moved, PRIMES, strict=True)):
            low, x, y = middle, u, v
        else:
            high = middle - 1
    return low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: Text) -> str:
    """Length, hash of the whole text and four hex digits for every bin, ``-`` for bins without a window.

    A text shorter than a window is one window; the empty text has none.
    """
    n = len(text)
    top = np.iinfo(np.uint64).max
    least = np.full(BINS, top, np.uint64)
    high, low = text.marks[-1]
    for k in range(len(text.shifts)):
        found = text.slice(k).windows(text.window) if n >= text.window else np.array([high << 32 | low], np.uint64)
        if len(found):
            # The bin is the highest bits, so that sorted hashes begin each bin with its least.
            mixed = np.sort(_mixed(found))
            bins = (mixed >> np.uint64(58)).astype(np.int64)
            first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
            least[bins[first]] = np.minimum(least[bins[first]], mixed[first])
    bits = "".join("----" if x == top else f"{x & 0xFFFF:04x}" for x in least.tolist())
    return f"{n}:{high:08x}{low:08x}:{bits}"


def likeness(one: str, two: str) -> float:
    """0 to 1: about the share of two texts' windows that they have in common, by their fingerprints alone."""
    a, b = one.split(":"), two.split(":")
    if a[:2] == b[:2]:
        return 1.0
    equal = used = 0
    for k in range(0, 4 * BINS, 4):
        x, y = a[2][k : k + 4], b[2][k : k + 4]
        if x != "----" or y != "----":
            used += 1
            equal += x == y
    # A share of equal / used of all different windows is common: so much of both texts' windows together.
    return 2 * equal / (used + equal) if used else 0.0


def _splitters(keys: DataFrame, slots: int) -> list[str]:
    """Values of ``key`` that cut the rows into about ``slots`` equal parts, from ``OVERSAMPLE`` sampled rows for each."""
    n = keys.count()
    share = min(1.0, slots * OVERSAMPLE / max(n, 1))
    sampled = sorted(r[0] for r in keys.select("key").sample(share, seed=17).toLocalIterator()) if n and slots > 1 else []
    return [sampled[i * len(sampled) // slots] for i in range(1, slots)] if sampled else []


def _place(key: Column, splitters: list[str]) -> Column:
    """How many different splitters lie below ``key``, by halving."""
    edges = sorted(set(splitters))
    if not edges:
        return F.lit(0)
    known = F.from_json(F.lit(json.dumps(edges)), "array<string>")

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state.low + state.high) / 2).cast("int")
        left, open_ = F.get(known, middle) < key, state.low < state.high
        return F.struct(F.when(open_ & left, middle + 1).otherwise(state.low).alias("low"), F.when(open_ & ~left, middle).otherwise(state.high).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(len(edges)).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(edges).bit_length())), start, halve, lambda s: s.low)


def with_next(docs: DataFrame, prepare, use, kinds: dict[str, pa.DataType], id_col: str = "doc_id", text_col: str = "text", slots: int | None = None) -> DataFrame:
    """``use(id, this, following)`` of every row, both being what ``prepare`` makes of a text, in descending order of ids.

    Null ids are last, and behind the last row comes the first. Rows that repeat an id are ordered by a hash of
    their text. Rows of a key that holds several slots' share of all rows are equal; they travel as
    one row with a count, and are written out in blocks. A null text is an empty one.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = slots or 4 * parts
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.col(id_col).cast("long")
    # Digits that sort like descending ids, null last, and then by text.
    downward = F.lpad(F.hex(number.bitwiseXOR(F.lit(2**63 - 1))), 16, "0")
    key = F.concat(F.coalesce(downward, F.lit("~")), F.hex(F.xxhash64(text)))
    rows = docs.select(key.alias("key"), number.alias("id"), text.alias("text"))

    keys = stored(rows.select("key"), "keys")
    splitters = _splitters(keys, slots)
    hot = sorted({s for s, t in zip(splitters, splitters[1:], strict=False) if s == t})
    slot = _place(F.col("key"), splitters)
    first = {r.slot: r.key for r in keys.groupBy(slot.alias("slot")).agg(F.min("key").alias("key")).collect()}
    order = sorted(first)
    # The first row of each slot in use also closes the slot before it.
    wanted = spark.createDataFrame([(first[s], order[i - 1]) for i, s in enumerate(order)], "key string, slot int")
    closing = rows.join(F.broadcast(wanted), "key").groupBy("slot").agg(F.first("text").alias("text"))
    closing = closing.select("slot", F.lit("~~").alias("key"), F.lit(0).cast("long").alias("times"), F.lit(None).cast("long").alias("id"), "text")
    columns = ["key", "times", "id", "text"]
    single = rows.withColumn("times", F.lit(1).cast("long")).select(*columns)
    if hot:
        is_hot = F.array_contains(F.from_json(F.lit(json.dumps(hot)), "array<string>"), F.col("key"))
        folded = rows.filter(is_hot).groupBy("key").agg(F.count("key").alias("times"), F.first("id").alias("id"), F.first("text").alias("text"))
        single = single.filter(~is_hot).unionByName(folded.select(*columns))
    whole = single.select(slot.alias("slot"), *columns).unionByName(closing)
    dealt = whole.repartitionById(parts, F.pmod("slot", F.lit(parts))).sortWithinPartitions("slot", "key")

    names = [*kinds, "times"]
    types = [*kinds.values(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = None, 0
        for batch in batches:
            out: list[tuple] = []
            for times, name, body in zip(batch.column("times").to_pylist(), batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                this = prepare(body)
                if held is not None:
                    if left > 1:
                        again = use(*held, held[1])
                        out.extend((*again, min(REPEATED, left - 1 - k)) for k in range(0, left - 1, REPEATED))
                    out.append((*use(*held, this), 1))
                held, left = ((name, this), times) if times else (None, 0)
            columns = zip(*out, strict=True) if out else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    ddl = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = ", ".join(f"`{n}` {ddl[t]}" for n, t in zip(names, types, strict=True))
    found = dealt.select("times", "id", "text").mapInArrow(run, schema)
    return found.select(*(F.col(f"`{n}`") for n in kinds), F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("col")


def _compared(name: int | None, this: tuple, following: tuple) -> tuple:
    text, own, mark = this
    n = len(text)
    edited = text[: n - n // 2] + following[0][: n // 2]
    changed = Text(codes_of(edited))
    other = fingerprint(changed)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    likely = likeness(mark, other), likeness(mark, following[2])
    return name, n, digest, mark, other, *likely, common_extension(own, changed), common_extension(own, following[1])


def _prepared(text: str) -> tuple[str, Text, str]:
    own = Text(codes_of(text))
    return text, own, fingerprint(own)


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int | None = None) -> DataFrame:
    """Fingerprints of every text and of the text edited by its neighbour, and how alike they are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the
    next row, ids descending; behind the last row comes the first. ``near_edited`` and ``near_next`` are likenesses of
    the fingerprint to those of the edited and the next text; ``same_edited`` and ``same_next`` count
    the code points that they begin with alike. A null text is empty; equal texts have equal
    fingerprints, and an empty text is like empty ones only. A single row is its own neighbour. Rows
    that repeat an id stay rows of their own. An empty table gives an empty one, and other columns are not looked at.
    """
    whole, text, share = pa.int64(), pa.string(), pa.float64()
    kinds = {id_col: whole, "n_chars": whole, "edited_sha256": text, "fingerprint": text, "edited_fingerprint": text}
    kinds |= {"near_edited": share, "near_next": share, "same_edited": whole, "same_next": whole}
    return with_next(docs, _prepared, _compared, kinds, id_col, text_col, slots)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [_prepared(t or "")[2] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], [id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")
