"""Near-duplicate documents by a MinHash LSH forest.

Texts with the same set of word shingles form a class; the rest works on classes.
A class has a signature of minimal hashes, and each tree of the forest is one sorted
order of the signatures, each starting at another hash. Rows that share a prefix of
``DEPTH`` hashes in an order are a region. Candidates are found in two rounds:

1. Within each sorted order, runs of neighbours with a longest common prefix of at
   least that depth are compared by their signatures, and only a spanning forest of the
   likely links goes on. A region too large for one run is cut where the common prefix of neighbours is
   shortest, deeper and deeper until every run fits, so its depth adapts; neighbouring
   runs share a row.
2. Regions that still hold several components compare all rows of different
   components, so that no link between them is lost. A region too large for that is
   refined: its rows are dealt anew by their rarest shingles, of which two similar sets always share one. So
   documents that share a passage but are not alike part, and what stays together is small. Rows of a small region
   are compared by signatures, and likely pairs go on. Rows of a larger one bring their sets and are
   dealt to blocks; each tile of two blocks is one group, so that a task holds no more,
   and only the confirmed links that join components go on.

All candidates are confirmed on full shingle sets, and components are taken of the
confirmed links only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.llm import words as W
from tiermart.llm.common import fresh, give_back, stored
from tiermart.llm.graph import components
from tiermart.operators.joins import left_join_unique

TREES = 24
DEPTH = 4
HASHES = TREES * DEPTH
NEAR = 0.62  # least share of equal hashes of a candidate: over four deviations below 0.8
LIKELY = 0.78
RUN = 1024
DENSE = 48  # rows of a region from which on sets are compared in place
BLOCK = 2048  # rows of a tile, about: two blocks of half as many
LABEL = 12  # further hashes by which a region is sorted
ITEMS = 1 << 20  # shingles of a tile, about
COUNTERS = 1 << 18  # of shingles, to tell rare ones
SHINGLE = 5
SIMILAR = 80

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_RNG = np.random.default_rng(20)
_FLIP = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)


def _sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text."""
    data = [(t or "").encode("utf-8", "surrogatepass").lower() + b"\n" for t in texts]
    joined = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(d) for d in data])
    blank = _SPACE[joined]
    change = np.flatnonzero(np.append(True, blank[1:] != blank[:-1]))
    hashes = W.segment_hashes(joined, change)
    word = ~blank[change]
    hashes, starts = hashes[word], change[word]
    bounds = np.append(0, np.searchsorted(starts, ends))

    def combine(columns: list[np.ndarray]) -> np.ndarray:
        found = np.full(columns[0].shape, len(columns), np.uint64)
        for column in columns:
            found = W.mixed(found * np.uint64(3) + column)
        return found

    n = len(hashes)
    windows = combine([hashes[i : n - size + 1 + i] for i in range(size)]) if n >= size else hashes[:0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            yield combine([hashes[i : i + 1] for i in range(a, b)])
        else:
            yield windows[:0]


def _signature(found: np.ndarray) -> bytes:
    """Sixteen bits of the least value of each hash function over a set."""
    small = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for a in range(0, len(small), 8192):
        mixed = (small[a : a + 8192, None] ^ _FLIP) * _TIMES
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        np.minimum(least, mixed.min(0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2").tobytes()


def _sketches(size: int):
    """Rows (id, key, text) to rows (id, key, n, digest, sign)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sign = [], [], []
            for part in _slices(batch, "text"):
                for found in _sets(part.column("text").to_pylist(), size):
                    n.append(len(found))
                    digest.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    sign.append(_signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sign, pa.binary())], ["id", "key", "n", "digest", "sign"])
            give_back()

    return run


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``W.CHUNK`` bytes in a column; a larger row stands alone."""
    ends = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + W.CHUNK, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _packed_sets(size: int):
    """Rows (id, text) to rows (id, items), the hashes of a text's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text"):
                out = [f.tobytes() for f in _sets(part.column("text").to_pylist(), size)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.binary())], ["id", "items"])
            give_back()

    return run


def _agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return (many == one).mean(-1)


class _Rows:
    """Rows (region, id, sign and maybe others) of sorted batches, region by region."""

    def __init__(self, batches: Iterator[pa.RecordBatch], key: list[str]):
        self.batches, self.key = batches, key

    def __iter__(self) -> Iterator[pa.Table]:
        """Tables of whole regions; a region at the end of a batch waits for the next one."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in self.batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in self.key])
            cut = np.flatnonzero((keys != keys[:, -1:]).any(0))
            cut = int(cut[-1]) + 1 if len(cut) else 0  # the last region begins here
            if held and tuple(keys[:, 0]) != last:
                yield pa.Table.from_batches(held)
                held = []
            if cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
            last = tuple(keys[:, -1])
        if held:
            yield pa.Table.from_batches(held)


def _signs(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["sign"].to_pylist()), np.uint16).reshape(-1, HASHES)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _forest(ids: np.ndarray, signs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the likely links of one run, best links first (Prim)."""
    n = len(ids)
    best, via, out = np.full(n, -1.0), np.full(n, -1), np.ones(n, bool)
    a, b = [], []
    now = 0
    for _ in range(n - 1):
        out[now] = False
        best[now] = -1
        rest = np.flatnonzero(out)
        near = _agreement(signs[now], signs[rest])
        better = near > best[rest]
        best[rest[better]], via[rest[better]] = near[better], now
        now = int(rest[best[rest].argmax()])
        if best[now] >= LIKELY:
            a.append(ids[now])
            b.append(ids[via[now]])
    if a:
        yield _pairs(np.array(a), np.array(b))


def _common(labels: pa.ChunkedArray) -> np.ndarray:
    """How many hashes each label begins with that the one before has too; the first row has none."""
    hashes = np.frombuffer(b"".join(labels.to_pylist()), np.uint16).reshape(-1, LABEL)
    same = np.cumprod(hashes[1:] == hashes[:-1], axis=1).sum(1)
    return np.append(0, same)


def _runs(common: np.ndarray, begin: int, end: int, depth: int = 0) -> Iterator[tuple[int, int]]:
    """Runs of at most ``RUN`` rows of one region in sorted order.

    A longer stretch is cut where neighbours share no more than ``depth`` hashes and the parts go one
    hash deeper; short parts side by side stay together. Rows with equal labels are cut evenly.
    """
    if end - begin <= RUN:
        yield begin, end
        return
    if depth >= LABEL:
        cuts = list(range(begin + RUN, end, RUN))
    else:
        cuts = (begin + 1 + np.flatnonzero(common[begin + 1 : end] <= depth)).tolist()
    held = begin
    edges = [begin, *cuts, end]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - held > RUN and a > held:
            yield held, a
            held = a
        if b - a > RUN:
            yield from _runs(common, a, b, depth + 1)
            held = b
    if held < end:
        yield held, end


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Likely links among rows (region, label, id, sign) in sorted order."""
    for table in _Rows(batches, ["region"]):
        region, ids, signs = table["region"].to_numpy(), table["id"].to_numpy(), _signs(table)
        begin = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        end = np.append(begin[1:], len(region))
        two = begin[end - begin == 2]
        if len(two):
            likely = two[_agreement(signs[two], signs[two + 1]) >= LIKELY]
            if len(likely):
                yield _pairs(ids[likely], ids[likely + 1])
        large = end - begin > RUN
        common = _common(table["label"]) if large.any() else None
        for x, y in zip(begin.tolist(), end.tolist(), strict=True):
            if y - x > 2:
                # A run also holds the last row of the run before.
                for a, b in _runs(common, x, y) if y - x > RUN else [(x, y)]:
                    a = max(a - 1, x)
                    yield from _forest(ids[a:b], signs[a:b])
    give_back()


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All possible links between components in each tile of rows (region, tile, id, component, major, sign)."""
    for table in _Rows(batches, ["region", "tile"]):
        both = np.stack([table["region"].to_numpy(), table["tile"].to_numpy()])
        ids, comp, major, signs = table["id"].to_numpy(), table["component"].to_numpy(), table["major"].to_numpy(), _signs(table)
        begin = np.flatnonzero(np.append(True, (both[:, 1:] != both[:, :-1]).any(0)))
        end = np.append(begin[1:], both.shape[1])
        two = begin[end - begin == 2]
        if len(two):
            likely = two[(comp[two] != comp[two + 1]) & (_agreement(signs[two], signs[two + 1]) >= NEAR)]
            if len(likely):
                yield _pairs(ids[likely], ids[likely + 1])
        for x, y in zip(begin.tolist(), end.tolist(), strict=True):
            if y - x <= 2:
                continue
            for i in (x + np.flatnonzero(comp[x:y] != major[x:y])).tolist():
                near = x + np.flatnonzero((comp[x:y] != comp[i]) & (_agreement(signs[i], signs[x:y]) >= NEAR))
                if len(near):
                    yield _pairs(np.full(len(near), ids[i]), ids[near])


def _numbers(data: bytes) -> np.ndarray:
    """The shingle hashes of a packed set."""
    return np.frombuffer(data, np.uint64)


def _similar(both: np.ndarray | int, one: int, two: np.ndarray | int, percent: int) -> np.ndarray | bool:
    return 100 * both >= percent * (one + two - both)


def _dense(percent: int):
    """Confirmed links between components in tiles of rows (region, tile, id, component, major, side, items).

    Rows of one side are held against those of the other, or all against all if there is one
    side. A similar row has one of any ``n - least + 1`` shingles of a row, ``least`` being the
    fewest they can share; the row's rarest ones find all rows that can be similar. If there are
    any, one row is held against the whole tile by counting, over its shingles, the rows that
    have them. Links that join nothing new are left out.
    """

    def links(ids: np.ndarray, comp: np.ndarray, major: np.ndarray, side: np.ndarray, items: list[bytes]) -> Iterator[pa.RecordBatch]:
        sets = [_numbers(x) for x in items]
        sizes = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        owner = np.repeat(np.arange(len(sets)), sizes)[order]
        values, begin = np.unique(flat[order], return_index=True)
        bounds = np.append(begin, len(flat))
        spread = np.diff(bounds)
        least = -(-percent * sizes // 100)
        other = side == side.max()
        above: dict[int, int] = {}

        def root(c: int) -> int:
            while c in above:
                c = above[c]
            return c

        a, b = [], []
        for i in np.flatnonzero((comp != major) & (side == side.min())).tolist():
            at = np.searchsorted(values, sets[i])
            rare = at[np.argsort(spread[at], kind="stable")[: sizes[i] - least[i] + 1]]
            rows, _ = W.gather(owner, bounds, rare)
            if not (other[rows] & (comp[rows] != comp[i])).any():
                continue
            rows, _ = W.gather(owner, bounds, at)
            both = np.bincount(rows, minlength=len(sets))
            for j in np.flatnonzero(_similar(both, sizes[i], sizes, percent) & other & (comp != comp[i])).tolist():
                x, y = root(int(comp[i])), root(int(comp[j]))
                if x != y:
                    above[x] = y
                    a.append(ids[i])
                    b.append(ids[j])
        if a:
            yield _pairs(np.array(a), np.array(b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _Rows(batches, ["region", "tile"]):
            both = np.stack([table["region"].to_numpy(), table["tile"].to_numpy()])
            begin = np.flatnonzero(np.append(True, (both[:, 1:] != both[:, :-1]).any(0)))
            for x, y in zip(begin.tolist(), [*begin[1:].tolist(), both.shape[1]], strict=True):
                part = table.slice(x, y - x)
                yield from links(part["id"].to_numpy(), part["component"].to_numpy(), part["major"].to_numpy(), part["side"].to_numpy(), part["items"].to_pylist())
        give_back()

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                one, two = _numbers(x), _numbers(y)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(_similar(both, len(one), len(two), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a long, b long"), "links")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles fall into each counter."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for items in batch.column("items").to_pylist():
            total += np.bincount((_numbers(items) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["counter", "n"])
    give_back()


def _rarest(often: np.ndarray, percent: int):
    """Rows (id, component, weight, items) to one row for each of the rarest shingles that a similar set cannot lack all of.

    All rows order shingles alike, by their counter and then by value; which order that is does not matter for the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                picked = []
                for items in part.column("items").to_pylist():
                    found = _numbers(items)
                    rank = np.lexsort((found, often[(found % np.uint64(COUNTERS)).astype(np.int64)]))
                    picked.append(found[rank[: len(found) - -(-percent * len(found) // 100) + 1]])
                rows = pa.array(np.repeat(np.arange(part.num_rows), [len(p) for p in picked]))
                token = pa.array(np.concatenate(picked).view(np.int64)) if picked else pa.array([], pa.int64())
                yield pa.RecordBatch.from_arrays([token, *(part.column(c).take(rows) for c in ("id", "component", "weight"))], ["token", "id", "component", "weight"])
            give_back()

    return run


def _refined(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (id, component, weight) in smaller regions, one for each rare shingle; similar rows still meet."""
    whole = stored(rows.join(sets, "id"), "refined")
    often = np.zeros(COUNTERS, np.int64)
    for r in whole.mapInArrow(_counts, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toLocalIterator():
        often[r.counter] = r.n
    dealt = whole.select("id", "component", "weight", "items").mapInArrow(_rarest(often, percent), "token long, id long, component long, weight long")
    return stored(dealt.select(F.xxhash64(F.lit("shingle"), "token").alias("region"), "id", "component", "weight"), "refined")


def _mixed(placed: DataFrame) -> DataFrame:
    """Regions with rows of several components: the largest one, its rows and shingles, and those of the region."""
    counts = placed.groupBy("region", "component").agg(F.count("id").alias("n"), F.sum("weight").alias("w"))
    most = F.max(F.struct("n", "component", "w"))
    mixed = counts.groupBy("region").agg(F.count("n").alias("parts"), most.alias("top"), F.sum("n").alias("size"), F.sum("w").alias("weigh")).filter("parts > 1")
    return stored(mixed.select("region", F.col("top.component").alias("major"), F.col("top.n").alias("most"), F.col("top.w").alias("heavy"), "size", "weigh"), "mixed")


def _one_tile() -> Column:
    return (F.col("size") <= max(BLOCK, DENSE)) & ((F.col("weigh") <= ITEMS) | (F.col("size") <= DENSE))


def _tiles(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows (region, id, component) of mixed regions with each ``tile`` they go to and their ``side`` there.

    Any two rows of different components meet in one tile of their region, on different sides or in
    a tile that has one side only. A region of up to ``BLOCK`` rows and ``ITEMS`` shingles is one tile. In a larger one,
    rows of the largest component and the others have blocks of their own, and no tile is for two blocks of the former.
    """

    def blocks(rows: Column, items: Column) -> Column:
        return F.greatest(F.ceil(rows / max(1, BLOCK // 2)), F.ceil(items / max(1, ITEMS // 2))).cast("long")

    minor_blocks, major_blocks = blocks(F.col("size") - F.col("most"), F.col("weigh") - F.col("heavy")), blocks(F.col("most"), F.col("heavy"))
    rows = left_join_unique(placed.select("region", "id", "component"), mixed, ["region"]).filter("major IS NOT NULL").withColumn("minor", F.col("component") != F.col("major"))
    rows = rows.withColumn("minors", minor_blocks).withColumn("blocks", F.col("minors") + major_blocks)
    turn = F.xxhash64("id")
    rows = rows.withColumn("block", F.when(F.col("minor"), F.pmod(turn, F.col("minors"))).otherwise(F.col("minors") + F.pmod(turn, F.col("blocks") - F.col("minors"))))
    met = F.sequence(F.lit(0).cast("long"), F.when(F.col("minor"), F.col("blocks")).otherwise(F.col("minors")) - 1)

    def place(other):
        tile = F.least("block", other) * F.col("blocks") + F.greatest("block", other)
        return F.struct(tile.alias("tile"), (F.col("block") > other).cast("int").alias("side"))

    whole = F.array(F.struct(F.lit(0).cast("long").alias("tile"), F.lit(0).alias("side")))
    where = F.when(_one_tile(), whole).otherwise(F.transform(met, place))
    return rows.select("region", "size", "id", "component", "major", F.explode(where).alias("place")).select("region", "size", "id", "component", "major", "place.tile", "place.side")


def _all_tiles(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Tiles of all mixed regions, those of rows in too large ones being made of refined regions."""
    mixed = _mixed(placed)
    large = mixed.filter(~_one_tile()).select("region")
    tiles = _tiles(placed, mixed.filter(_one_tile()))
    if large.isEmpty():
        return tiles
    rows = stored(placed.join(large, "region", "left_semi").select("id", "component", "weight").distinct(), "large")
    finer = _refined(rows, sets, percent)
    return tiles.unionByName(_tiles(finer, _mixed(finer)))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """One row per input row: id, ``key`` of its text, ``n`` shingles, ``group`` and the smallest id in it.

    A group is null for rows without an id or shingles. Nodes of the graph are sets of shingles, numbered, so that texts that share an id stay apart.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("key"), "text")
    sketch = stored(rows.mapInArrow(_sketches(shingle), "id long, key long, n long, digest binary, sign binary"), "sketch")
    known = sketch.filter("id IS NOT NULL AND n > 0")
    # One text stands for each set; the number is fixed once it is stored.
    sets_of = known.groupBy("digest").agg(F.min(F.struct("id", "key")).alias("text"), F.min("sign").alias("sign"), F.min("n").alias("n"))
    classes = stored(sets_of.withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = classes.select(F.col("node").alias("id"), "sign", F.col("n").alias("weight"))

    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    prefix = F.substring("sign", F.col("tree") * 2 * DEPTH + 1, F.lit(2 * DEPTH))
    entries = nodes.withColumn("tree", tree).select(F.xxhash64("tree", prefix).alias("region"), "tree", "id", "weight")
    shared = entries.groupBy("region").agg(F.count("id").alias("size")).filter("size > 1")
    members = stored(left_join_unique(entries, shared, ["region"]).filter("size IS NOT NULL"), "members")
    active = members.select("id").distinct()
    wanted = classes.join(active, F.col("node") == F.col("id"), "left_semi").select("node", "text.id", "text.key")
    # Rows that repeat an id and a text give one set.
    repeated = known.groupBy("id", "key").agg(F.count("id").alias("copies")).filter("copies > 1").select("id", "key")
    single = rows.join(wanted.join(repeated, ["id", "key"], "left_anti"), ["id", "key"]).select("node", "text")
    several = rows.join(wanted.join(repeated, ["id", "key"], "left_semi"), ["id", "key"]).select("node", "text").dropDuplicates(["node"])
    whole = single.unionByName(several).select(F.col("node").alias("id"), "text")
    sets = stored(whole.mapInArrow(_packed_sets(shingle), "id long, items binary"), "sets")

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = F.col("tree") * 2 * DEPTH + 2 * DEPTH
    label = F.concat(F.substring("sign", turn + 1, F.lit(2 * HASHES)), F.substring("sign", F.lit(1), turn))
    signed = members.select("region", "tree", "id").join(nodes, "id").withColumn("label", F.substring(label, 1, 2 * LABEL))
    order = ["region", "label", "id"]
    lines = signed.select("region", "label", "id", "sign").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    first = _confirmed(lines.mapInArrow(_neighbours, "a long, b long").distinct(), sets, percent)
    grown = components(first)

    own = F.coalesce("component", "id").alias("component")
    placed = members.join(grown, "id", "left").select("region", "id", "weight", own)
    spread = stored(_all_tiles(placed, sets, percent), "tiles")
    few = spread.filter(F.col("size") <= DENSE).join(nodes, "id").repartition(parts, "region", "tile").sortWithinPartitions("region", "tile")
    many = spread.filter(F.col("size") > DENSE).join(sets, "id").repartition(parts, "region", "tile").sortWithinPartitions("region", "tile")
    second = _confirmed(few.mapInArrow(_across, "a long, b long").distinct(), sets, percent)
    third = stored(many.mapInArrow(_dense(percent), "a long, b long"), "links")
    final = components(first.unionByName(second).unionByName(third))

    least = classes.select(F.col("node").alias("id"), F.col("text.id").alias("least"))
    smallest = final.join(least, "id").groupBy("component").agg(F.min("least").alias("smallest"))
    linked = left_join_unique(final, smallest, ["component"]).select(F.col("id").alias("node"), "component", "smallest")
    resolved = classes.join(linked, "node", "left").select("digest", F.coalesce("component", "node").alias("group"), F.coalesce("smallest", "text.id").alias("smallest"))
    joined = sketch.select("id", "key", "n", "digest").join(resolved, "digest", "left")
    alone = F.col("id").isNull() | (F.col("n") == 0)
    return joined.select("id", "key", "n", F.when(~alone, F.col("group")).alias("group"), F.when(alone, F.col("id")).otherwise(F.col("smallest")).alias("smallest"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = SIMILAR) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id`` and ``kept``.

    Words are cut at ASCII white space and A-Z is lower-cased; a text of fewer words than a
    shingle has is one shingle. Null and blank texts have none and are linked with nothing.
    Two texts are linked if their sets' intersection is at least ``percent`` of the union;
    ``component_id`` is the smallest id reachable over links. Ids are longs; rows that repeat an id
    with another text are linked by their own texts, and a row without an id stays alone and is kept.
    """
    found = _grouped(docs, id_col, text_col, shingle, percent)
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("smallest").alias("component_id"), F.col("id").eqNullSafe(F.col("smallest")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = SIMILAR) -> DataFrame:
    """``docs`` with one row of each group, the one with the smallest id; ids may repeat.

    Of a group's rows with that id one text stays, and of rows that repeat an id and a text one. Rows
    without an id and blank texts are in no group; they stay, blank ones once for each id and text.
    """
    found = _grouped(docs, id_col, text_col, shingle, percent).filter("id IS NOT NULL")
    best = found.filter("group IS NOT NULL").groupBy("group").agg(F.min(F.struct("id", "key")).alias("r")).select("r.id", "r.key")
    blank = found.filter("group IS NULL").select("id", "key").distinct()
    name = fresh(docs.columns, "near")
    kept = best.unionByName(blank).select(F.col("id").alias(f"{name}_id"), F.col("key").alias(f"{name}_key"))
    keys = [f"{name}_id", f"{name}_key"]
    named = docs.select("*", F.col(id_col).cast("long").alias(keys[0]), F.xxhash64(F.col(text_col).cast("string")).alias(keys[1]))
    chosen = named.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
    return chosen.unionByName(docs.filter(F.col(id_col).isNull()))
