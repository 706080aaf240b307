"""Exact top-k search by inner product over M-trees.

Inner products are no metric, so each vector x gets one more coordinate,
sqrt(m - |x|^2) with the largest squared norm m, and queries get a zero there: Euclidean
distance then falls as the inner product grows. Vectors are dealt to the closest of some pivots, and the
vectors of a pivot to shards of bounded size. A shard is an M-tree, stored as pages: a page has a centre, a covering radius,
the distance to its parent's centre, and for a leaf its vectors with their distances to the
centre. A search opens pages best bound first and stops at the first page that cannot hold a
better score. Stored distances rule out pages and vectors by the triangle inequality
before any distance to them is computed. Scores are exact integers.

The pages at the top of all shards are one more level: a query first asks the shard whose page is closest, and then
only those whose page may hold something better than the k-th score found there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import stored

SHARD = 16384
QUERIES = 1024
LEAF = 512
FAN = 32
PIVOTS = 1024  # at most
SLACK = 1e-6  # of a distance: bounds are compared with some room for rounding

PAGES = "shard int, page int, parent int, centre array<double>, radius double, to_parent double, ids array<long>, vectors binary, to_centre array<double>"


def _closest(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The closest pivot of each point; a block of points needs one number for each pivot."""
    size = (pivots**2).sum(1) / 2
    blocks = [(size - points[a : a + 4096] @ pivots.T).argmin(1) for a in range(0, len(points), 4096)]
    return np.concatenate(blocks) if blocks else np.zeros(0, np.int64)


def _build(points: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, float, float, np.ndarray | None, np.ndarray | None]]:
    """Pages (page, parent, centre, radius, to_parent, members, to_centre) of one tree, top down."""
    rng = np.random.default_rng(len(points))
    todo = [(0, -1, np.arange(len(points)), None)]
    count = 1
    while todo:
        page, parent, members, above = todo.pop()
        centre = points[members].mean(0)
        far = np.linalg.norm(points[members] - centre, axis=1)
        to_parent = 0.0 if above is None else float(np.linalg.norm(centre - above))
        leaf = len(members) <= LEAF
        yield page, parent, centre, float(far.max()), to_parent, members if leaf else None, far if leaf else None
        if leaf:
            continue
        pivots = points[members[rng.choice(len(members), min(FAN, len(members)), replace=False)]]
        near = _closest(points[members], pivots)
        groups = [members[near == i] for i in range(len(pivots))]
        if max(map(len, groups)) == len(members):  # equal vectors: any even cut will do
            groups = np.array_split(members, FAN)
        for group in groups:
            if len(group):
                todo.append((count, page, group, centre))
                count += 1


def _index_shard(key: tuple, rows: pa.Table) -> pa.Table:
    vectors = np.array(rows["v"].to_pylist(), np.int64)
    lift = np.sqrt(np.maximum(rows["top"].to_numpy().astype(float) - (vectors**2).sum(1), 0))
    ids = rows["vec_id"].to_numpy()
    out: dict[str, list] = {name.split()[0]: [] for name in PAGES.split(", ")}
    for page, parent, centre, radius, to_parent, members, far in _build(np.hstack([vectors.astype(float), lift[:, None]])):
        row = (key[0].as_py(), page, parent, centre, radius, to_parent, None if members is None else ids[members], None if members is None else vectors[members].tobytes(), far)
        for column, value in zip(out.values(), row, strict=True):
            column.append(value)
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()))
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds, strict=True)})


class Tree:
    """One shard's pages, ready for searches."""

    def __init__(self, pages: pa.Table):
        rows = pages.sort_by("page")
        dim = len(rows["centre"][0])
        self.centres = rows["centre"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        self.radius, self.to_parent = rows["radius"].to_numpy(), rows["to_parent"].to_numpy()
        self.ids = [None if x is None else np.array(x, np.int64) for x in rows["ids"].to_pylist()]
        self.vectors = [None if x is None else np.frombuffer(x, np.int64).reshape(-1, dim - 1) for x in rows["vectors"].to_pylist()]
        self.far = [None if x is None else np.array(x) for x in rows["to_centre"].to_pylist()]
        self.children: list[list[int]] = [[] for _ in self.ids]
        for page, parent in enumerate(rows["parent"].to_pylist()):
            if parent >= 0:
                self.children[parent].append(page)

    def search(self, query: np.ndarray, own: int, k: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (score, id) of the shard without ``own``; top: the largest squared norm."""
        base = float((query**2).sum()) + top
        point = np.append(query.astype(float), 0.0)
        scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        limit = np.inf  # distance of the k-th best so far
        start = float(np.linalg.norm(point - self.centres[0]))
        heap = [(start - self.radius[0], 0, start)]
        while heap:
            bound, page, away = heapq.heappop(heap)
            room = limit * (1 + SLACK) + SLACK
            if bound > room:
                break
            if self.ids[page] is not None:
                near = np.abs(away - self.far[page]) <= room
                near &= self.ids[page] != own
                if near.any():
                    scores = np.append(scores, self.vectors[page][near] @ query)
                    ids = np.append(ids, self.ids[page][near])
                    keep = np.lexsort((ids, -scores))[:k]
                    scores, ids = scores[keep], ids[keep]
                    if len(scores) == k:
                        limit = np.sqrt(max(base - 2.0 * float(scores[-1]), 0.0))
                continue
            below = np.array(self.children[page])
            below = below[np.abs(away - self.to_parent[below]) - self.radius[below] <= room]
            if len(below):
                far = np.sqrt(((self.centres[below] - point) ** 2).sum(1))
                for child, d in zip(below.tolist(), far.tolist(), strict=True):
                    if d - self.radius[child] <= room:
                        heapq.heappush(heap, (d - self.radius[child], child, d))
        return scores, ids


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): components times ``scale``, rounded down; rows with a missing or non-finite one are left out."""
    number = F.transform(vector_col, lambda x: x.cast("double"))
    fine = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(vector_col) > 0)).filter(fine)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(number, lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _norm2() -> Column:
    return F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)


def _near_pivot(pivots: dict[int, np.ndarray], top: int):
    """Adds the ``pivot`` that is closest among those of a vector's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int32)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                vectors = batch.column("v").take(pa.array(at)).flatten().to_numpy().reshape(-1, dim).astype(float)
                found[at] = _closest(_lifted(vectors, top), pivots[dim])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "pivot"])

    return run


def _lifted(vectors: np.ndarray, top: int) -> np.ndarray:
    return np.hstack([vectors, np.sqrt(np.maximum(float(top) - (vectors**2).sum(1), 0))[:, None]])


def index(vectors: DataFrame, shard: int = SHARD, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame, int]:
    """The stored pages of all shards, their top pages (shard, dim, centre, radius), and the largest squared norm.

    Vectors of different lengths never share a shard. There is about one pivot for each shard that is needed, at most ``pivots``,
    taken by a hash of the ids; they come to the driver.
    """
    sized = vectors.withColumn("dim", F.size("v"))
    dims = sized.groupBy("dim").agg(F.count("v").alias("n"), F.max(_norm2()).alias("top")).orderBy("dim").collect()
    top = max((r.top for r in dims), default=0)
    turn = F.xxhash64("vec_id", "v")
    chosen: dict[int, np.ndarray] = {}
    for r in dims:  # as many as there are vector lengths
        wanted = min(pivots, -(-r.n // shard))
        rows = sized.filter(F.col("dim") == r.dim).orderBy(turn, "vec_id").select("v").limit(wanted).collect()
        chosen[r.dim] = _lifted(np.array([x.v for x in rows], float), top)
    columns = "vec_id long, v array<long>, dim int, pivot int"
    dealt = stored(sized.select("vec_id", "v", "dim").mapInArrow(_near_pivot(chosen, top), columns), "dealt")
    counts = dealt.groupBy("dim", "pivot").agg(F.count("v").alias("n"))
    # A pivot with more vectors than a shard takes has several shards.
    parts = counts.orderBy("dim", "pivot").collect()
    first, places = 0, []
    for r in parts:  # at most ``pivots`` for each vector length
        needed = -(-r.n // shard)
        places.append((r.dim, r.pivot, first, needed))
        first += needed
    placed = vectors.sparkSession.createDataFrame(places, "dim int, pivot int, first int, needed int")
    named = dealt.join(F.broadcast(placed), ["dim", "pivot"])
    own = (F.col("first") + F.pmod(turn, F.col("needed"))).cast("int")
    rows = named.select(own.alias("shard"), "vec_id", "v", F.lit(top).cast("long").alias("top"))
    pages = stored(rows.groupBy("shard").applyInArrow(_index_shard, PAGES), "mtree")
    tops = stored(pages.filter("parent < 0").select("shard", (F.size("centre") - 1).alias("dim"), "centre", "radius"), "tops")
    return pages, tops, top


def _asked(pages: DataFrame, sent: DataFrame, k: int, top: int) -> DataFrame:
    """Answers (query_id, vec_id, score) of the shards that queries (shard, block, query_id, v) are sent to."""
    pairs = sent.select("shard", "block").distinct()
    opened = pages.join(pairs, "shard")
    asked = sent.select(*(F.col(c).alias(c) for c in sent.columns))  # a frame of its own

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            tree = Tree(right)
            for query_id, v in zip(left["query_id"].to_pylist(), left["v"].to_pylist(), strict=True):
                scores, ids = tree.search(np.array(v, np.int64), query_id, k, top)
                for column, values in zip(found, ([query_id] * len(ids), ids.tolist(), scores.tolist()), strict=True):
                    column.extend(values)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), found, strict=True)})

    both = asked.groupBy("shard", "block").cogroup(opened.groupBy("shard", "block"))
    return both.applyInArrow(run, "query_id long, vec_id long, score long")


def search(pages: DataFrame, tops: DataFrame, top: int, queries: DataFrame, k: int = 10, block: int = QUERIES) -> DataFrame:
    """The ``k`` best rows for each query (vec_id, v): query_id, rank, vec_id, score.

    Higher scores first, ties to the smaller id; a query's own id is left out, and a query
    that occurs twice is answered once. Queries meet shards in blocks, first the one whose top page is closest, then
    those that may still hold a better row; the shards' answers, ``k`` rows each, are merged.
    """
    asked = queries.dropDuplicates(["vec_id"])
    blocks = max(1, -(-asked.count() // block))
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")), "asked")
    # Queries against the top pages, one for each shard.
    bounds = stored(asked.join(F.broadcast(tops), "dim").select("query_id", "shard", (_away() - F.col("radius")).alias("bound")), "bounds")
    nearest = F.min_by("shard", F.struct("bound", "shard")).alias("shard")
    first = bounds.groupBy("query_id").agg(nearest)
    one = stored(_asked(pages, asked.join(first, "query_id").select("shard", "block", "query_id", "v"), k, top), "answers")
    # The distance of the k-th answer so far.
    kth = one.groupBy("query_id").agg(F.when(F.count("score") >= k, F.min("score")).alias("kth"))
    base = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x) + F.lit(float(top))
    limit = F.sqrt(F.greatest(base - 2.0 * F.col("kth"), F.lit(0.0))) * (1 + SLACK) + SLACK
    ends = asked.join(first.withColumnRenamed("shard", "done"), "query_id").join(kth, "query_id", "left").withColumn("limit", limit)
    more = _left_to_ask(bounds, ends).select("shard", "block", "query_id", "v")
    best = one.unionByName(_asked(pages, more, k, top))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _left_to_ask(bounds: DataFrame, ends: DataFrame) -> DataFrame:
    """Queries (query_id, done, kth, limit) with each other shard that may hold a better row than their k-th."""
    open_ = F.col("kth").isNull() | (F.col("bound") <= F.col("limit"))
    return bounds.join(ends, "query_id").filter((F.col("shard") != F.col("done")) & open_)


def _away() -> Column:
    """Distance of a query ``v``, lifted by a zero, from ``centre``."""
    lifted = F.concat(F.transform("v", lambda x: x.cast("double")), F.array(F.lit(0.0)))
    squares = F.zip_with(lifted, F.col("centre"), lambda x, c: (x - c) * (x - c))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))
