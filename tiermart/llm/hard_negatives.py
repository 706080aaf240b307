"""Hard negatives by inner product, with pruned search over length buckets.

Vectors of a label are sorted by length, cut into shards of bounded size and these into buckets.
A bucket holds, for every coordinate, its unit vectors' values in order. An anchor that looks for scores
of at least t in a bucket needs a cosine of at least t / (its length * the bucket's longest); such
vectors can only have values in a range around each coordinate of the anchor. The ranges of the anchor's
focus coordinates, the largest ones, are cut from the ordered lists, and vectors that lie in all of
them are verified by exact integer scores. Buckets come longest first; what is
found raises the threshold for the rest, and a bucket too short for it ends the search.

Shards and blocks of anchors meet in groups of bounded size. Positives are first sought in
the shard of an anchor's label that has the longest vectors; the other shards only see anchors that may still gain. Negatives
only meet shards whose longest vector can reach half a positive's score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import stored

SHARD = 16384
ANCHORS = 2048
BUCKET = 512
FOCUS = 4
SCALE = 256
SLACK = 1e-9

SHARDS = "shard long, dim int, label long, n long, longest double, ids binary, vectors binary"


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): components times ``scale``, rounded down.

    Rows without an id, a label or a vector, and those with an empty vector or a missing or non-finite
    component, are left out. Of rows that repeat an id the one with the smallest label, then vector, stays.
    """
    number = F.transform(vector_col, lambda x: x.cast("double"))
    fine = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector_col) > 0)
    kept = rows.filter(given).filter(fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.transform(number, lambda x: F.floor(x * scale).cast("long")).alias("v"),
    )
    repeated = kept.groupBy("vec_id").agg(F.count("vec_id").alias("n")).filter("n > 1").select("vec_id")
    least = kept.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return kept.join(repeated, "vec_id", "left_anti").unionByName(least.select("vec_id", "r.label", "r.v"))


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(F.col(v), F.lit(0.0), lambda a, x: a + x.cast("double") * x))


def _packed(size: int):
    """Rows (dim, label, vec_id, v, norm) in order to packed rows of up to ``size`` vectors of one length and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 32
        held: list[pa.Table] = []
        key = None

        def done() -> pa.RecordBatch:
            nonlocal name
            both = pa.concat_tables(held).combine_chunks()
            held.clear()
            name += 1
            v = both["v"].combine_chunks().flatten().to_numpy()
            row = (name, key[0], key[1], both.num_rows, both["norm"][0].as_py(), both["vec_id"].to_numpy().tobytes(), v.tobytes())
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], [c.split()[0] for c in SHARDS.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "label")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if held and key != tuple(keys[:, a].tolist()):
                    yield done()
                key = tuple(keys[:, a].tolist())
                while a < b:
                    take = min(b - a, size - sum(t.num_rows for t in held))
                    held.append(pa.Table.from_batches([batch.slice(a, take)]))
                    a += take
                    if sum(t.num_rows for t in held) == size:
                        yield done()
        if held:
            yield done()

    return run


def shards(vectors: DataFrame, size: int = SHARD) -> DataFrame:
    """Stored packed rows of up to ``size`` vectors of one label, longest vectors first."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("dim"), F.col("label"), F.desc("norm"), F.col("vec_id")]
    rows = vectors.select(F.size("v").alias("dim"), "label", "vec_id", "v", _norm("v").alias("norm"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(_packed(size), SHARDS), "shards")


class Bucket:
    """Vectors of similar length with the ordered values of every coordinate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray):
        self.ids, self.vectors, self.norms = ids, vectors, norms
        self.longest, self.shortest = float(norms[0]), float(norms[-1])
        unit = vectors / np.maximum(norms, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.values = np.asfortranarray(np.take_along_axis(unit, self.order, 0))
        self.order = np.asfortranarray(self.order)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, least: float) -> np.ndarray:
        """Vectors that may score ``least`` or more with the anchor ``unit`` * ``length``."""
        n = len(self.ids)
        reach = length * (self.longest if least > 0 else self.shortest)
        if least == -np.inf or reach == 0:
            return np.arange(n) if least <= 0 else np.arange(0)
        cosine = least / reach - SLACK
        if cosine > 1:
            return np.arange(0)
        if cosine <= -1:
            return np.arange(n)
        cap = np.arccos(cosine)
        found = np.zeros(n, np.int8)
        cuts = 0
        for f in focus.tolist():
            middle = np.arccos(unit[f])
            low, high = np.cos(min(np.pi, middle + cap)) - SLACK, np.cos(max(0.0, middle - cap)) + SLACK
            a, b = np.searchsorted(self.values[:, f], low, "left"), np.searchsorted(self.values[:, f], high, "right")
            found[self.order[a:b, f]] += 1
            cuts += 1
        return np.flatnonzero(found == cuts)


class Shard:
    """The buckets of a packed row."""

    def __init__(self, row: dict, bucket: int = BUCKET):
        ids = np.frombuffer(row["ids"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1)
        norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.buckets = [Bucket(ids[a : a + bucket], vectors[a : a + bucket], norms[a : a + bucket]) for a in range(0, len(ids), bucket)]

    def search(self, query: np.ndarray, own: int, k: int, least: float, windows: list[tuple[int, int]] | None = None, focus: int = FOCUS) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k best (scores, ids) without ``own`` in each window (lowest, highest score), ties to smaller ids.

        Without windows there is one that holds all scores. least: lower scores need not be found.
        """
        limits = windows if windows is not None else [(None, None)]
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in limits]
        length = float(np.sqrt((query.astype(float) ** 2).sum()))
        unit = query / length if length else query.astype(float)
        largest = np.argsort(-np.abs(unit), kind="stable")[:focus]
        for bucket in self.buckets:
            bound = length * bucket.longest
            if bound * (1 + SLACK) < least:
                break
            rows = bucket.candidates(unit, largest, length, least)
            if not len(rows):
                continue
            scores, ids = bucket.vectors[rows] @ query, bucket.ids[rows]
            fine = (scores >= least) & (ids != own)
            scores, ids = scores[fine], ids[fine]
            order = np.lexsort((ids, -scores))
            scores, ids = scores[order], ids[order]
            floors = []
            for w, (low, high) in enumerate(limits):
                a = 0 if high is None else int(np.searchsorted(-scores, -high, "left"))
                b = len(scores) if low is None else int(np.searchsorted(-scores, -low, "right"))
                if a < b:
                    part = scores[a : min(b, a + k)], ids[a : min(b, a + k)]
                    both = np.concatenate([best[w][0], part[0]]), np.concatenate([best[w][1], part[1]])
                    keep = np.lexsort((both[1], -both[0]))[:k]
                    best[w] = both[0][keep], both[1][keep]
                floors.append(best[w][0][-1] if len(best[w][0]) == k else -np.inf if low is None else low)
            least = max(least, float(min(floors)))
        return best


def _met(blocks: DataFrame, parts: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on every pair of ``blocks`` (block, shard, anchors...) and shard."""
    pairs = blocks.select("block", "shard").distinct()
    opened = parts.join(pairs, "shard")
    asked = blocks.select(*(F.col(c).alias(c) for c in blocks.columns))  # a frame of its own

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [x for row in right.to_pylist() for x in run(left, Shard(row))]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * len(schema.split(",")), names=[c.split()[0] for c in schema.split(", ")])

    return asked.groupBy("shard", "block").cogroup(opened.groupBy("shard", "block")).applyInArrow(both, schema)


def _ranked(rows: DataFrame, by: list[str], id_col: str, k: int, score: str = "score") -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), id_col)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best_of_label(anchors: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """(anchor_id, vec_id, score): each anchor's ``k`` best other vectors of its label.

    anchors: rows (block, anchor_id, label, dim, v, norm).
    """

    def run(left: pa.Table, shard: Shard):
        for name, v, least in zip(left["anchor_id"].to_pylist(), left["v"].to_pylist(), left["least"].to_pylist(), strict=True):
            scores, ids = shard.search(np.array(v, np.int64), name, k, -np.inf if least is None else least)[0]
            yield from zip([name] * len(ids), ids.tolist(), scores.tolist(), strict=True)

    schema = "anchor_id long, vec_id long, score long"
    ranges = stored(parts.select("shard", "dim", "label", "longest"), "ranges")
    first = ranges.groupBy("dim", "label").agg(F.max_by("shard", F.struct("longest", -F.col("shard"))).alias("shard"))
    sent = anchors.join(first, ["dim", "label"]).select("block", "shard", "anchor_id", "v", F.lit(None).cast("double").alias("least"))
    found = stored(_met(sent, parts, run, schema), "positives")
    # The k-th best so far is what other shards have to reach.
    least = found.groupBy("anchor_id").agg(F.when(F.count("score") >= k, F.min("score")).cast("double").alias("least"))
    others = ranges.join(first.select("shard"), "shard", "left_anti")
    open_ = F.col("least").isNull() | (F.col("norm") * F.col("longest") * (1 + 1e-6) >= F.col("least"))
    more = anchors.join(least, "anchor_id", "left").join(others, ["dim", "label"]).filter(open_).select("block", "shard", "anchor_id", "v", "least")
    return _ranked(found.unionByName(_met(more, parts, run, schema)), ["anchor_id"], "vec_id", k).drop("rank")


def in_windows(anchors: DataFrame, positives: DataFrame, parts: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """(anchor_id, positive_id, negative_id, positive_score, negative_score): for each positive the ``k`` best vectors
    of other labels whose score lies between ``low`` and ``high`` hundredths of the positive's.

    anchors: rows (block, anchor_id, label, dim, v, norm); positives: (anchor_id, vec_id, score).
    """

    def run(left: pa.Table, shard: Shard):
        columns = [left[c].to_pylist() for c in ("anchor_id", "v", "wanted")]
        for name, v, wanted in zip(*columns, strict=True):
            # Integers n with low * p <= 100 n <= high * p.
            windows = [(-(-low * w["score"] // 100), high * w["score"] // 100) for w in wanted]
            best = shard.search(np.array(v, np.int64), name, k, float(min(w[0] for w in windows)), windows)
            for w, (scores, ids) in zip(wanted, best, strict=True):
                for score, other in zip(scores.tolist(), ids.tolist(), strict=True):
                    yield name, w["vec_id"], other, w["score"], score

    # No integer lies between the bounds of a negative score.
    wanted = positives.filter("score >= 0").groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("wanted"), F.min("score").alias("least"))
    ranges = parts.select("shard", "dim", F.col("label").alias("other"), "longest")
    reached = F.col("norm") * F.col("longest") * (1 + 1e-6) >= F.col("least") * (low / 100)
    pairs = anchors.join(wanted, "anchor_id").join(ranges, "dim").filter((F.col("label") != F.col("other")) & reached)
    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = _met(pairs.select("block", "shard", "anchor_id", "v", "wanted"), parts, run, schema)
    return _ranked(found, ["anchor_id", "positive_id", "positive_score"], "negative_id", k, "negative_score")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, shard: int = SHARD, block: int = ANCHORS) -> DataFrame:
    """Hard negatives of every anchor among ``vectors`` (vec_id, label, v), whose ids are unique.

    An anchor's positives are the ``positives`` best other rows of its label. For each of them the
    ``negatives`` best rows of other labels are returned whose score is between ``low`` and ``high`` hundredths of the
    positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Higher scores come
    first, ties go to smaller ids. Vectors of different lengths never meet. An anchor without
    such rows gives none, an empty table an empty one. Scores must fit 64 bits.
    """
    vectors = stored(vectors, "vectors")
    parts = shards(vectors, shard)
    asked = vectors.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", F.size("v").alias("dim"), "v", _norm("v").alias("norm"))
    blocks = max(1, -(-asked.count() // block))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")), "anchors")
    best = stored(best_of_label(asked, parts, positives), "best")
    found = in_windows(asked, best, parts, negatives, low, high)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
