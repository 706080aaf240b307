"""Connected components of a stored graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import stored
from tiermart.operators.joins import left_join_unique


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); the component is its smallest id.

    Large-star and small-star steps in turn, each stored, until the edges stay the same: every
    node hangs its larger neighbours, then all its neighbours, on the smallest id it knows.
    A node with many neighbours is reduced to its minimum before the shuffle, and its edges join that
    minimum over a shuffle of their own, which Spark can split.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def mark(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last = mark(now)
    while last[0]:
        sym = _both(now)
        least = sym.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = left_join_unique(sym, least, ["a"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = left_join_unique(down, least, ["a"]).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        mine = mark(now)
        if mine == last:
            break
        last = mine
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
