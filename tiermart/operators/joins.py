"""Joins that stay balanced when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a ``right`` that was grouped by ``keys``.

    Spark splits a skewed join input only when both shuffles feed the join
    directly. The grouping of ``right`` would otherwise provide its shuffle, so a
    hash of the keys joins in: it changes no match, but gives ``right`` a shuffle
    of its own, over the few rows left after grouping. It also comes first in the
    sorts, which it decides without comparing the keys.
    """
    spread = F.xxhash64(*keys)
    joined = left.withColumn("_spread", spread).join(
        right.withColumn("_spread", spread), ["_spread", *keys], "left"
    )
    return joined.drop("_spread")


def without_matches(
    df: DataFrame, other: DataFrame, keys: Sequence[str], hot: bool = False
) -> DataFrame:
    """Rows of ``df`` whose ``keys`` do not occur in ``other``; NULL never matches.

    ``other`` is reduced to its distinct keys before the shuffle. Grouping keeps
    the order of ``keys``, so the join needs no second shuffle of either side.
    Set ``hot`` where many rows of ``df`` may share a key: both sides then get a
    shuffle of their own, which lets Spark split that key.
    """
    known = other.groupBy(*keys).agg(F.lit(True).alias("_known"))
    if not hot:
        return df.join(known, list(keys), "left_anti")
    spread = F.xxhash64(*keys)
    known = known.withColumn("_spread", spread)
    apart = df.withColumn("_spread", spread).join(known, ["_spread", *keys], "left_anti")
    return apart.drop("_spread")
