"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(*names: str) -> list[Column]:
    """Descending order in which a NULL counts as the newest value."""
    return [F.col(name).desc_nulls_first() for name in names]


def oldest(*names: str) -> list[Column]:
    """Ascending order in which a NULL counts as the newest value."""
    return [F.col(name).asc_nulls_last() for name in names]


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """First row of every key under ``order``; NULL keys form a key of their own.

    ``order`` should leave no ties, else the surviving row is arbitrary. Spark
    limits each key to one row per task before the shuffle, so a key that holds
    most of the rows does not land in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
