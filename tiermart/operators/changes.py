"""Next state of a table as a DataFrame: swap, append and interval update."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_where(table: DataFrame, condition: Column) -> DataFrame:
    """Rows a delete by ``condition`` leaves, including those where it is NULL."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def is_active() -> Column:
    return F.col("history_prog_id") == 0


def swap_active(target: DataFrame, active: DataFrame) -> DataFrame:
    """Replace the active rows of ``target`` by all rows of ``active``.

    An empty ``active`` still removes the old active rows. Incoming rows with a
    history id are added and never removed, so they pile up over runs.
    """
    return drop_where(target, is_active()).unionByName(active)


def missing_rows(feed: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``feed`` whose key ``target`` does not hold yet; NULL never matches.

    A join would gather both sides by all keys. A window takes rows where they lie if they are gathered by
    some of the keys, such as the order, and a rank needs no more than a row at a time.
    """
    complete = reduce(and_, (F.col(key).isNotNull() for key in keys))
    known = target.select(*keys).where(complete).distinct().withColumn("_known", F.lit(True))
    both = feed.withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col("_known").desc()))
    return both.withColumn("_rank", rank).where("_rank = 1 AND NOT _known").select(*feed.columns)


def append_missing(
    target: DataFrame, feed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``target`` plus the rows of ``feed`` it does not hold; none is updated.

    A row with a NULL key matches nothing and is appended on every run.
    """
    return target.unionByName(missing_rows(feed, target, keys))


def set_end_dates(
    history: DataFrame, extensions: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """History with the end of every extended interval replaced.

    ``extensions`` holds at most one ``history_start_date`` and ``new_end_date``
    per key. The new end may be earlier than the old one.
    """
    changed = extensions.withColumnRenamed("history_start_date", "start_date")
    joined = history.join(changed, [*keys, "start_date"], "left")
    return joined.withColumn(
        "end_date", F.coalesce("new_end_date", "end_date")
    ).select(*history.columns)
