"""Gap-and-island intervals over snapshots, and interval containment.

Snapshots are first reduced per key and time slice. With slices no wider than
the gap, all snapshots of a slice belong to one island, so the windows that run
over a whole key see one row per slice instead of one per snapshot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.operators.slices import SLICE, is_after, time_slice

COPIES_PER_TASK_ROW = 100_000
ROW_SLICE = dt.timedelta(hours=1)
SECOND = dt.timedelta(seconds=1)


def _slice_heads(
    df: DataFrame, keys: Sequence[str], ts: str, gap: dt.timedelta, width: dt.timedelta
) -> DataFrame:
    """One row per key and slice, with the end of the slice before it.

    Snapshots without a time form the last slice of their key.
    """
    per_slice = df.groupBy(*keys, time_slice(df, ts, width).alias(SLICE)).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_n")
    )
    in_key = Window.partitionBy(*keys).orderBy(F.col(SLICE).asc_nulls_last())
    previous = per_slice.withColumn("_previous", F.lag("_last").over(in_key))
    breaks = F.col("_previous").isNull() | is_after(
        df, ts, F.col("_first"), F.col("_previous"), gap
    )
    return previous.withColumn("_opens", F.when(breaks, 1).otherwise(0))


def _running(flag: Column, keys: Sequence[str]) -> Column:
    in_key = Window.partitionBy(*keys).orderBy(F.col(SLICE).asc_nulls_last())
    return F.sum(flag).over(in_key.rowsBetween(Window.unboundedPreceding, 0))


def islands(df: DataFrame, keys: Sequence[str], ts: str, gap: dt.timedelta) -> DataFrame:
    """``start_date`` and ``end_date`` of every run of snapshots without a gap.

    A run breaks only where the next snapshot is more than ``gap`` later. A key
    with several snapshots without a time, or only such, has one all-NULL run.
    """
    heads = _slice_heads(df, keys, ts, gap, width=gap)
    timeless = F.col(SLICE).isNull() & (F.col("_n") > 1)
    opens = F.when(timeless, 1).otherwise(F.col("_opens"))
    numbered = heads.withColumn("_island", _running(opens, keys))
    runs = numbered.groupBy(*keys, "_island").agg(
        F.min("_first").alias("start_date"), F.max("_last").alias("end_date")
    )
    return runs.drop("_island")


def island_rows(
    df: DataFrame, keys: Sequence[str], ts: str, gap: dt.timedelta
) -> DataFrame:
    """Every snapshot with the one before it and its island.

    Adds ``previous_timestamp``, ``is_new_period_start`` (0 or 1) and
    ``period_group_id`` (1, 2, … per key). Equal snapshots are counted before
    the shuffle and written out again at the end. Times are gathered by second, seconds by hour and
    hours by key, and each level carries in what came before it: no task holds more of a key than
    the times of one second, the seconds of an hour or the hours of the key.
    """
    width = min(gap, ROW_SLICE)
    heads = _slice_heads(df, keys, ts, gap, width).withColumn(
        "_island", _running(F.col("_opens"), keys)
    )
    instants = df.groupBy(*keys, F.col(ts)).agg(F.count("*").alias("_copies"))
    seconds = instants.groupBy(
        *keys,
        time_slice(instants, ts, width).alias(SLICE),
        time_slice(instants, ts, SECOND).alias("_second"),
    ).agg(F.array_sort(F.collect_list(F.struct(ts, "_copies"))).alias("_times"))
    head_rows = heads.select(*keys, SLICE, "_previous", "_opens", "_island")
    lined_up = seconds.unionByName(head_rows, allowMissingColumns=True)

    # The head of a slice is its only row without times and sorts first.
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(
        F.col("_times").isNotNull(), F.col("_second")
    )
    of_head = {c: F.first(c).over(in_slice) for c in ("_previous", "_opens", "_island")}
    within = F.lag(F.element_at("_times", -1)[ts]).over(in_slice)
    first_second = F.col("_within").isNull()
    in_order = (
        lined_up.withColumns({**of_head, "_within": within})
        .where(F.col("_times").isNotNull())
        .withColumns(
            {
                "_previous": F.coalesce("_within", "_previous"),
                "_opens": F.when(first_second, F.col("_opens")).otherwise(0),
            }
        )
    )
    # Times of one second follow each other; only its first one looks back.
    placed = in_order.select(
        *keys, SLICE, "_previous", "_opens", "_island", "_times", F.posexplode("_times").alias("_at", "_time")
    ).select(
        *keys,
        SLICE,
        F.col("_time")[ts].alias(ts),
        F.col("_time._copies").alias("_copies"),
        F.when(F.col("_at") == 0, F.col("_previous")).otherwise(F.get("_times", F.col("_at") - 1)[ts]).alias("_previous"),
        F.when(F.col("_at") == 0, F.col("_opens")).otherwise(0).alias("_opens"),
        "_island",
    )
    copies = _repeat(placed, [*keys, SLICE, ts])

    # Among equal times only the first opens a run. Each snapshot without a time
    # after the first has no previous time, so it opens a run of its own.
    repeated = F.col("_copy") > 1
    timeless = F.col(ts).isNull()
    return copies.select(
        *keys,
        ts,
        F.when(repeated, F.col(ts)).otherwise(F.col("_previous")).alias("previous_timestamp"),
        F.when(repeated, timeless.cast("int"))
        .otherwise(F.col("_opens"))
        .alias("is_new_period_start"),
        (F.col("_island") + F.when(timeless, F.col("_copy") - 1).otherwise(0)).alias(
            "period_group_id"
        ),
    )


def _repeat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row ``_copies`` times, numbered by ``_copy``, spread over tasks."""
    step = F.lit(COPIES_PER_TASK_ROW).cast("bigint")
    blocks = df.withColumn(
        "_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"), step))
    ).repartition(*keys, "_from")
    last = F.least(F.col("_from") + step - 1, F.col("_copies"))
    return blocks.withColumn("_copy", F.explode(F.sequence("_from", last)))


def not_contained(
    intervals: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    width: dt.timedelta = ROW_SLICE,
) -> DataFrame:
    """``intervals`` that lie inside none of ``others`` of the same key.

    An interval is contained when the farthest end among the others that start
    no later reaches its own end. That farthest end is a running maximum, so no
    pairs are formed: it is carried from slice to slice of the start times, and
    followed row by row only inside a slice. Others that end before any interval
    does contain nothing and are left out of the shuffle. NULL keys
    match nothing.
    """
    columns = [*keys, "start_date", "end_date"]
    usable = F.lit(True)
    for key in [*keys, "start_date"]:
        usable = usable & F.col(key).isNotNull()
    floor = intervals.agg(F.min("end_date")).scalar()
    reach = (
        others.where(usable & (F.col("end_date") >= floor))
        .groupBy(*keys, "start_date")
        .agg(F.max("end_date").alias("_end"))
    )
    asked = intervals.select(*columns).withColumn("_asked", F.lit(True))
    lined_up = asked.unionByName(reach, allowMissingColumns=True)
    lined_up = lined_up.withColumn(SLICE, time_slice(lined_up, "start_date", width))

    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        lined_up.groupBy(*keys, SLICE)
        .agg(F.max("_end").alias("_slice_end"))
        .withColumn("_end", F.max("_slice_end").over(before))
        .where(F.col("_end").isNotNull())
        .select(*keys, SLICE, "_end")
    )

    # Carried rows have no start and sort first, asked rows last among equals.
    so_far = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(F.col("start_date").asc_nulls_first(), F.col("_asked").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    judged = lined_up.unionByName(carried, allowMissingColumns=True).withColumn(
        "_reach", F.max("_end").over(so_far)
    )
    outside = ~F.coalesce(F.col("_reach") >= F.col("end_date"), F.lit(False))
    return judged.where(F.col("_asked") & outside).select(*columns)
