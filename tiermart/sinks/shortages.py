"""Stored shortage history, of which a run replaces only the months it changes, all of them in one commit.

A run writes the new content of its months beside the old and commits it as the next state, so readers see a
run as a whole. A run of a stream notes its batch with that commit and is skipped when it is repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiermart.operators.changes import set_end_dates
from tiermart.plans import shortages
from tiermart.sinks import states, tables

HISTORY = "shortage_history"
MONTH = "start_month"


def _month(start: str) -> Column:
    return F.year(start) * 100 + F.month(start)


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/{HISTORY}"


def _write(intervals: DataFrame, root: str) -> dict[str, str]:
    return states.write_parts(intervals.withColumn(MONTH, _month("start_date")), _path(root), str, MONTH)[0]


def create_history(history: DataFrame, root: str) -> None:
    """First state of a history; an empty one keeps a folder without rows, which tells the columns."""
    spark = history.sparkSession
    folders = _write(history, root)
    if not folders:
        history.withColumn(MONTH, _month("start_date")).write.parquet(f"{_path(root)}/data/none")
        folders = {"none": "data/none"}
    states.commit(spark, _path(root), states.State(), folders)


def open_history(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest state, with their ``start_month``."""
    return states.open_parts(spark, _path(root), states.read_state(spark, _path(root)))


def run_consolidation(
    snapshots: DataFrame,
    root: str,
    as_of: dt.date,
    gap: dt.timedelta = shortages.GAP,
    lookback: dt.timedelta = shortages.LOOKBACK,
    batch: tuple[str, int] | None = None,
) -> int:
    """Consolidate new snapshots into the stored history; returns the rows inserted.

    ``batch`` names a stream and the number of its batch: what was committed for that batch or a later one is
    not applied again. Fails with ``states.Conflict`` if another run commits meanwhile.
    """
    spark = snapshots.sparkSession
    state = states.read_state(spark, _path(root))
    if batch is not None and state.notes.get(batch[0], -1) >= batch[1]:
        return 0
    notes = {} if batch is None else {batch[0]: batch[1]}
    history = states.open_parts(spark, _path(root), state)

    with tables.staging(spark, "shortages") as folder:
        # Matches and inserts are read several times, so they are stored once.
        baseline = shortages.open_baseline(history, as_of, lookback)
        periods = shortages.shortage_periods(snapshots, gap)
        shortages.match_baseline(periods, baseline, gap).write.parquet(f"{folder}/matched")
        matched = spark.read.parquet(f"{folder}/matched")
        shortages.find_inserts(matched, history).write.parquet(f"{folder}/inserts")
        inserts = spark.read.parquet(f"{folder}/inserts")
        extensions = shortages.find_extensions(matched)

        starts = extensions.select(_month("history_start_date").alias(MONTH)).unionByName(
            inserts.select(_month("start_date").alias(MONTH))
        )
        # At most one row per calendar month.
        months = {str(row[MONTH]) for row in starts.distinct().collect()}
        if months:
            # Months that are named in the state are read from their folders only.
            before = states.open_parts(spark, _path(root), state, months.__contains__)
            after = inserts
            if before is not None:
                kept = set_end_dates(before.drop(MONTH), extensions, shortages.KEYS)
                after = kept.unionByName(inserts, allowMissingColumns=True)
            states.commit(spark, _path(root), state, _write(after, root), notes)
        elif notes:
            states.commit(spark, _path(root), state, {}, notes)
        return inserts.count()


def consolidate_stream(
    snapshots: DataFrame,
    root: str,
    checkpoint: str,
    as_of: dt.date | None = None,
    gap: dt.timedelta = shortages.GAP,
    lookback: dt.timedelta = shortages.LOOKBACK,
    name: str = "shortages",
) -> StreamingQuery:
    """Consolidate a stream of snapshots into the stored history, each batch once however often it is run.

    A batch is applied as ``run_consolidation`` applies its snapshots. "Today" is ``as_of`` or else the day of the batch's newest
    snapshot. ``name`` tells streams apart that feed one history.
    """

    def apply(batch: DataFrame, number: int) -> None:
        day = as_of or batch.agg(F.max(F.to_date("snapshot_timestamp"))).first()[0]
        if day is not None:
            run_consolidation(batch, root, day, gap, lookback, (name, number))

    writer = snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
