"""Incremental telemetry load: the rows newer than the target."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermart.operators.joins import without_matches
from tiermart.sinks import states
from tiermart.sinks.tables import append_rows
from tiermart.sources.incremental import days_since, incremental_delta, normalise_time, stamp_text

MARK = "mark"


def load_telemetry(
    spark: SparkSession, source: DataFrame, target_path: str, tolerant: bool = False
) -> int:
    """Append the delta to the parquet table at ``target_path``; returns its size.

    The first run, without a target, loads everything.
    """
    try:
        target = spark.read.parquet(target_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return append_rows(normalise_time(source, tolerant), target_path)
    return append_rows(incremental_delta(source, target, tolerant), target_path)


def load_with_mark(
    spark: SparkSession, source: DataFrame, root: str, overlap: dt.timedelta = dt.timedelta(days=1), tolerant: bool = False
) -> int:
    """Add the rows of ``source`` that the table at ``root`` lacks; returns how many.

    Each load commits its rows together with the largest stamp loaded so far, so the table is not
    read to find it. The next load reads again from ``overlap`` before that stamp: rows equal to it and
    late rows are not lost, and rows that are known are removed by a join with the stored rows of those
    days only. Rows without a date are read again each time, too. Equal rows count as one
    once they are known.
    """
    state = states.read_state(spark, root)
    mark = state.notes.get(MARK)
    fresh = normalise_time(days_since(source, mark, overlap), tolerant)
    stored = states.open_parts(spark, root, state)
    if stored is not None:
        known = days_since(stored, mark, overlap)
        fresh = without_matches(_identified(fresh), _identified(known), IDENTITY).drop(*IDENTITY)
    number = state.number + 1
    seen = Observation()
    newest = F.max(stamp_text("date", F.col("time"))).alias("newest")
    rows = fresh.withColumn("load_run", F.lit(number).cast("bigint")).observe(seen, newest)
    written, n_rows = states.write_parts(rows, root, lambda n: f"load/{n}", "load_run")
    if n_rows:
        states.commit(spark, root, state, written, {MARK: max(filter(None, (mark, seen.get["newest"])), default="")})
    return n_rows


IDENTITY = ["_row_1", "_row_2"]


def _identified(rows: DataFrame) -> DataFrame:
    """Two hashes over the values of all columns but the load's number."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rows.columns if c != "load_run"]
    return rows.withColumns({"_row_1": F.xxhash64(*values), "_row_2": F.xxhash64(F.lit(7), *values)})


def open_loads(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all loads with their ``load_run``."""
    found = states.open_parts(spark, root, states.read_state(spark, root))
    if found is None:
        raise FileNotFoundError(f"{root} has no committed load")
    return found
