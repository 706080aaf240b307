"""Shortage snapshots consolidated into an interval history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.operators.changes import set_end_dates
from tiermart.operators.intervals import islands, not_contained
from tiermart.operators.latest import latest_by_key, newest, oldest
from tiermart.operators.slices import is_after

KEYS = fixed.SHORTAGE_KEYS
GAP = dt.timedelta(hours=fixed.SHORTAGE_GAP_HOURS)
LOOKBACK = dt.timedelta(days=fixed.SHORTAGE_LOOKBACK_DAYS)


def known_facilities(snapshots: DataFrame) -> DataFrame:
    return snapshots.where(F.trim("facility_id") != "")


def shortage_periods(snapshots: DataFrame, gap: dt.timedelta = GAP) -> DataFrame:
    return islands(known_facilities(snapshots), KEYS, "snapshot_timestamp", gap)


def _valid(intervals: DataFrame) -> DataFrame:
    return intervals.where(F.col("end_date") >= F.col("start_date"))


def open_baseline(
    history: DataFrame,
    as_of: dt.date,
    lookback: dt.timedelta = LOOKBACK,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Latest valid interval per key among those that ended within ``lookback``."""
    since = F.lit(as_of - lookback).cast(history.schema["end_date"].dataType)
    recent = _valid(history).where(F.col("end_date") >= since)
    columns = [*keys, "start_date", "end_date"]
    return latest_by_key(recent.select(*columns), keys, newest("end_date", "start_date"))


def match_baseline(
    periods: DataFrame,
    baseline: DataFrame,
    gap: dt.timedelta = GAP,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Periods with the open interval of their key, if the first of them touches it.

    ``extends`` marks that first period, ``history_start_date`` names the interval
    and ``new_end_date`` its end from now on, on every period of the key.
    """
    in_key = Window.partitionBy(*keys)
    first = F.row_number().over(in_key.orderBy(*oldest("start_date", "end_date"))) == 1
    opened = baseline.withColumnsRenamed(
        {"start_date": "history_start_date", "end_date": "history_end_date"}
    )
    paired = periods.withColumn("_first", first).join(opened, list(keys), "left")
    too_late = is_after(
        periods, "start_date", F.col("start_date"), F.col("history_end_date"), gap
    )
    touches = ~too_late & (F.col("end_date") >= F.col("history_start_date"))
    marked = paired.withColumn("extends", F.coalesce(F.col("_first") & touches, F.lit(False)))
    new_end = F.max(F.when(F.col("extends"), F.col("end_date"))).over(in_key)
    return marked.withColumn("new_end_date", new_end).drop("_first", "history_end_date")


def find_extensions(matched: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Open intervals that get a new end, even if it is earlier than the old one."""
    return matched.where("extends").select(*keys, "history_start_date", "new_end_date")


def find_inserts(
    matched: DataFrame, history: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """New valid periods that neither extended an interval nor lie inside one.

    Containment is judged against the history before it is extended.
    """
    used = F.coalesce(F.col("end_date") == F.col("new_end_date"), F.lit(False))
    return not_contained(_valid(matched).where(~used), history, keys)


def consolidate(
    history: DataFrame,
    periods: DataFrame,
    as_of: dt.date,
    gap: dt.timedelta = GAP,
    lookback: dt.timedelta = LOOKBACK,
    keys: Sequence[str] = KEYS,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Next history: extended intervals plus the new stand-alone ones.

    The matched periods are read for both and for the oldest end that matters; ``stage`` may
    store them, so that they are computed once.
    """
    baseline = open_baseline(history, as_of, lookback, keys)
    matched = stage(match_baseline(periods, baseline, gap, keys))
    updated = set_end_dates(history, find_extensions(matched, keys), keys)
    inserts = find_inserts(matched, history, keys)
    return updated.unionByName(inserts, allowMissingColumns=True)
