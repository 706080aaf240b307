"""Cut the timeline of a key into slices, so no key has to fit in one task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"


def _zoneless(df: DataFrame, ts: str) -> bool:
    return df.schema[ts].dataType.typeName() == "timestamp_ntz"


def time_slice(df: DataFrame, ts: str, width: dt.timedelta) -> Column:
    """Start second of the slice ``ts`` lies in; NULL for NULL.

    Two times in one slice are less than ``width`` apart, and slices order like
    the times in them.
    """
    seconds = int(width.total_seconds())
    if seconds < 1:
        raise ValueError("a time slice must be at least one second wide")
    if _zoneless(df, ts):
        whole = (
            F.unix_date(F.to_date(ts)).cast("bigint") * 86400
            + F.hour(ts) * 3600
            + F.minute(ts) * 60
            + F.second(ts)
        )
    else:
        whole = F.unix_seconds(F.col(ts))
    return whole - F.pmod(whole, F.lit(seconds).cast("bigint"))


def is_after(
    df: DataFrame, ts: str, later: Column, earlier: Column, gap: dt.timedelta
) -> Column:
    """``later > earlier + gap``, in elapsed time for both timestamp types."""
    if _zoneless(df, ts):
        return later > earlier + F.lit(gap)
    micros = gap // dt.timedelta(microseconds=1)
    return F.unix_micros(later) > F.unix_micros(earlier) + F.lit(micros)
