"""High-watermark reads of a table that only grows."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.functions.typing import as_long, clock_text


def stamp_text(date: str, time: Column) -> Column:
    """``date time`` text; NULL when either is NULL."""
    return F.concat(F.col(date).cast("string"), F.lit(" "), time.cast("string"))


def watermark(target: DataFrame, date: str = "date", time: str = "time") -> DataFrame:
    """One row with the greatest ``date time`` text loaded so far, or NULL."""
    return target.agg(F.max(stamp_text(date, F.col(time))).alias("max_timestamp"))


def newer_than(
    source: DataFrame, mark: str | None, date: str = "date", time: str = "time"
) -> DataFrame:
    """Rows whose ``date time`` text is greater than ``mark``; all rows without one.

    The text comparison cannot reach the scan, so the date it implies is added
    as a plain predicate that can skip files and row groups.
    """
    if mark is None:
        return source
    newer = source.where(stamp_text(date, clock_text(F.col(time))) > F.lit(mark))
    day = mark.partition(" ")[0]
    # Sound only if every character of the day sorts after the separating space.
    if source.schema[date].dataType.typeName() == "string" and re.fullmatch(r"[!-~]+", day):
        newer = newer.where(F.col(date) >= F.lit(day))
    return newer


def days_since(source: DataFrame, mark: str | None, overlap: dt.timedelta, date: str = "date") -> DataFrame:
    """Rows of the days from ``overlap`` before ``mark`` on, and rows without a date; all rows without a readable mark.

    Compares days as text, which the scan can use to skip files and row groups.
    """
    found = re.match(r"\d{4}-\d{2}-\d{2}", mark or "")
    if not found:
        return source
    day = dt.date.fromisoformat(found[0]) - overlap
    return source.where((F.col(date) >= F.lit(day.isoformat())) | F.col(date).isNull())


def normalise_time(df: DataFrame, tolerant: bool = False) -> DataFrame:
    """Numeric ``id`` and a bare ``HH:mm:ss`` ``time``."""
    return df.withColumns(
        {"id": as_long(F.col("id")), "time": clock_text(F.col("time"), tolerant)}
    )


def with_event_time(df: DataFrame, date: str = "date", time: str = "time") -> DataFrame:
    """Adds ``event_ts``, the typed form of the two text columns, NULL if unreadable."""
    text = stamp_text(date, clock_text(F.col(time), tolerant=True))
    return df.withColumn("event_ts", text.try_cast("timestamp_ntz"))


def incremental_delta(
    source: DataFrame, target: DataFrame, tolerant: bool = False
) -> DataFrame:
    """Normalised source rows that are newer than everything in ``target``.

    The watermark is the one value fetched to the driver, so that it reaches
    the source scan as a literal.
    """
    return normalise_time(newer_than(source, stored_mark(target)), tolerant)


def stored_mark(target: DataFrame, date: str = "date", time: str = "time") -> str | None:
    """The watermark of a stored table: its newest day first, then the times of that day.

    The day is a scan of one narrow column, and the filter on it reaches the second scan,
    which skips files and row groups of other days. The two steps agree with ``watermark``
    where days sort like their stamps and the newest day has a time; else the whole is scanned.
    """
    day = target.agg(F.max(F.col(date).cast("string"))).first()[0]
    if day is not None and re.fullmatch(r"[!-~]+", day):
        mark = watermark(target.where(F.col(date) == F.lit(day)), date, time).first()["max_timestamp"]
        if mark is not None:
            return mark
    return watermark(target, date, time).first()["max_timestamp"]


def typed_delta(source: DataFrame, target: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Source rows later than every ``ts`` in ``target``; all rows when it is empty."""
    newest = F.max(ts)
    if source.schema[ts].dataType.typeName() == "timestamp_ntz":
        text = target.agg(newest.cast("string")).first()[0]
        mark = F.lit(text).cast("timestamp_ntz")
    else:
        text = target.agg(F.unix_micros(newest)).first()[0]
        mark = F.timestamp_micros(F.lit(text))
    return source if text is None else source.where(F.col(ts) > mark)
