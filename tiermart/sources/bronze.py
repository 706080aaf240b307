"""Raw nested payloads archived by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions import fixed


def day_parts(day: Column) -> dict[str, Column]:
    """Zero-padded year, month and day folder values."""
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }


def envelope(record: str) -> str:
    return f"items array<struct<{record}>>"


def parse_records(text: Column, record: str) -> Column:
    return F.from_json(text, record)


def unwrap(payloads: DataFrame) -> DataFrame:
    """One row per element of ``items``; a payload without items gives none."""
    return payloads.select(F.explode("items").alias("item")).select("item.*")


def read_payloads(
    spark: SparkSession, path: str, record: str, whole_file: bool = True
) -> DataFrame:
    """Records of raw payload files, one pretty-printed payload per file.

    Payloads written one per line (``whole_file=False``) can be split over tasks.
    """
    files = spark.read.schema(envelope(record)).option("multiLine", whole_file)
    return unwrap(files.json(path))


def archive_payloads(payloads: DataFrame, day: str, path: str) -> None:
    """Append the payloads that hold items to ``year=/month=/day=`` folders.

    Rows are gathered by day first, so that a run does not leave one file per
    task and day; days too large for one task are split again.
    """
    held = payloads.where(F.size("items") > 0).select(
        *[c for c in payloads.columns if c != day],
        *[part.alias(name) for name, part in day_parts(F.col(day)).items()],
    )
    by_day = held.hint("rebalance", "year", "month", "day")
    by_day.write.mode("append").partitionBy("year", "month", "day").json(path)


def in_window(day: Column, as_of: dt.date, days: int = fixed.RELOAD_DAYS) -> Column:
    """True for ``as_of`` and the ``days - 1`` days before it."""
    first = as_of - dt.timedelta(days=days - 1)
    return day.between(F.lit(first), F.lit(as_of))


def read_bronze(
    spark: SparkSession,
    path: str,
    record: str,
    as_of: dt.date,
    days: int = fixed.RELOAD_DAYS,
) -> DataFrame:
    """Records of the trailing days; other day folders are pruned, not scanned."""
    archive = spark.read.schema(
        f"{envelope(record)}, year int, month int, day int"
    ).json(path)
    folder_day = F.make_date("year", "month", "day")
    return unwrap(archive.where(in_window(folder_day, as_of, days)))
