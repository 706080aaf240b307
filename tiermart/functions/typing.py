"""Tolerant casts: a bad value becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOCK = r"(\d{2}:\d{2}:\d{2})"


def as_long(value: Column) -> Column:
    return value.try_cast("bigint")


def clock_text(value: Column, tolerant: bool = False) -> Column:
    """``HH:mm:ss`` out of a time that may carry a date before it.

    The default takes the last eight characters, which is wrong for fractional
    seconds; ``tolerant`` finds the clock wherever it stands.
    """
    text = value.cast("string")
    if not tolerant:
        return F.right(text, F.lit(8))
    found = F.regexp_extract(text, CLOCK, 1)
    return F.when(found != "", found)


def split_types(df: DataFrame, name: str) -> DataFrame:
    """Replace a column of mixed text by one column per observed type."""
    number = as_long(F.col(name))
    return df.withColumns(
        {
            f"{name}_long": number,
            f"{name}_string": F.when(number.isNull(), F.col(name)),
        }
    ).drop(name)
