"""Pairs of intervals of one key that overlap, with a tolerance.

Time is cut into bins. An interval stands in every bin it reaches, and a pair is made in one bin only, the one in which
the later of the two begins; so no pair is made twice, a key's pairs are spread over its bins, and the join is one of
equal keys and bins that Spark can sort, or split where a bin is crowded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.operators.slices import time_slice

BIN = "_bin"


def _reached(df: DataFrame, start: str, end: str, width: dt.timedelta) -> Column:
    """First seconds of the bins from the one of ``start`` to that of ``end``."""
    seconds = F.lit(int(width.total_seconds())).cast("bigint")
    return F.sequence(time_slice(df, start, width), time_slice(df, end, width), seconds)


def overlapping(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    tolerance: dt.timedelta = dt.timedelta(0),
    width: dt.timedelta = dt.timedelta(days=1),
    start: str = "start_date",
    end: str = "end_date",
    prefix: str = "other_",
) -> DataFrame:
    """Every row of ``left`` with each row of ``right`` of its key that it overlaps.

    Two intervals overlap if neither begins more than ``tolerance`` after the other has ended; as ends are inclusive,
    touching ones do. Columns of ``right`` but the keys get the ``prefix``. Intervals without a start or end, or that end
    before they start, and rows with a NULL key pair with nothing. Choose ``width`` about as wide as most intervals: an
    interval is copied into every bin it reaches.
    """

    def fine(df: DataFrame) -> DataFrame:
        return df.where(F.col(end) >= F.col(start)).withColumn("_until", F.col(end) + F.lit(tolerance))

    a, b = fine(left), fine(right)
    a = a.withColumn(BIN, F.explode(_reached(a, start, "_until", width)))
    named = {c: f"{prefix}{c}" for c in right.columns if c not in keys}
    b = b.withColumn(BIN, F.explode(_reached(b, start, "_until", width)))
    b = b.withColumnsRenamed({**named, "_until": f"{prefix}_until"})
    other_start, other_until = f"{prefix}{start}", f"{prefix}_until"
    pairs = a.join(b, [*keys, BIN]).where((F.col(start) <= F.col(other_until)) & (F.col(other_start) <= F.col("_until")))
    # The bin of the later start is reached by both.
    home = time_slice(pairs.withColumn("_later", F.greatest(start, other_start)), "_later", width)
    return pairs.withColumn("_later", F.greatest(start, other_start)).where(F.col(BIN) == home).drop(BIN, "_until", other_until, "_later")
