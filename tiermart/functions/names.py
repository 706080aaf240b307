"""Columns derived from the name of the file a row came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiermart.functions import fixed


def file_name(path: Column) -> Column:
    """Last segment of a path or URI, with its URL escapes resolved.

    Spark escapes a space as ``%20`` but leaves ``+`` alone, while URL decoding
    reads ``+`` as a space, so ``+`` is escaped first.
    """
    name = F.element_at(F.split(path, "/"), -1)
    escaped = F.replace(name, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(escaped), name)


def source_file() -> Column:
    """Decoded name of the file the current row was scanned from."""
    return file_name(F.col("_metadata.file_name"))


def name_stamp(name: Column) -> Column:
    """``yyyyMMdd_HHmmss`` token of a file name, ``''`` when there is none."""
    return F.regexp_extract(name, fixed.NAME_STAMP, 1)


def name_date(name: Column) -> Column:
    """Midnight of the ``yyyyMMdd`` date in a file name, NULL when there is none."""
    token = F.regexp_extract(name, fixed.NAME_DATE, 1)
    return F.try_to_date(token, fixed.NAME_DATE_FORMAT).cast("timestamp")
