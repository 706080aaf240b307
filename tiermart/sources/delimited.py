"""Delimited files with a header, read as strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions.names import source_file


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    sep: str = ",",
    fixed_layout: bool = False,
    lenient: bool = False,
) -> DataFrame:
    """String ``columns`` plus ``filename`` of every file that ``path`` matches or lists.

    Columns are found by header name and others are skipped; ``fixed_layout``
    declares ``columns`` to be the whole file in this order. A file whose header
    disagrees fails the read unless ``lenient`` is set, because its values would
    otherwise land in the wrong columns. No matching file gives no rows.
    """
    layout = ", ".join(f"`{c}` string" for c in columns)
    reader = spark.read.options(header=True, sep=sep, enforceSchema=lenient)
    if fixed_layout:
        reader = reader.schema(layout)
    try:
        files = reader.csv(path if isinstance(path, str) else list(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{layout}, filename string")
    return files.select(*[F.col(c) for c in columns], source_file().alias("filename"))


LISTING = "filename string, path string, modified timestamp, size long"


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Decoded name, path, time and size of the files in ``folder``, whether or not they hold rows.

    File contents are not read, nor are folders below. An absent folder has no files.
    """
    try:
        found = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{pattern}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return found.select(
        source_file().alias("filename"), "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")
    )
