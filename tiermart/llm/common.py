"""What the operators share: table access, folds, stored intermediate tables."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.sinks.bucketed import settings
from tiermart.sinks.tables import shared_folder

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 2000  # of a batch that goes to Python and back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """Fold of a row: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def fresh(columns: list[str], name: str) -> str:
    """``name`` with as many marks before it as no column begins with, in any case of letters."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name = "_" + name
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to a folder that all executors share and read from there."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    # Texts and sets make rows long: small batches keep the memory outside the heap small.
    held = int(spark.conf.get(BATCH))
    with settings(spark, {BATCH: str(ROWS if held <= 0 else min(held, ROWS))}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Freed memory goes back to the machine, since Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
