"""Supplier files: missing products and depot master data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.sources.delimited import read_delimited


def _trimmed(df: DataFrame, keys: Sequence[str], run_ts: Column | None) -> DataFrame:
    """Trimmed ``keys`` and the load time. Rows have no order: a stored table keeps none."""
    stamp = F.current_timestamp() if run_ts is None else run_ts
    trimmed = df.withColumns({key: F.trim(key) for key in keys})
    return trimmed.withColumn("record_timestamp", stamp)


def ingest_missing_products(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    columns = [*fixed.MISSING_PRODUCT_COLUMNS, "filename"]
    return _trimmed(df.select(*columns), fixed.MISSING_PRODUCT_COLUMNS, run_ts)


def ingest_depots(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    renamed = df.withColumnsRenamed(fixed.DEPOT_NAMES)
    return _trimmed(renamed, list(fixed.DEPOT_NAMES.values()), run_ts)


def read_missing_products(spark: SparkSession, folder: str) -> DataFrame:
    return read_missing_product_files(spark, f"{folder.rstrip('/')}/{fixed.MISSING_PRODUCT_FILES}")


def read_missing_product_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_delimited(spark, path, fixed.MISSING_PRODUCT_COLUMNS, sep=";")


def read_depots(spark: SparkSession, folder: str) -> DataFrame:
    return read_depot_files(spark, f"{folder.rstrip('/')}/{fixed.DEPOT_FILES}")


def read_depot_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_delimited(spark, path, fixed.DEPOT_COLUMNS, sep=";", fixed_layout=True)
