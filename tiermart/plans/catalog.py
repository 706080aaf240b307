"""Product catalogue: pruned, renamed and dated by file name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.functions.names import name_date
from tiermart.operators.latest import latest_by_key, newest
from tiermart.sources.delimited import read_delimited


def conform_names(df: DataFrame) -> DataFrame:
    """Catalogue columns under their conformed names; others keep theirs."""
    return df.withColumnsRenamed(fixed.CATALOG_NAMES)


def standardise_catalog(
    df: DataFrame, dedup: bool = False, run_ts: Column | None = None
) -> DataFrame:
    """Conformed catalogue of raw columns plus ``filename``.

    ``dedup`` keeps the row of the newest file per product, and ``run_ts`` adds
    an ``ingestion_timestamp``.
    """
    dated = conform_names(df).withColumn("record_date", name_date(F.col("filename")))
    if dedup:
        rest = [c for c in dated.columns if c not in ("ext_product_code", "record_date")]
        # A file without a date must not win over a dated one.
        order = [F.col("record_date").desc_nulls_last(), *newest(*rest)]
        dated = latest_by_key(dated, ["ext_product_code"], order)
    dated = dated.drop("filename")
    return dated if run_ts is None else dated.withColumn("ingestion_timestamp", run_ts)


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return read_files(spark, f"{folder.rstrip('/')}/{fixed.CATALOG_FILES}")


def read_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_delimited(spark, path, fixed.CATALOG_COLUMNS)
