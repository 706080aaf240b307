"""Ledger of processed files.

A file is known by path, modification time and size, so one that is sent again under its old
name is new. Each run of a load writes its rows to a folder of its own and
then commits it with the ledger's entries, which name that folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermart.operators.joins import without_matches
from tiermart.sinks.tables import append_rows

IDENTITY = ["path", "modified", "size"]
LEDGER = "filename string, path string, modified timestamp, size long, load_run long, processed_at timestamp"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def new_files(listing: DataFrame, ledger: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Distinct files, by their names or other columns, that the ledger does not hold."""
    return without_matches(listing.select(*by).distinct(), ledger, list(by))


def load_new_files(
    listing: DataFrame,
    read: Callable[[list[str]], DataFrame],
    target: str,
    ledger: str,
    run_ts: Column | None = None,
) -> int:
    """Read exactly the files of ``listing`` that the ledger lacks; returns the rows added.

    The listing is taken once: the files it names are read and the same files are recorded.
    Rows go to ``target/load_run=N``; a run that was cut short is written again under
    its number, and ``open_loaded`` shows only runs that the ledger holds.
    """
    spark = listing.sparkSession
    known = read_ledger(spark, ledger)
    # The files of one delivery, not their rows.
    unseen = without_matches(listing.distinct(), known, IDENTITY).select(*listing.columns).collect()
    if not unseen:
        return 0
    run = (known.agg(F.max("load_run")).first()[0] or 0) + 1
    folder = f"{target.rstrip('/')}/load_run={run}"
    rows = read(sorted({file.path for file in unseen}))
    added = _replace(rows, folder)
    stamp = F.current_timestamp() if run_ts is None else run_ts
    entries = spark.createDataFrame(unseen, listing.schema).select(
        "filename", *IDENTITY, F.lit(run).cast("long").alias("load_run"), stamp.alias("processed_at")
    )
    append_rows(entries.coalesce(1), ledger)
    return added


def _replace(rows: DataFrame, folder: str) -> int:
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    return seen.get["n"]


def open_loaded(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """The rows of all committed runs of a load, with their ``load_run``."""
    runs = [r[0] for r in read_ledger(spark, ledger).select("load_run").distinct().orderBy("load_run").collect()]
    if not runs:
        raise FileNotFoundError(f"{target} has no committed load")
    folders = [f"{target.rstrip('/')}/load_run={run}" for run in runs]
    return spark.read.option("basePath", target).parquet(*folders)
