"""Tables whose parts are hashed by key into the same buckets.

A part is a folder of its own, with one file for each bucket or more. All parts are read as one
catalog table, partitioned by part and bucketed by key, so that a join on the key
finds both sides in place: it needs no shuffle above the scan, however many parts there are.
Parts are merged bucket by bucket, also without a shuffle.

Catalog entries only describe folders; dropping one leaves the files.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiermart.sinks import tables

PART = "_part"
# Joins on more columns than rows are hashed by find them in place too, and so do unions of parts.
IN_PLACE = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A scan keeps its buckets although nothing right above it asks for them.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@dataclass(frozen=True)
class Layout:
    """Hashed by ``keys`` into ``buckets``; sorted by ``sort_by`` inside each.

    Rows that share all keys share a bucket, and a bucket is read by one task. So ``keys`` should
    tell rows apart well: a column of which one value holds much of the table is for ``sort_by``, where
    filters on its first columns skip row groups.
    """

    keys: tuple[str, ...]
    sort_by: tuple[str, ...]
    buckets: int

    def gathered(self, df: DataFrame) -> DataFrame:
        """The rows of a bucket in one task; no shuffle if ``df`` is hashed like that already."""
        return df.repartition(self.buckets, *self.keys)

    def clause(self) -> str:
        def quoted(names: Sequence[str]) -> str:
            return ", ".join(f"`{n}`" for n in names)

        return f"CLUSTERED BY ({quoted(self.keys)}) SORTED BY ({quoted(self.sort_by)}) INTO {self.buckets} BUCKETS"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _fields(schema: StructType) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]


def write_part(df: DataFrame, path: str, layout: Layout, gathered: bool = False) -> int:
    """Write ``df`` as the part at ``path``, in place of what is there; returns its rows.

    Rows are gathered by bucket first, unless they come ``gathered`` as scans of parts are. A
    bucket too large for a task is then written by several. Files are compressed by zstd, as each run writes wide rows.
    """
    spark = df.sparkSession
    name = f"tiermart_part_{uuid.uuid4().hex}"
    tables.delete_folder(spark, path)
    seen = Observation()
    rows = df if gathered else df.hint("rebalance", layout.buckets, *layout.keys)
    spark.sql(f"CREATE TABLE {name} ({', '.join(_fields(df.schema))}) USING parquet OPTIONS (compression 'zstd') {layout.clause()} LOCATION '{path}'")
    try:
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").insertInto(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return seen.get["n"]


def open_parts(spark: SparkSession, root: str, paths: Sequence[str], layout: Layout) -> DataFrame:
    """The rows of all parts as one bucketed table; ``root`` lies above the parts.

    The entry is named by what it shows, so the same parts are described once.
    """
    schema = spark.read.parquet(paths[0]).schema
    shown = hashlib.md5("\n".join([root, *paths, layout.clause(), schema.simpleString()]).encode()).hexdigest()
    name = f"tiermart_parts_{shown}"
    if not spark.catalog.tableExists(name):
        columns = [*_fields(schema), f"`{PART}` int"]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet PARTITIONED BY (`{PART}`) {layout.clause()} LOCATION '{root}'")
        listed = " ".join(f"PARTITION (`{PART}` = {i}) LOCATION '{path}'" for i, path in enumerate(paths))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {listed}")
    return spark.table(name).drop(PART)


def stage(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` written once to the shared folder as a part of its own, for plans that read it several times in place."""
    spark = df.sparkSession
    root = tables.shared_folder(spark, "gathered")
    with settings(spark, IN_PLACE):
        write_part(layout.gathered(df), f"{root}/part", layout, gathered=True)
    return open_parts(spark, root, [f"{root}/part"], layout)


def merge_parts(spark: SparkSession, root: str, paths: Sequence[str], into: str, layout: Layout) -> int:
    """Write the rows of ``paths`` as one part; each task reads and writes one bucket."""
    with settings(spark, IN_PLACE):
        return write_part(open_parts(spark, root, paths, layout), into, layout, gathered=True)
