"""Parquet tables that are replaced as a whole or only appended to.

A replaced table lives in numbered version folders. A version counts once its
write has committed, so readers see the old content until then, and a write can
read the version it replaces.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMITTED = "_SUCCESS"
MARKING = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


@dataclass(frozen=True)
class Published:
    """Where a table was written and what was counted on the way."""

    path: str
    n_rows: int
    counts: dict[str, int] = field(default_factory=dict)


def _folder(spark: SparkSession, path: str):
    """Hadoop file system and path, so that any shared storage works."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables made meanwhile lie below one shared folder, which is removed at the end.

    Results are read lazily, so they have to be written before the end.
    """
    with staging(spark, "scratch") as folder:
        before = _SCRATCH.set(folder)
        try:
            yield folder
        finally:
            _SCRATCH.reset(before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one the cluster names, or below that of ``scratch``.

    Only a local master may do without one and then gets a temporary folder, since on a
    cluster every machine would have its own.
    """
    root = _SCRATCH.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A new shared folder for intermediate tables, removed at the end."""
    folder = shared_folder(spark, purpose)
    try:
        yield folder
    finally:
        _delete(spark, folder)


def write_named_files(df: DataFrame, folder: str, name: str, suffix: str = ".csv", **options: str) -> None:
    """CSV files ``name_00000.csv``, ... in ``folder``, one for each task, as a supplier drops them."""
    spark = df.sparkSession
    parts = f"{folder.rstrip('/')}/_parts-{uuid.uuid4().hex}"
    df.write.options(**options).csv(parts)
    fs, path = _folder(spark, parts)
    texts = sorted(s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().endswith(".csv"))
    for i, text in enumerate(texts):
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}_{i:05d}{suffix}")
        fs.rename(spark._jvm.org.apache.hadoop.fs.Path(text), target)
    fs.delete(path, True)


def stage_once(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, for plans that read it several times."""
    path = shared_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, if there is one."""
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _folder(spark, path)
    fs.delete(hadoop, True)


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    return [n for n, committed in numbered(spark, f"{root}/{name}", "v") if committed]


def numbered(spark: SparkSession, folder: str, prefix: str) -> list[tuple[int, bool]]:
    """Numbers of the folders ``prefix=N`` in ``folder`` and whether they are committed."""
    fs, path = _folder(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        match = re.fullmatch(rf"{prefix}=(\d+)", status.getPath().getName())
        if match:
            marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), COMMITTED)
            found.append((int(match[1]), fs.exists(marker)))
    return sorted(found)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``, sorted; none if it does not exist."""
    fs, path = _folder(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(path)) if fs.exists(path) else []


def drop_old_versions(spark: SparkSession, root: str, name: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` committed versions of a replaced table."""
    for version in versions(spark, root, name)[: -max(keep, 1)]:
        _delete(spark, version_path(root, name, version))


def is_marked(spark: SparkSession, path: str, mark: str) -> bool:
    fs, marker = _folder(spark, f"{path}/{mark}")
    return fs.exists(marker)


def set_mark(spark: SparkSession, path: str, mark: str) -> None:
    fs, marker = _folder(spark, f"{path}/{mark}")
    fs.createNewFile(marker)


def first_version(spark: SparkSession, root: str, name: str, checkpoint: str) -> int:
    """The version at which the query of ``checkpoint`` begins, fixed when it first starts."""
    fs, path = _folder(spark, checkpoint)
    if fs.exists(path):
        for status in fs.listStatus(path):
            match = re.fullmatch(r"first-version-(\d+)", status.getPath().getName())
            if match:
                return int(match[1])
    taken = numbered(spark, f"{root}/{name}", "v")
    first = taken[-1][0] + 1 if taken else 1
    set_mark(spark, checkpoint, f"first-version-{first}")
    return first


def version_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/v={version}"


def open_table(
    spark: SparkSession, root: str, name: str, version: int | None = None
) -> DataFrame:
    """The newest committed version, or the given one; also view ``name``."""
    if version is None:
        committed = versions(spark, root, name)
        if not committed:
            raise FileNotFoundError(f"{root}/{name} has no committed version")
        version = committed[-1]
    table = spark.read.parquet(version_path(root, name, version))
    table.createOrReplaceTempView(name)
    return table


def publish(
    df: DataFrame,
    root: str,
    name: str,
    counts: Sequence = (),
    drop: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    keep_old_if_empty: bool = False,
) -> Published:
    """Write ``df`` as the next version of a table.

    Rows, and any extra aggregate ``counts`` over ``df``, are counted by the write itself;
    ``drop`` names columns that only serve the counts. With ``keep_old_if_empty``
    a result without rows leaves the table as it was.
    """
    spark = df.sparkSession
    taken = numbered(spark, f"{root}/{name}", "v")
    path = version_path(root, name, taken[-1][0] + 1 if taken else 1)
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts)
    # The marker is set last, when the count has decided that the version counts.
    writer = observed.drop(*drop).write.option(MARKING, "false")
    writer.parquet(path, partitionBy=list(partition_by) or None)
    found = dict(seen.get)
    n_rows = found.pop("n_rows")
    if n_rows == 0 and keep_old_if_empty:
        _delete(spark, path)
    else:
        set_mark(spark, path, COMMITTED)
        open_table(spark, root, name)
    return Published(path, n_rows, found)


def reload_staging(df: DataFrame, root: str, name: str) -> Published:
    """Replace a staging table, unless there is nothing to load."""
    return publish(df, root, name, keep_old_if_empty=True)


def append_rows(df: DataFrame, path: str) -> int:
    """Append to the parquet table at ``path``; returns how many rows were added.

    The rows are written once, beside the table, and counted on the way; their files then move into it. Without
    rows nothing is added.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}/_append-{uuid.uuid4().hex}"
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.parquet(beside)
        n_rows = seen.get["n_rows"]
        if n_rows:
            fs, _ = _folder(spark, beside)
            for name in names_in(spark, beside):
                if name.endswith(".parquet"):
                    fs.rename(*(spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}") for folder in (beside, path)))
            set_mark(spark, path, COMMITTED)
    finally:
        _delete(spark, beside)
    return n_rows


def write_bucketed(
    df: DataFrame, table: str, buckets: int, by: Sequence[str], sort_by: Sequence[str]
) -> None:
    """Catalog table hashed by ``by`` and sorted by ``sort_by`` inside each bucket.

    Tables bucketed alike join on ``by`` without a shuffle, and filters on the
    leading sort column skip row groups. Rows are gathered by bucket first, so
    that a bucket is one file rather than one per task; a bucket too large for
    one task is written by several. A join still reads a bucket in one task, so
    add a column to ``by`` if one of its values holds most of the rows.
    """
    spread = df.hint("rebalance", buckets, *by)
    writer = spread.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*sort_by)
    writer.saveAsTable(table)
