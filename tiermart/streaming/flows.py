"""Streaming forms of the delta load, the late reload and the shortage runs."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tiermart.functions import fixed
from tiermart.operators.latest import latest_by_key, oldest
from tiermart.plans.shortages import known_facilities
from tiermart.sinks.tables import delete_folder, first_version, names_in, set_mark, staging, version_path


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    archive: str | None = None,
    **options: str,
) -> DataFrame:
    """Files as they appear; processed ones move to ``archive`` when it is given."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if archive is not None:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return reader.load(path)


@contextmanager
def _sessions_merged_in_tasks(spark: SparkSession) -> Iterator[None]:
    """Sessions of a busy key merge inside each task before they are shuffled."""
    setting = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def append_available(
    stream: DataFrame, path: str, checkpoint: str
) -> StreamingQuery:
    """Append everything new since the last run to the parquet table at ``path``.

    The checkpoint takes the place of the queried watermark: what was loaded is
    known by file, so late rows are not lost. Of windows and sessions only those that the
    watermark has closed are appended, and their state goes.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with _sessions_merged_in_tasks(stream.sparkSession):
        return writer.start(path)


def drop_late_copies(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    delay: dt.timedelta = dt.timedelta(days=fixed.RELOAD_DAYS),
) -> DataFrame:
    """First row per key, forgetting a key once ``delay`` has passed.

    All rows of a key meet in one task. Where one key holds much of the stream, use
    ``append_first_copies``.
    """
    marked = stream.withWatermark(ts, f"{delay.total_seconds():.0f} seconds")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def append_first_copies(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    root: str,
    checkpoint: str,
    delay: dt.timedelta = dt.timedelta(days=fixed.RELOAD_DAYS),
) -> StreamingQuery:
    """Append rows whose key no kept row within ``delay`` has, before or after them.

    Each batch is first reduced to its earliest row per key, in every task before the shuffle, and
    to the earliest row that lies more than ``delay`` behind it, and so on. What is left is compared with
    the stored rows of that time: the span of every batch is noted when it is written, and only
    batches whose span is near are opened. So a key that holds most of the stream does not fill a task. The batch number
    names the folder a batch is written to: a repeated batch writes it again and does
    not see itself. Rows lie below ``root`` in folders ``batch=N``. NULL keys are equal to each other; rows
    without a time are kept once for each key and batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with staging(spark, "first-copies") as folder:
            first = _thinned(batch, keys, ts, delay, folder)
            span = first.agg(*_span(ts)).first()
            near = near_batches(spark, root, number, span, delay)
            if near:
                stored = spark.read.schema(batch.schema).parquet(*near)
                seen = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(ts).alias("_seen"))
                # Few for each key, since stored rows of a key lie further apart than ``delay``.
                same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
                apart = F.col("_seen").between(F.col(ts) - F.lit(delay), F.col(ts) + F.lit(delay))
                first = first.join(seen, [*same, apart], "left_anti")
            first.write.mode("overwrite").parquet(f"{root}/batch={number}")
        for name in names_in(spark, f"{root}/{SPANS}"):
            if name.startswith(f"{number}_"):
                delete_folder(spark, f"{root}/{SPANS}/{name}")
        set_mark(spark, f"{root}/{SPANS}", f"{number}_{span[0]}_{span[1]}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


SPANS = "_spans"
DAY_MICROS = 86_400_000_000


def _span(ts: str) -> list[Column]:
    """First and last time in microseconds."""
    return [f(F.unix_micros(F.col(ts).cast("timestamp"))) for f in (F.min, F.max)]


def near_batches(spark: SparkSession, root: str, number: int, span: tuple, delay: dt.timedelta) -> list[str]:
    """Folders of complete batches before ``number`` with times that lie within ``delay`` of ``span``.

    One listing tells all spans. They are taken a day wider, since times without a zone may shift against each other.
    """
    if span[0] is None:
        return []
    room = delay // dt.timedelta(microseconds=1) + DAY_MICROS
    found = []
    for name in names_in(spark, f"{root}/{SPANS}"):
        known = re.fullmatch(r"(\d+)_(-?\d+)_(-?\d+)", name)
        if known and int(known[1]) < number and int(known[2]) - room <= span[1] and int(known[3]) + room >= span[0]:
            found.append(int(known[1]))
    return [f"{root}/batch={n}" for n in sorted(found)]


def _thinned(batch: DataFrame, keys: Sequence[str], ts: str, delay: dt.timedelta, folder: str) -> DataFrame:
    """The earliest row per key, the earliest that is more than ``delay`` later, and so on.

    As many rounds as the batch's times hold delays; mostly one.
    """
    spark = batch.sparkSession
    rest = [c for c in batch.columns if c not in (*keys, ts)]
    left, kept = batch, []
    while True:
        path = f"{folder}/kept-{len(kept)}"
        latest_by_key(left, list(keys), oldest(ts, *rest)).write.parquet(path)
        first = spark.read.schema(batch.schema).parquet(path)
        kept.append(path)
        low, high = batch.agg(*_span(ts)).first() if len(kept) == 1 else (None, None)
        if len(kept) == 1 and (low is None or high - low <= delay // dt.timedelta(microseconds=1)):
            break
        # A hash of the keys comes first, so that Spark can split a key of many rows.
        names = {k: f"_{k}" for k in keys} | {ts: "_kept"}
        before = first.select(*names).withColumnsRenamed(names).withColumn("_hash", F.xxhash64(*[f"_{k}" for k in keys]))
        same = [F.col("_spread") == F.col("_hash"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]]
        later = left.withColumn("_spread", F.xxhash64(*keys)).join(before, same).where(F.col(ts) > F.col("_kept") + F.lit(delay))
        later.select(*batch.columns).write.parquet(f"{folder}/left-{len(kept)}")
        left = spark.read.schema(batch.schema).parquet(f"{folder}/left-{len(kept)}")
        if left.isEmpty():
            break
    return spark.read.schema(batch.schema).parquet(*kept)


def stream_shortages(snapshots: DataFrame, delay: dt.timedelta | None = None) -> DataFrame:
    """Shortage periods of a stream of snapshots, of known facilities as in the batch plan."""
    late = {} if delay is None else {"delay": delay}
    return stream_periods(known_facilities(snapshots), fixed.SHORTAGE_KEYS, "snapshot_timestamp", **late)


def stream_periods(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: dt.timedelta = dt.timedelta(hours=fixed.SHORTAGE_GAP_HOURS),
    delay: dt.timedelta = dt.timedelta(days=fixed.SHORTAGE_LOOKBACK_DAYS),
) -> DataFrame:
    """Runs of snapshots without a gap, as ``start_date`` and ``end_date``."""
    seconds = f"{gap.total_seconds():.0f} seconds"
    marked = stream.withWatermark(ts, f"{delay.total_seconds():.0f} seconds")
    runs = marked.groupBy(*keys, F.session_window(ts, seconds)).agg(
        F.min(ts).alias("start_date"), F.max(ts).alias("end_date")
    )
    return runs.drop("session_window")


def replace_available(
    stream: DataFrame, root: str, name: str, checkpoint: str
) -> StreamingQuery:
    """Write the complete result after each batch as a version of ``name``.

    Complete results never forget: this is for checks and small streams, while
    ``append_available`` keeps bounded state. Versions go on after those that exist
    when the query starts, so a new checkpoint does not fall behind them, and within the
    query the batch number names the version, so a repeated batch writes it again.
    """
    spark = stream.sparkSession
    base = first_version(spark, root, name, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(version_path(root, name, base + number))

    writer = stream.writeStream.foreachBatch(write).outputMode("complete")
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with _sessions_merged_in_tasks(spark):
        return writer.start()
