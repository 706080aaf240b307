"""Stored sales lines: a replaced active part and an append-only history part.

A swap rewrites only the active part. History, which only ever grows, is written once, one folder
per run, hashed by the line's keys or some of them; a run shuffles its feed once and finds the known keys
in place. A feed that was staged in the table's layout is not shuffled. Runs are merged from time to time into one folder, which stands for all
runs before it from the moment it is complete.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermart.operators.joins import without_matches
from tiermart.plans.sales_lines import TARGET_KEYS, active_part, history_part
from tiermart.sinks import bucketed, tables

ACTIVE = "sales_lines_active"
HISTORY = "sales_lines_history"
VIEW = "sales_lines"
# The column that most queries ask for comes first in every bucket.
SORTED = ("customer_code", "branch_code", "order_prog_id", "order_line_id")


def open_lines(spark: SparkSession, root: str) -> DataFrame:
    """Active and history lines of the last complete run."""
    active, history, _ = _parts(spark, root)
    lines = active.unionByName(history)
    lines.createOrReplaceTempView(VIEW)
    return lines


def open_history(spark: SparkSession, root: str) -> DataFrame:
    """History lines of the last complete run, bucketed by the line's keys."""
    return _parts(spark, root)[1]


def _parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, int]:
    """Active part, history part and number of the last complete run."""
    active = tables.open_table(spark, root, ACTIVE)
    run = tables.versions(spark, root, ACTIVE)[-1]
    return active, bucketed.open_parts(spark, _folder(root), _current(spark, root, run), _layout(spark, root)), run


def _current(spark: SparkSession, root: str, run: int) -> list[str]:
    """Folders that hold the history up to ``run``: the last merged one and the runs behind it."""
    merged = [n for n, committed in tables.numbered(spark, _folder(root), "merged") if committed and n <= run]
    since = merged[-1] if merged else 0
    runs = [n for n, committed in tables.numbered(spark, _folder(root), "run") if committed and since < n <= run]
    return [*([f"{_folder(root)}/merged={since}"] if merged else []), *(_run(root, n) for n in runs)]


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/{HISTORY}"


def _run(root: str, run: int) -> str:
    """Runs are not versions: all of them count until they are merged."""
    return f"{_folder(root)}/run={run}"


def _layout(spark: SparkSession, root: str) -> bucketed.Layout:
    """The layout is fixed when a table is created; a mark tells the number of buckets, and the keys if not all."""
    marks = [re.fullmatch(r"_BUCKETS-(\d+)(?:-(.+))?", name) for name in tables.names_in(spark, _folder(root))]
    buckets, keys = next((int(found[1]), found[2]) for found in marks if found)
    return bucketed.Layout(tuple(keys.split(",")) if keys else tuple(TARGET_KEYS), SORTED, buckets)


def _write_active(lines: DataFrame, path: str) -> int:
    """Sorted inside each file, so that filters on the branch skip row groups."""
    seen = Observation()
    counted = lines.observe(seen, F.count(F.lit(1)).alias("n"))
    # Lines of an order side by side compress well.
    ordered = counted.sortWithinPartitions("branch_code", *(c for c in SORTED if c != "branch_code"))
    ordered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return seen.get["n"]


def create_lines(lines: DataFrame, root: str, buckets: int | None = None, by: Sequence[str] = ()) -> None:
    """First run of a table, from existing lines.

    ``buckets`` should let a bucket of the grown history fit a task; it is the number of shuffle
    partitions unless given. Lines are hashed by all their keys, or ``by`` some of them: lines and feeds that come
    gathered by order need no shuffle in a table hashed by order.
    """
    spark = lines.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    unknown = set(by) - set(TARGET_KEYS)
    if unknown:
        raise ValueError(f"not keys of a line: {sorted(unknown)}")
    tables.set_mark(spark, _folder(root), "-".join([f"_BUCKETS-{count}", *([",".join(by)] if by else [])]))
    layout = _layout(spark, root)
    history = history_part(lines)
    with bucketed.settings(spark, bucketed.IN_PLACE):
        bucketed.write_part(layout.gathered(history) if by else history, _run(root, 1), layout, gathered=bool(by))
        _write_active(active_part(lines), tables.version_path(root, ACTIVE, 1))


def stage_lines(lines: DataFrame, root: str) -> DataFrame:
    """Conformed lines of a feed, written once in the table's layout, for runs with ``staged``."""
    return bucketed.stage(lines, _layout(lines.sparkSession, root))


def unknown_history(history: DataFrame, known: DataFrame, active: DataFrame) -> DataFrame:
    """Lines of ``history`` that neither the stored history ``known`` nor ``active`` holds.

    ``known`` is joined where it lies; the feed moves to its buckets.
    """
    return without_matches(history.join(known.select(*TARGET_KEYS), TARGET_KEYS, "left_anti"), active, TARGET_KEYS)


def run_upsert(active: DataFrame, history: DataFrame, root: str, staged: bool = False) -> dict[str, int]:
    """Swap and append conformed lines; returns the rows per step.

    Both feeds may come ``staged`` by ``stage_lines``; their rows then stay in their buckets all the way.

    The active version commits the run: until it is complete readers see the
    state before, and a history folder without it is ignored and rewritten.
    """
    spark = active.sparkSession
    old_active, kept, last_run = _parts(spark, root)
    run = last_run + 1
    with tables.staging(spark, "sales-lines") as folder, bucketed.settings(spark, bucketed.IN_PLACE):
        if not staged:
            # The active lines are read three times, so they are stored once.
            active.write.parquet(f"{folder}/active")
            active = spark.read.parquet(f"{folder}/active")

        missing = unknown_history(history, kept, active)
        lasting = history_part(active).withColumn("_active", F.lit(True))
        added = lasting.unionByName(missing.withColumn("_active", F.lit(False)))
        seen = Observation()
        counted = added.observe(
            seen,
            F.count_if("_active").alias("lasting"),
            F.count_if(F.col("_active") & (F.col("history_prog_id") != 0)).alias("piled_up"),
        ).drop("_active")
        n_added = bucketed.write_part(counted.select(*kept.columns), _run(root, run), _layout(spark, root), gathered=staged)
        n_swapped = _write_active(active_part(active), tables.version_path(root, ACTIVE, run))
    open_lines(spark, root)
    counts = seen.get
    return {
        "active_deleted": old_active.count(),
        "active_inserted": n_swapped + counts["lasting"],
        "history_inserted": n_added - counts["lasting"],
        "active_with_history_id": counts["piled_up"],
    }


def merge_runs(spark: SparkSession, root: str) -> int:
    """Merge the history up to the last complete run into one folder, bucket by bucket; returns its rows.

    Readers see the merged folder once it is complete, with the same rows. The folders it stands for stay
    until ``drop_merged_runs``, for those who are reading them.
    """
    run = tables.versions(spark, root, ACTIVE)[-1]
    parts = _current(spark, root, run)
    into = f"{_folder(root)}/merged={run}"
    if parts == [into]:
        return spark.read.parquet(into).count()
    return bucketed.merge_parts(spark, _folder(root), parts, into, _layout(spark, root))


def drop_merged_runs(spark: SparkSession, root: str) -> int:
    """Remove the folders that the last merged one stands for; returns how many."""
    run = tables.versions(spark, root, ACTIVE)[-1]
    current = _current(spark, root, run)
    merged = [n for n, committed in tables.numbered(spark, _folder(root), "merged") if committed and n <= run]
    old = [f"{_folder(root)}/{kind}={n}" for kind in ("run", "merged") for n, _ in tables.numbered(spark, _folder(root), kind) if merged and n <= merged[-1]]
    gone = [path for path in old if path not in current]
    for path in gone:
        tables.delete_folder(spark, path)
    return len(gone)
