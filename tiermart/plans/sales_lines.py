"""Sales lines: swap the active part, append unseen history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.operators.changes import drop_where, is_active, missing_rows, swap_active
from tiermart.operators.latest import latest_by_key, newest



def _selective_first(keys: Sequence[str]) -> list[str]:
    """Same keys, led by those that tell most rows apart.

    Sorting decides by the leading bytes of the first key where it can.
    """
    return sorted(keys, key=lambda key: key not in ("src_order_id", "src_line_id"))


TARGET_KEYS = [fixed.SALES_LINE_NAMES[key] for key in _selective_first(fixed.HISTORY_KEYS)]

KEPT = "kept"
ACTIVE_DELETED = "active_deleted"
ACTIVE_INSERTED = "active_inserted"
HISTORY_INSERTED = "history_inserted"
ACTIVE_WITH_HISTORY_ID = "active_with_history_id"


def conform_lines(
    feed: DataFrame, keys: Sequence[str], tie_breaks: Sequence[Column] = ()
) -> DataFrame:
    """Newest row per key under conformed names.

    ``tie_breaks`` decide between rows of equal ``record_timestamp``, then the
    greatest values of the other columns do.
    """
    rest = [c for c in fixed.SALES_LINE_NAMES if c not in (*keys, "record_timestamp")]
    order = [*newest("record_timestamp"), *tie_breaks, *newest(*rest)]
    kept = latest_by_key(feed, _selective_first(keys), order)
    return kept.select(*fixed.SALES_LINE_NAMES).withColumnsRenamed(fixed.SALES_LINE_NAMES)


def active_lines(feed: DataFrame, tie_breaks: Sequence[Column] = ()) -> DataFrame:
    return conform_lines(feed, fixed.ACTIVE_KEYS, tie_breaks)


def history_lines(feed: DataFrame, tie_breaks: Sequence[Column] = ()) -> DataFrame:
    return conform_lines(feed, fixed.HISTORY_KEYS, tie_breaks)


def line_keys(feed: DataFrame) -> DataFrame:
    """Keys of the lines that ``history_lines`` would keep; counts need no more, and only keys move."""
    return feed.select(*fixed.HISTORY_KEYS).withColumnsRenamed(fixed.SALES_LINE_NAMES).distinct()


def upsert_steps(
    target: DataFrame, active: DataFrame, history: DataFrame
) -> DataFrame:
    """Next target with the ``_step`` every row came from.

    ``active`` and ``history`` are conformed lines. History is matched against
    the target after the swap, and rows already there are never updated. Active lines are both
    written and matched; where they come gathered by order, both share the shuffles below.
    """
    swapped = swap_active(
        target.withColumn("_step", F.lit(KEPT)),
        active.withColumn("_step", F.lit(ACTIVE_INSERTED)),
    )
    missing = missing_rows(history, swapped, TARGET_KEYS)
    return swapped.unionByName(missing.withColumn("_step", F.lit(HISTORY_INSERTED)))


def upsert_sales_lines(
    target: DataFrame, active: DataFrame, history: DataFrame
) -> DataFrame:
    return upsert_steps(target, active, history).drop("_step")


def step_counts() -> list[Column]:
    """Row counts per step, for ``agg`` or ``observe``."""
    step = F.col("_step")
    piled_up = (step == ACTIVE_INSERTED) & (F.col("history_prog_id") != 0)
    steps = [KEPT, ACTIVE_DELETED, ACTIVE_INSERTED, HISTORY_INSERTED]
    counts = {name: F.count_if(step == name) for name in steps}
    counts[ACTIVE_WITH_HISTORY_ID] = F.count_if(piled_up)
    return [count.alias(name) for name, count in counts.items()]


def upsert_audit(
    target: DataFrame, active: DataFrame, history: DataFrame
) -> DataFrame:
    """``step`` and ``n_rows`` of an upsert, without writing it.

    Only keys are looked at, so ``target`` and ``history`` may be ``line_keys``.
    """
    target, active, history = (df.select(*TARGET_KEYS) for df in (target, active, history))
    deleted = active_part(target).withColumn("_step", F.lit(ACTIVE_DELETED))
    columns = ["_step", "history_prog_id"]
    steps = upsert_steps(target, active, history).select(*columns)
    counts = steps.unionByName(deleted.select(*columns)).agg(*step_counts())
    names = [ACTIVE_DELETED, ACTIVE_INSERTED, HISTORY_INSERTED, ACTIVE_WITH_HISTORY_ID]
    return counts.unpivot([], names, "step", "n_rows")


def active_part(lines: DataFrame) -> DataFrame:
    """The rows the next swap will delete."""
    return lines.where(is_active())


def history_part(lines: DataFrame) -> DataFrame:
    """The rows no swap deletes."""
    return drop_where(lines, is_active())
