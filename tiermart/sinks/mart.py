"""Stored sales-order mart that is refreshed from changes instead of rebuilt.

Beside the mart's rows by order month lie the totals per order and channel in a form that signed
changes can be added to: sums, how many values went into each, and how many rows a group has. A refresh
adds the changes as one more totals part, finds the orders they touch, and rewrites only the months of those orders. All
of it is one commit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.operators.joins import left_join_unique
from tiermart.plans import sales_mart
from tiermart.sinks import states, tables

MONTH = "order_month"
SIGN = "_sign"
ROWS = "_rows"
AS_OF = "as_of"  # day number, noted with each commit
MERGE_AFTER = 16  # totals parts


def _month(date: str) -> Column:
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))


def _is_totals(name: str) -> bool:
    return name.startswith("totals/")


def _filled(name: str) -> str:
    return f"_n_{name}"


def signed_totals(changes: DataFrame) -> DataFrame:
    """Sums, numbers of values and rows per order key of rows that come (``_sign`` 1) or go (-1)."""
    sign = F.col(SIGN)
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0)) * sign).alias(c) for c in fixed.CHANNEL_TOTALS]
    filled = [F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(_filled(c)) for c in fixed.CHANNEL_TOTALS]
    return changes.groupBy(*fixed.ORDER_KEYS).agg(*sums, *filled, F.sum(sign).alias(ROWS))


def _added(totals: DataFrame) -> DataFrame:
    """One row per key of totals that lie in several parts; keys without rows are gone."""
    names = [*fixed.CHANNEL_TOTALS, *map(_filled, fixed.CHANNEL_TOTALS), ROWS]
    return totals.groupBy(*fixed.ORDER_KEYS).agg(*(F.sum(n).alias(n) for n in names)).where(F.col(ROWS) > 0)


def _plain(totals: DataFrame) -> DataFrame:
    """Totals as ``channel_totals`` has them: NULL where no value went in."""
    sums = [F.when(F.col(_filled(c)) > 0, F.col(c)).alias(c) for c in fixed.CHANNEL_TOTALS]
    return totals.select(*fixed.ORDER_KEYS, *sums)


def _write_totals(totals: DataFrame, root: str, number: int) -> dict[str, str]:
    return states.write_parts(totals.withColumn("_state", F.lit(number)), root, lambda n: f"totals/{n}", "_state")[0]


def _write_months(mart: DataFrame, root: str) -> dict[str, str]:
    rows = mart.withColumn(MONTH, _month("order_date"))
    return states.write_parts(rows, root, lambda n: f"month/{n}", MONTH)[0]


def create_mart(orders: DataFrame, consolidated: DataFrame, as_of: dt.date, root: str) -> states.State:
    """Build the mart and its totals in full, in place of what is there."""
    spark = orders.sparkSession
    base = states.read_state(spark, root)
    changes: dict[str, str | None] = dict.fromkeys(base.parts)
    totals = _write_totals(signed_totals(consolidated.withColumn(SIGN, F.lit(1))), root, base.number + 1)
    stored = states.open_parts(spark, root, states.State(0, totals))
    known = _plain(stored) if stored is not None else sales_mart.channel_totals(consolidated)
    months = _write_months(sales_mart.extended_with_totals(orders, known, as_of), root)
    return states.commit(spark, root, base, {**changes, **totals, **months}, {AS_OF: as_of.toordinal()})


def refresh_mart(
    orders: DataFrame, changes: DataFrame, as_of: dt.date, root: str, changed_orders: DataFrame | None = None
) -> list[str]:
    """Bring the mart up to date; returns the months it rewrote or dropped.

    orders: all orders as they are now. changes: rows of the consolidated table with ``_sign`` 1 for those that came
    and -1 for those that went; an update is one of each. changed_orders: ``order_date`` of every order that
    came, went or changed, the old and the new date. Equal to a rebuild for integers and decimals, and for doubles
    as far as their sums are exact.
    """
    spark = orders.sparkSession
    state = states.read_state(spark, root)
    old_as_of = dt.date.fromordinal(state.notes[AS_OF])
    with tables.staging(spark, "mart") as folder:
        signed_totals(changes).write.parquet(f"{folder}/delta")
        delta = spark.read.parquet(f"{folder}/delta")
        known = states.open_parts(spark, root, state, _is_totals)
        totals = delta if known is None else known.select(*delta.columns).unionByName(delta)

        recent = sales_mart.trailing_year(orders, as_of).withColumn(MONTH, _month("order_date"))
        keys = delta.select(*fixed.ORDER_KEYS).distinct()
        touched = recent.join(keys, fixed.ORDER_KEYS, "left_semi").select(MONTH)
        if changed_orders is not None:
            touched = touched.unionByName(changed_orders.select(_month("order_date").alias(MONTH)))
        # At most one row per calendar month.
        months = {row[MONTH] for row in touched.distinct().collect()}
        first, old_first = (_first_month(orders, day) for day in (as_of, old_as_of))
        if as_of != old_as_of:
            # The window moved: its first months hold fewer or more days now.
            months |= {first, old_first}
            held = {int(n.removeprefix("month/")) for n in state.parts if n.startswith("month/")}
            months |= {m for m in held if m < first}
            if first < old_first:
                months |= {r[0] for r in recent.where(F.col(MONTH) <= old_first).select(MONTH).distinct().collect()}

        rows = recent.where(F.col(MONTH).isin(sorted(months))).drop(MONTH)
        affected = rows.select(*fixed.ORDER_KEYS).distinct()
        now = _plain(_added(totals.join(affected, fixed.ORDER_KEYS, "left_semi")))
        written = _write_months(sales_mart.extended_with_totals(rows, now, as_of), root)

        new: dict[str, str | None] = {f"month/{m}": None for m in months}
        new |= written
        merged = sum(map(_is_totals, state.parts)) >= MERGE_AFTER
        if merged:
            new |= dict.fromkeys(filter(_is_totals, state.parts))
        new |= _write_totals(_added(totals) if merged else delta, root, state.number + 1)
        states.commit(spark, root, state, new, {AS_OF: as_of.toordinal()})
    return sorted(n for n in new if n.startswith("month/"))


def _first_month(orders: DataFrame, as_of: dt.date) -> int:
    """Month of the first day that the mart of ``as_of`` holds."""
    first = orders.sparkSession.range(1).select(sales_mart.first_day(as_of).alias("d")).select(_month("d")).first()
    return first[0]


def open_mart(spark: SparkSession, root: str, months: list[int] | None = None) -> DataFrame:
    """The mart's rows with their ``order_month``; of some months only, if given."""
    state = states.read_state(spark, root)
    wanted = None if months is None else {f"month/{m}" for m in months}
    found = states.open_parts(spark, root, state, lambda n: n.startswith("month/") and (wanted is None or n in wanted))
    if found is None:
        raise FileNotFoundError(f"{root} has no such months")
    return found
