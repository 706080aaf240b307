"""Sales-order mart with channel attribution and calendar columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.functions.sales import calendar_columns, order_channel, surrogate_keys
from tiermart.operators.joins import left_join_unique
from tiermart.sinks.tables import publish


def channel_totals(consolidated: DataFrame) -> DataFrame:
    """Ordered and delivered quantity per order and channel."""
    sums = [F.sum(name).alias(name) for name in fixed.CHANNEL_TOTALS]
    return consolidated.groupBy(*fixed.ORDER_KEYS).agg(*sums)


def with_channel_totals(orders: DataFrame, consolidated: DataFrame) -> DataFrame:
    """Orders with their totals; ``_matched`` is NULL for an order without any."""
    return with_totals(orders, channel_totals(consolidated))


def with_totals(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders with totals that are one row per order and channel already."""
    return left_join_unique(orders, totals.withColumn("_matched", F.lit(True)), fixed.ORDER_KEYS)


def channel_of_order() -> Column:
    ordered = {key: F.col(f"ordered_qty_{key}") for key in fixed.CHANNEL_LABELS}
    return order_channel(ordered, F.col("order_channel"), F.col("_matched"))


def first_day(as_of: dt.date) -> Column:
    """Twelve months before the day before ``as_of``."""
    return F.add_months(F.date_sub(F.lit(as_of), 1), -12)


def trailing_year(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders dated from twelve months before the day before ``as_of``."""
    since = first_day(as_of)
    return orders.where(
        F.col("order_date") >= since.cast(orders.schema["order_date"].dataType)
    )


def sales_orders_extended(
    orders: DataFrame, consolidated: DataFrame, as_of: dt.date
) -> DataFrame:
    return extended_with_totals(orders, channel_totals(consolidated), as_of)


def extended_with_totals(orders: DataFrame, totals: DataFrame, as_of: dt.date) -> DataFrame:
    """The mart's rows from totals that are one row per order and channel already."""
    joined = with_totals(trailing_year(orders, as_of), totals)
    delivered = F.when(F.col("delivered_quantity") > 0, 1).otherwise(0)
    return joined.select(
        *_named(surrogate_keys()),
        *fixed.MART_PASS_THROUGH,
        *fixed.CHANNEL_TOTALS,
        *_named({"order_channel": channel_of_order()}),
        *_named(calendar_columns("delivery_note_date")),
        *_named({"is_delivered_flag": delivered}),
    )


def _named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def refresh_mart(
    orders: DataFrame, consolidated: DataFrame, as_of: dt.date, root: str, name: str
) -> str:
    """Rebuild the stored mart; readers see the old one until it is complete."""
    mart = sales_orders_extended(orders, consolidated, as_of)
    laid_out = mart.sortWithinPartitions("order_date", "branch_code")
    return publish(laid_out, root, name).path
