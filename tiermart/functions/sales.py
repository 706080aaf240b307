"""Sales-mart columns: surrogate keys, channel label and calendar parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiermart.functions import fixed


def joined_key(*parts: str | Column) -> Column:
    """``_``-joined key that is NULL as soon as one part is NULL."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [c.cast("string") for c in columns]
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit("_"), text]
    return F.concat(*spaced)


def letter_case(value: Column) -> Column:
    return F.when(value == F.lower(value), "low").otherwise("upp")


def surrogate_keys() -> dict[str, Column]:
    order = ["branch_code", "customer_code", "history_prog_id", "order_prog_id"]
    return {
        "fulfillment_surrogate_key": joined_key(*order, "order_line_id", "product_code"),
        "customer_order_surrogate_key": joined_key(*order, "delivery_note_id"),
        "container_order_surrogate_key": joined_key(
            *order, "container_reference", letter_case(F.col("container_reference"))
        ),
        "shipping_destination_surrogate_key": joined_key("customer_code", "shipping_address"),
    }


def order_channel(
    ordered: Mapping[str, Column], fallback: Column, matched: Column
) -> Column:
    """Channel of an order from its ordered quantity per channel.

    ``ordered`` maps the keys of ``CHANNEL_LABELS`` to quantities; only positive
    ones count. One channel gives its name and several a ``Mixed (…)`` label in
    the order of ``CHANNEL_LABELS``. An order without a match or without any
    positive quantity keeps ``fallback``.
    """
    sold = {key: ordered[key] > 0 for key in fixed.CHANNEL_LABELS}
    names = F.concat_ws(
        ", ", *[F.when(sold[key], label) for key, label in fixed.CHANNEL_LABELS.items()]
    )
    n_sold = sum(
        (F.when(is_sold, 1).otherwise(0) for is_sold in sold.values()), start=F.lit(0)
    )
    return (
        F.when(~F.coalesce(matched, F.lit(False)) | (n_sold == 0), fallback)
        .when(n_sold == 1, names)
        .otherwise(F.concat(F.lit("Mixed ("), names, F.lit(")")))
    )


def month_name(date: Column) -> Column:
    names = F.array(*[F.lit(name) for name in fixed.MONTH_NAMES])
    # element_at takes a NULL index for the last element here.
    return F.try_element_at(names, F.month(date))


def calendar_columns(date: str) -> dict[str, Column]:
    return {
        f"{date.removesuffix('_date')}_year": F.year(date),
        f"{date.removesuffix('_date')}_month": F.month(date),
        f"{date.removesuffix('_date')}_month_name": month_name(F.col(date)),
    }
