"""Inputs of the plans, derived from the given tables as a whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.plans import sales_lines, shortages

RUN_TS = "2024-02-01 06:00:00"
SHORTAGES_AS_OF = dt.date(2024, 1, 31)
MART_AS_OF = dt.date(2001, 8, 1)
BRONZE_AS_OF = dt.date(2024, 1, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def run_ts() -> Column:
    return ntz(RUN_TS)


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalogue columns, one unrelated column, and the file they came from."""
    words = F.split("p_name", " ")
    file_day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 60).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_desc"),
        F.col("p_type").alias("category_level_1"),
        F.col("p_brand").alias("category_level_2"),
        F.get(words, 0).alias("category_level_3"),
        F.get(words, 1).alias("category_level_4"),
        F.lit(None).cast("string").alias("category_level_5"),
        F.when(F.col("p_size") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.lit("adult").alias("target_user"),
        F.col("p_size").cast("string").alias("age_range"),
        F.when(F.col("p_partkey") % 10 == 0, "product_masterdata.csv")
        .otherwise(
            F.concat(F.date_format(file_day, "yyyyMMdd"), F.lit("_product_masterdata.csv"))
        )
        .alias("filename"),
    )


def file_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the escaped URI of a file; errors come from files without digits."""
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "file:///drop/in/no+stamp%20here.csv")
        .otherwise(
            F.concat(F.lit("file:///drop/in/missing%20products_"), stamp, F.lit(".csv"))
        )
        .alias("uri"),
    )


def missing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded keys as a supplier file delivers them."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("  D"), F.col("user_id"), F.lit(" ")).alias("id_deposito"),
        F.concat(F.lit(" "), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("minsan"),
        F.concat(
            F.lit("missing_products_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".csv")
        ).alias("filename"),
    )


def depot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded depot codes as a supplier file delivers them."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" M"), F.col("s_suppkey"), F.lit("  ")).alias("cod_ministeriale"),
        F.concat(F.lit("  D"), F.col("s_nationkey")).alias("id_deposito_principale"),
    )


def drifting_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON text per event: ``size`` is a number, a text, an object, null or missing, and errors are cut off."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_type
            WHEN 'click' THEN '{"id": ' || event_id || ', "size": ' || user_id || '}'
            WHEN 'view' THEN '{"id": ' || event_id || ', "size": "' || user_id || 'px", "seen": {"page": "p' || user_id % 3 || '"}}'
            WHEN 'purchase' THEN '{"size": {"w": ' || user_id % 10 || ', "h": "tall"}, "id": ' || event_id || '}'
            WHEN 'error' THEN '{"id": ' || event_id || ', "si'
            ELSE '{"id": ' || event_id || ', "size": null, "seen": {"page": "s", "n": ' || user_id % 7 || '}}'
        END AS text""",
    )


def mixed_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of every event; the number is a text in errors and a decimal in purchases."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        r"""CASE event_type
            WHEN 'error' THEN regexp_replace(props, '([0-9]+)', '"n$1"')
            WHEN 'purchase' THEN regexp_replace(props, '([0-9]+)', '$1.25')
            ELSE props
        END AS props""",
    )


def _order_lines(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), how)


def shipment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per order line.

    Every package is listed twice, the second time without an outcome. Orders
    without lines have no packages, and each tenth order is sent again a day
    later with another status.
    """
    package = F.concat_ws("-", "l_orderkey", "l_linenumber")
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd")
    billing = F.concat(F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lit("/"),
                       F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    both = F.array(
        *[
            F.struct(
                package.alias("packageId"),
                billing.alias("billingCode"),
                (F.col("l_linestatus") == "F").alias("isRfidActive"),
                outcome.alias("carrierOutcome"),
                shipped.alias("deliveryTimestamp"),
            )
            for outcome in (F.col("l_returnflag"), F.lit("-"))
        ]
    )

    def header(day: Column, status: Column) -> Column:
        return F.struct(
            F.col("o_orderkey").cast("string").alias("transactionId"),
            F.date_format(day, "yyyy-MM-dd").alias("documentDate"),
            F.concat(F.lit("C"), F.col("o_custkey") % 7).alias("carrierName"),
            F.concat(F.lit("cust "), F.col("o_custkey")).alias("destinationName"),
            F.col("o_orderpriority").alias("city"),
            F.lit(None).cast("string").alias("district"),
            status.alias("deliveryStatus"),
            (F.col("o_custkey") % 5).alias("expectedPackages"),
            (F.col("o_custkey") % 3).alias("receivedPackages"),
        )

    lines = _order_lines(spark, sf_dir, "left")
    first = lines.select(
        header(F.col("o_orderdate"), F.col("o_orderstatus")).alias("header"),
        F.when(F.col("l_orderkey").isNotNull(), both).alias("packages"),
    )
    again = lines.where(F.col("o_orderkey") % 10 == 0).select(
        header(F.date_add("o_orderdate", 1), F.lit("R")).alias("header"),
        F.when(F.col("l_orderkey").isNotNull(), both).alias("packages"),
    )
    return first.unionByName(again)


def pallet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per order line; a pallet recurs for each of its lines.

    Each document also lists a package without an id.
    """
    fields = {
        "transactionId": F.col("l_orderkey").cast("string"),
        "packageNumber": F.col("l_linenumber").cast("bigint"),
        "operatorId": F.lpad(F.col("l_partkey").cast("string"), 9, "0"),
        "sortingLine": F.col("l_returnflag"),
        "gridPosition": F.col("l_linestatus"),
        "scannedAt": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "hasAmbiguousMatch": F.col("l_discount") > 0.05,
    }
    known = F.concat_ws("-", "l_orderkey", "l_linenumber")
    packages = [
        F.struct(
            package_id.alias("packageId"),
            *[column.alias(name) for name, column in fields.items()],
        )
        for package_id in (known, F.lit(None).cast("string"))
    ]
    supplier = F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        supplier.cast("string").alias("palletId"),
        F.concat(F.lit("PAL"), supplier).alias("palletCode"),
        F.col("l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("targetDate"),
        F.concat(F.lit("C"), supplier % 7).alias("carrierName"),
        (supplier % 11).alias("packagesCount"),
        F.lit("dock").alias("createdBy"),
        F.lit(None).cast("string").alias("createdAt"),
        F.array(*packages).alias("packages"),
    )


EVENT_RECORD = "event_id bigint, event_type string, seen_at string"


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per event with two items; signups have none."""
    item = F.struct(
        "event_id", "event_type", F.date_format("ts", "HH:mm:ss").alias("seen_at")
    )
    again = item.withField("event_type", F.lit("again"))
    none = F.array().cast(f"array<struct<{EVENT_RECORD}>>")
    return table(spark, sf_dir, "events").select(
        "ts",
        F.when(F.col("event_type") == "signup", none)
        .otherwise(F.array(item, again))
        .alias("items"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag reads with text id, date and a time that carries a dummy date."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("1970-01-01 "), F.date_format("ts", "HH:mm:ss")).alias("time"),
        "event_type",
    )


def loaded_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run has loaded: the reads before 2024-01-20."""
    early = table(spark, sf_dir, "events").where(F.col("ts") < ntz("2024-01-20 00:00:00"))
    return early.select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        "event_type",
    )


SALES_FEED = {
    "src_branch": "'B' || (o_custkey % 10)",
    "src_hist_id": "if(o_orderstatus = 'F', 1, 0)",
    "src_order_id": "'O' || l_orderkey",
    "src_cust_id": "string(o_custkey)",
    "src_delivery_id": "'D' || l_orderkey",
    "src_line_id": "l_linenumber",
    "is_fulfilled": "l_linestatus = 'F'",
    "src_prod_id": "'P' || (l_partkey % 5)",
    "src_prod_desc": "'item ' || (l_partkey % 5)",
    "uom": "'PZ'",
    "qty_requested": "l_quantity",
    "qty_ordered": "l_quantity",
    "qty_ordered_cev": "l_quantity * 2",
    "qty_delivered": "if(l_linestatus = 'F', l_quantity, 0D)",
    "qty_delivered_cev": "if(l_linestatus = 'F', l_quantity * 2, 0D)",
    "selling_price": "l_extendedprice",
    "retail_price": "o_totalprice",
    "vat_rate": "l_tax",
    "discount_pct_line": "l_discount",
    "discount_pct_cond1": "if(l_discount > 0.05D, l_discount, NULL)",
    "discount_pct_cond2": "0D",
    "discount_pct_cust": "l_tax",
    "discount_pct_cust1": "0D",
    "discount_pct_cust2": "0D",
    "discount_pct_prod": "l_discount",
    "product_type": "l_returnflag",
    "warehouse_id": "'W' || (l_suppkey % 10)",
    "product_status": "l_linestatus",
    "qty_reversed": "if(l_returnflag = 'R', l_quantity, 0D)",
    "qty_reversed_cev": "if(l_returnflag = 'R', l_quantity * 2, 0D)",
    "container_ref": (
        "if(l_suppkey % 3 = 0, NULL, if(l_suppkey % 3 = 1, 'b', 'B') || 'ox' || l_suppkey)"
    ),
    "record_timestamp": "l_shipdate",
}


def _expressions(columns: Mapping[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales-line staging rows, with ``l_partkey`` and ``l_suppkey`` to break ties.

    Orders and lines meet by the order's id as the feed writes it, so the rows come gathered by ``src_order_id``.
    """
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    joined = orders.join(lines, F.expr("'O' || o_orderkey = 'O' || l_orderkey"))
    return joined.selectExpr(*_expressions(SALES_FEED), "l_partkey", "l_suppkey")


def tie_breaks() -> list[Column]:
    return [F.col("l_partkey").desc(), F.col("l_suppkey").desc()]


def active_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines.active_lines(sales_feed(spark, sf_dir), tie_breaks())


def history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines.history_lines(past_feed(sales_feed(spark, sf_dir)), tie_breaks())


def past_feed(feed: DataFrame) -> DataFrame:
    return feed.where("src_hist_id = 1")


def prior_feed(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("record_timestamp") < ntz("1998-01-01 00:00:00"))


def prior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target before the run: what was current at the start of 1998."""
    return sales_lines.history_lines(prior_feed(sales_feed(spark, sf_dir)), tie_breaks())


def prior_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines.line_keys(prior_feed(sales_feed(spark, sf_dir)))


def history_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines.line_keys(past_feed(sales_feed(spark, sf_dir)))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        (user % 10).alias("supplier_id"),
        F.concat(F.lit("F"), user % 3).alias("facility_id"),
        user.cast("string").alias("product_code"),
        F.col("ts").alias("snapshot_timestamp"),
    )


def shortage_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("snapshot_timestamp") < ntz("2024-01-25 00:00:00")
    return shortages.shortage_periods(snapshots(spark, sf_dir).where(early))


def shortage_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = F.col("snapshot_timestamp") >= ntz("2024-01-24 00:00:00")
    return shortages.shortage_periods(snapshots(spark, sf_dir).where(late))


ORDER_KEYS = {
    "branch_code": "'B' || (o_custkey % 10)",
    "history_prog_id": "if(o_orderstatus = 'F', 1, 0)",
    "order_prog_id": "'O' || o_orderkey",
    "customer_code": "string(o_custkey)",
    "delivery_note_id": "'D' || o_orderkey",
}
# Which lines count for a channel.
CHANNEL_LINES = {
    "push": "l_returnflag = 'A'",
    "retail": "l_returnflag = 'N' AND l_linestatus = 'O'",
    "b2b": "l_returnflag = 'R'",
    "other": "l_returnflag = 'N' AND l_linestatus = 'F'",
}


def channel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities per line, each in the channel its flags stand for."""
    quantities = {}
    for channel, counts in CHANNEL_LINES.items():
        quantities[f"delivered_qty_{channel}"] = (
            f"if({counts} AND l_linestatus = 'F', l_quantity, NULL)"
        )
        quantities[f"ordered_qty_{channel}"] = f"if({counts}, l_quantity, NULL)"
    lines = _order_lines(spark, sf_dir, "inner")
    return lines.selectExpr(*_expressions({**ORDER_KEYS, **quantities}))


_NOTE_DATE = "if(o_orderkey % 9 <> 0, o_orderdate + INTERVAL 3 DAYS, NULL)"
_NOTHING = "double(NULL)"
MART_ORDERS = {
    **ORDER_KEYS,
    "order_line_id": "o_orderkey % 7",
    "order_type": "o_orderstatus",
    "product_code": "'P' || (o_orderkey % 100)",
    "product_description": "'item ' || (o_orderkey % 100)",
    "unit_of_measure": "'PZ'",
    "product_type": "'T'",
    "is_bulky_item": "o_orderkey % 2 = 0",
    "container_count": "o_custkey % 4",
    "is_refrigerated": "o_orderkey % 5 = 0",
    "shipping_line": "'L' || (o_custkey % 3)",
    "shipping_address": "if(o_orderkey % 11 <> 0, 'dock ' || o_custkey, NULL)",
    "container_reference": (
        "if(o_orderkey % 3 = 0, NULL, if(o_orderkey % 3 = 1, 'b', 'B') || 'ox' || o_orderkey)"
    ),
    "order_date": "o_orderdate",
    "delivery_note_date": _NOTE_DATE,
    "delivery_date": _NOTE_DATE,
    "fulfillment_closed_timestamp": "if(o_orderstatus = 'F', o_orderdate, NULL)",
    "is_fulfillment_generated": "o_orderstatus = 'F'",
    "is_fulfilled": "o_orderstatus = 'F'",
    "is_order_consolidated": "o_orderkey % 4 = 0",
    "delivery_note_number": "'N' || o_orderkey",
    "requested_quantity": "o_totalprice",
    "ordered_quantity": "o_totalprice",
    "ordered_quantity_cev": "o_totalprice",
    "delivered_quantity": "if(o_orderstatus = 'F', o_totalprice, 0D)",
    "delivered_quantity_cev": "if(o_orderstatus = 'F', o_totalprice, NULL)",
    "reversed_quantity": "0D",
    "reversed_quantity_cev": "0D",
    "selling_price": "o_totalprice",
    "public_retail_price": "o_totalprice",
    "vat_rate": "0.22D",
    "line_discount_pct": _NOTHING,
    "cond_discount_pct_1": _NOTHING,
    "cond_discount_pct_2": _NOTHING,
    "client_discount_pct": "0.5D",
    "client_discount_pct_1": _NOTHING,
    "client_discount_pct_2": _NOTHING,
    "product_discount_pct": _NOTHING,
    "lines_to_fulfill": "o_custkey % 6",
    "lines_ordered": "o_custkey % 8",
    "record_timestamp": "o_orderdate",
    "order_channel": "o_orderpriority",
}


def mart_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mart row per order."""
    return table(spark, sf_dir, "orders").selectExpr(*_expressions(MART_ORDERS))
