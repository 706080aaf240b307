"""Channel labels, surrogate keys, calendar and the balanced join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import shapes
from tiermart.functions import fixed, sales
from tiermart.operators.joins import left_join_unique, without_matches
from tiermart.plans import sales_mart
from tiermart.sinks import tables


def label(spark, b2b=None, push=None, retail=None, other=None, matched=True):
    given = {"b2b": b2b, "push": push, "retail": retail, "other": other}
    ordered = {key: F.lit(value).cast("double") for key, value in given.items()}
    column = sales.order_channel(ordered, F.lit("own"), F.lit(matched).cast("boolean"))
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ({}, "own"),
        ({"b2b": 0, "push": -1}, "own"),
        ({"b2b": 5, "matched": None}, "own"),
        ({"push": 1, "other": -3}, "Push"),
        ({"retail": 2}, "Retail"),
        ({"b2b": 1, "other": 2}, "Mixed (B2B, Other)"),
        ({"other": 1, "retail": 1, "push": 1, "b2b": 1}, "Mixed (B2B, Push, Retail, Other)"),
    ],
)
def test_order_channel(spark, given, expected):
    assert label(spark, **given) == expected


def test_container_key(spark):
    rows = [("abc",), ("Abc",), ("12",), (None,)]
    base = spark.createDataFrame(rows, "container_reference string").withColumns(
        {name: F.lit(1) for name in ("branch_code", "customer_code", "history_prog_id",
                                     "order_prog_id", "order_line_id", "product_code",
                                     "delivery_note_id", "shipping_address")}
    )
    key = sales.surrogate_keys()["container_order_surrogate_key"]
    assert [r[0] for r in base.select(key).collect()] == [
        "1_1_1_1_abc_low", "1_1_1_1_Abc_upp", "1_1_1_1_12_low", None
    ]


def test_month_names(spark):
    days = [(dt.date(2024, m, 1),) for m in range(1, 13)] + [(None,)]
    found = spark.createDataFrame(days, "d date").select(sales.month_name(F.col("d")))
    assert [r[0] for r in found.collect()] == [*fixed.MONTH_NAMES, None]


def test_trailing_year_clamps_the_month_end(spark):
    rows = [(dt.datetime(2023, 2, 27),), (dt.datetime(2023, 2, 28),), (None,)]
    orders = spark.createDataFrame(rows, "order_date timestamp_ntz")
    kept = sales_mart.trailing_year(orders, dt.date(2024, 3, 1))
    assert [r[0] for r in kept.collect()] == [dt.datetime(2023, 2, 28)]


def test_totals_of_nothing_are_null(spark):
    key = ", ".join(f"'x' {k}" for k in fixed.ORDER_KEYS)
    totals = ", ".join(f"cast(null as double) {c}" for c in fixed.CHANNEL_TOTALS)
    row = sales_mart.channel_totals(spark.sql(f"select {key}, {totals}")).first()
    assert [row[c] for c in fixed.CHANNEL_TOTALS] == [None] * 8


def test_null_keys_do_not_match(spark):
    left = spark.createDataFrame([("a", None), ("a", "b"), ("c", "d")], "k string, l string")
    right = left.groupBy("k", "l").agg(F.count("*").alias("n"))
    found = left_join_unique(left, right.where("k = 'a'"), ["k", "l"])
    assert sorted(map(str, map(tuple, found.collect()))) == [
        "('a', 'b', 1)", "('a', None, None)", "('c', 'd', None)"
    ]


@pytest.mark.parametrize("join", ["left", "anti"])
def test_hot_key_is_split(spark, join):
    """One key with a third of all rows is read by several join tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        lines = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
            F.hash("id").alias("payload"),
        )
        totals = lines.groupBy("k").agg(F.count("*").alias("n"))
        if join == "left":
            joined = left_join_unique(lines, totals, ["k"])
        else:
            joined = without_matches(lines, totals.where("k % 2 = 0"), ["k"], hot=True)
        rows = joined.collect()
        assert len(rows) == (60000 if join == "left" else 40000)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_date_filter_reaches_the_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "orders")
    spark.sql("select timestamp_ntz'2024-01-01' order_date").write.parquet(path)
    plan = plan_of(sales_mart.trailing_year(spark.read.parquet(path), dt.date(2024, 3, 1)))
    assert "GreaterThanOrEqual(order_date,2023-02-28T00:00)" in plan


def test_refreshed_mart_is_stored(spark, tmp_path):
    sf_dir, root = "/root/testdata/sf0.001", str(tmp_path)
    orders, channels = shapes.mart_orders(spark, sf_dir), shapes.channel_rows(spark, sf_dir)
    for as_of in (dt.date(2001, 8, 1), shapes.MART_AS_OF):
        path = sales_mart.refresh_mart(orders, channels, as_of, root, "mart")
    assert path.endswith("v=2")
    expected = sales_mart.sales_orders_extended(orders, channels, shapes.MART_AS_OF)
    stored = tables.open_table(spark, root, "mart")
    assert stored.columns == expected.columns and len(stored.columns) == 62
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()
    assert spark.table("mart").count() == stored.count()
