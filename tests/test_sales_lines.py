"""Upsert of sales lines: order of steps, NULLs, repeats and skew."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from tiermart.functions import fixed
from tiermart.operators.changes import missing_rows
from tiermart.operators.latest import latest_by_key, newest, oldest
from tiermart.operators.joins import without_matches
from tiermart.plans import sales_lines
from tiermart.sinks import sales_lines as stored
from tiermart.sinks import tables

DAY = dt.datetime(2024, 1, 1)


def feed(spark, *rows):
    """Staging rows from (hist_id, delivery, line, timestamp, description)."""
    schema = "src_hist_id int, src_delivery_id bigint, src_line_id bigint," \
        " record_timestamp timestamp_ntz, src_prod_desc string"
    base = spark.createDataFrame(list(rows), schema)
    given = {
        "src_branch": F.lit("B1"), "src_order_id": F.lit(7).cast("bigint"),
        "src_cust_id": F.lit("C1"), "src_prod_id": F.lit("P1"),
    }
    missing = [c for c in fixed.SALES_LINE_NAMES if c not in base.columns and c not in given]
    return base.withColumns({**given, **{c: F.lit(None).cast("string") for c in missing}})


def run(target, active, history):
    return sales_lines.upsert_sales_lines(target, active, history)


def ids(df):
    rows = df.select("history_prog_id", "delivery_note_id", "order_line_id", "product_description")
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.fixture
def none(spark):
    return sales_lines.history_lines(feed(spark))


def test_null_timestamp_is_the_newest(spark):
    rows = feed(spark, (0, 1, 1, DAY, "dated"), (0, 1, 1, None, "undated"))
    assert ids(sales_lines.active_lines(rows)) == [(0, 1, 1, "undated")]


def test_history_id_is_a_key_of_the_history_only(spark):
    rows = feed(spark, (1, 1, 1, DAY, "a"), (2, 1, 1, DAY + dt.timedelta(1), "b"))
    assert ids(sales_lines.active_lines(rows)) == [(2, 1, 1, "b")]
    assert len(ids(sales_lines.history_lines(rows))) == 2


def test_empty_active_feed_removes_old_active_rows(spark, none):
    target = sales_lines.history_lines(feed(spark, (0, 1, 1, DAY, "a"), (3, 1, 2, DAY, "h")))
    assert ids(run(target, none, none)) == [(3, 1, 2, "h")]


def test_active_rows_with_history_id_pile_up(spark, none):
    active = sales_lines.active_lines(feed(spark, (5, 1, 1, DAY, "a")))
    once = run(none, active, none)
    assert len(ids(run(once, active, none))) == 2
    audit = {r.step: r.n_rows for r in sales_lines.upsert_audit(once, active, none).collect()}
    assert audit == {
        "active_deleted": 0, "active_inserted": 1, "history_inserted": 0,
        "active_with_history_id": 1,
    }


def test_known_history_is_not_updated(spark, none):
    target = sales_lines.history_lines(feed(spark, (1, 1, 1, DAY, "old")))
    news = sales_lines.history_lines(
        feed(spark, (1, 1, 1, DAY + dt.timedelta(9), "new"), (1, 1, 2, DAY, "other"))
    )
    assert ids(run(target, none, news)) == [(1, 1, 1, "old"), (1, 1, 2, "other")]


def test_history_sees_the_active_rows_just_inserted(spark, none):
    active = sales_lines.active_lines(feed(spark, (1, 1, 1, DAY, "active")))
    history = sales_lines.history_lines(feed(spark, (1, 1, 1, DAY, "history")))
    assert ids(run(none, active, history)) == [(1, 1, 1, "active")]


def test_null_key_history_is_appended_on_every_run(spark, none):
    history = sales_lines.history_lines(feed(spark, (1, None, 1, DAY, "h")))
    assert len(ids(run(run(none, none, history), none, history))) == 2


def test_null_history_id_survives_the_swap(spark, none):
    target = sales_lines.history_lines(feed(spark, (None, 1, 1, DAY, "n")))
    assert len(ids(run(target, none, none))) == 1


def test_repeated_run_changes_nothing(spark, none):
    active = sales_lines.active_lines(feed(spark, (0, 1, 1, DAY, "a"), (0, 1, 2, DAY, "b")))
    history = sales_lines.history_lines(feed(spark, (1, 1, 3, DAY, "h")))
    once = run(none, active, history)
    assert ids(run(once, active, history)) == ids(once)


def test_stored_lines_follow_the_plan(spark, tmp_path):
    """The two-part store gives the same rows and counts as the one-table plan."""
    target = sales_lines.history_lines(
        feed(spark, (0, 1, 1, DAY, "a"), (1, 1, 2, DAY, "h"), (None, 1, 3, DAY, "n"))
    )
    active = sales_lines.active_lines(
        feed(spark, (0, 1, 1, DAY, "a2"), (5, 2, 1, DAY, "p"), (0, 9, 1, DAY, "z"))
    )
    history = sales_lines.history_lines(
        feed(spark, (1, 1, 2, DAY, "again"), (1, 8, 8, DAY, "new"), (1, None, 1, DAY, "null"))
    )
    root = str(tmp_path)
    stored.create_lines(target, root)
    expected = target
    for _ in range(2):
        audit = {
            r.step: r.n_rows
            for r in sales_lines.upsert_audit(expected, active, history).collect()
        }
        expected = run(expected, active, history)
        assert stored.run_upsert(active, history, root) == audit
        assert ids(stored.open_lines(spark, root)) == ids(expected)
    tables.drop_old_versions(spark, root, stored.ACTIVE, keep=1)
    assert ids(stored.open_lines(spark, root)) == ids(expected)


def test_unfinished_run_is_ignored_and_redone(spark, tmp_path):
    target = sales_lines.history_lines(feed(spark, (0, 1, 1, DAY, "a"), (1, 1, 2, DAY, "h")))
    root = str(tmp_path)
    stored.create_lines(target, root)
    history = sales_lines.history_lines(feed(spark, (1, 5, 5, DAY, "new")))
    active = sales_lines.active_lines(feed(spark, (0, 1, 1, DAY, "b")))
    # The history of run 2 was written, its active part was not.
    history.write.parquet(f"{root}/{stored.HISTORY}/v=2")
    assert ids(stored.open_lines(spark, root)) == ids(target)
    stored.run_upsert(active, history, root)
    assert ids(stored.open_lines(spark, root)) == [(0, 1, 1, "b"), (1, 1, 2, "h"), (1, 5, 5, "new")]


def test_anti_join_plan(spark, plan_of):
    rows = spark.range(10).selectExpr("id as b", "id as a", "id as x")
    plan = plan_of(without_matches(rows, rows, ["b", "a"]))
    assert "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_one_row_per_key_leaves_each_task(spark, plan_of):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = plan_of(latest_by_key(rows, ["l_suppkey"], newest("l_shipdate")))
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange


def test_null_order(spark):
    rows = spark.createDataFrame([(1, None), (1, 5)], "k int, v int")
    assert latest_by_key(rows, ["k"], newest("v")).first()["v"] is None
    assert latest_by_key(rows, ["k"], oldest("v")).first()["v"] == 5


@pytest.mark.parametrize("name", ["q15_active_swap", "q16_history_append", "q17_upsert", "q33_audit_counts"])
def test_a_feed_gathered_by_order_is_not_shuffled_again(spark, plan_of, name):
    """Both sides of the feed's joins are shuffled, and no wide row after that."""
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved
    assert all("hashpartitioning(concat(O, cast(" in line for line in moved)


def test_missing_rows_take_each_key_as_a_join_does(spark):
    nan = float("nan")
    feed = spark.createDataFrame([(1, 1.0, "a"), (1, 1.0, "b"), (2, nan, "c"), (3, None, "d"), (4, 0.0, "e"), (4, 2.0, "f")], "k int, x double, v string")
    target = spark.createDataFrame([(2, nan), (2, nan), (3, None), (4, -0.0), (9, 9.0)], "k int, x double")
    left = missing_rows(feed, target, ["k", "x"])
    assert left.columns == feed.columns
    assert sorted(r.v for r in left.collect()) == ["a", "b", "d", "f"]
    assert sorted(r.v for r in without_matches(feed, target, ["k", "x"]).collect()) == ["a", "b", "d", "f"]
