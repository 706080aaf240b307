"""Drifting JSON records, a column per type, overlapping intervals and stored stream batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tiermart.operators.overlaps import overlapping
from tiermart.sinks import tables
from tiermart.sources import variants
from tiermart.streaming import flows


def texts(spark, *given):
    return spark.createDataFrame(list(enumerate(given)), "n int, text string")


def test_records_of_all_shapes_fit_one_schema(spark):
    rows = texts(spark, '{"a": 1, "b": {"c": "x"}}', '{"a": 2.5, "d": [1, 2]}', "{oops", None, '{"b": {"c": "y", "e": true}, "gone": null}')
    records, unreadable = variants.parsed(rows, "text")
    assert [r.n for r in unreadable.collect()] == [2]
    schema = variants.merged_schema(records)
    assert schema.simpleString() == "struct<a:decimal(21,1),b:struct<c:string,e:boolean>,d:array<bigint>,gone:string>"
    found = {r.n: r for r in variants.flat_records(records, schema).collect()}
    assert float(found[1].a) == 2.5 and found[1].d == [1, 2] and found[1].b is None
    assert (found[4].b.c, found[4].b.e, found[4].gone) == ("y", True, None)
    assert found[3].a is None and len(found) == 4


def test_an_earlier_schema_can_be_kept(spark):
    first, _ = variants.parsed(texts(spark, '{"a": 1}'), "text")
    later, _ = variants.parsed(texts(spark, '{"a": "text", "new": 1}', '{"a": 7}'), "text")
    found = variants.flat_records(later, variants.merged_schema(first))
    assert found.columns == ["n", "text", "a"] and [r.a for r in found.orderBy("n").collect()] == [None, 7]


def test_every_type_gets_a_column_at_any_depth(spark):
    rows = texts(
        spark, '{"v": 1, "s": {"t": "x"}}', '{"v": "a", "s": {"t": 5}}', '{"v": true}', '{"v": {"w": 1}}', '{"v": {"w": "deep"}}', '{"v": [1, "b"]}', '{"v": null}', "{}"
    )
    records, _ = variants.parsed(rows, "text")
    found = variants.split_variants(variants.flat_records(records.drop("text")))
    assert sorted(found.columns) == ["n", "s_t_bigint", "s_t_string", "v_array", "v_bigint", "v_boolean", "v_object_w_bigint", "v_object_w_string", "v_string"]
    values = [{k: v for k, v in r.asDict().items() if v is not None and k != "n"} for r in found.orderBy("n").collect()]
    assert values == [
        {"v_bigint": 1, "s_t_string": "x"}, {"v_string": "a", "s_t_bigint": 5}, {"v_boolean": True}, {"v_object_w_bigint": 1},
        {"v_object_w_string": "deep"}, {"v_array": '[1,"b"]'}, {}, {},
    ]


def test_no_records_and_records_that_are_no_objects(spark):
    records, _ = variants.parsed(texts(spark, "1", "2"), "text")
    with pytest.raises(ValueError, match="objects"):
        variants.flat_records(records)
    with pytest.raises(ValueError, match="objects"):
        variants.flat_records(variants.parsed(texts(spark), "text")[0])


# Overlaps

INTERVAL = "k string, start_date timestamp_ntz, end_date timestamp_ntz, note int"


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


@pytest.mark.parametrize(("tolerance", "width"), [(0, 24), (13, 24), (5, 3), (0, 1000)])
def test_overlaps_equal_brute_force(spark, tolerance, width):
    rng = random.Random(tolerance + width)

    def made(n):
        out = []
        for i in range(n):
            begin = rng.randrange(300)
            out.append((rng.choice(["a", "a", "a", "b", None]), at(begin), at(begin + rng.choice([0, 2, 30, 200, -1])), i))
        return [*out, ("a", None, at(3), -1), ("a", at(3), None, -2)]

    left, right = made(60), made(60)
    reach = dt.timedelta(hours=tolerance)
    found = overlapping(spark.createDataFrame(left, INTERVAL), spark.createDataFrame(right, INTERVAL), ["k"], reach, dt.timedelta(hours=width))
    expected = [
        (x[3], y[3]) for x in left for y in right
        if x[0] is not None and x[0] == y[0] and None not in (*x[1:3], *y[1:3]) and x[1] <= x[2] and y[1] <= y[2]
        and x[1] <= y[2] + reach and y[1] <= x[2] + reach
    ]
    assert found.columns == ["k", "start_date", "end_date", "note", "other_start_date", "other_end_date", "other_note"]
    assert sorted((r.note, r.other_note) for r in found.collect()) == sorted(expected)


def test_overlaps_join_by_key_and_bin(spark, plan_of):
    rows = spark.createDataFrame([("a", at(0), at(1), 1)], INTERVAL)
    plan = plan_of(overlapping(rows, rows, ["k"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SortMergeJoin [k" in plan and "_bin" in plan[plan.index("SortMergeJoin"):].splitlines()[0]


def test_a_hot_key_is_spread_over_its_bins(spark):
    days = spark.range(4000).select(
        F.lit("hot").alias("k"),
        (F.lit(at(0)) + F.make_dt_interval(F.col("id").cast("int"))).cast("timestamp_ntz").alias("start_date"),
    )
    rows = days.withColumn("end_date", F.col("start_date")).withColumn("note", F.lit(1))
    before = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = overlapping(rows, rows, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


# Stored batches

READ = "k string, ts timestamp, note int"


def read(k, day, note=0):
    return (k, dt.datetime(2024, 1, 1) + dt.timedelta(days=day), note)


def copies(spark, tmp_path, batches):
    """Kept rows of each form, with one file per batch."""
    source, root = f"{tmp_path}/in", f"{tmp_path}/rows"
    for batch in batches:
        spark.createDataFrame(batch, READ).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(READ).parquet(source)
        flows.append_first_copies(stream, ["k"], "ts", root, f"{tmp_path}/state").awaitTermination()
        state = flows.drop_late_copies(spark.readStream.schema(READ).parquet(source), ["k"], "ts")
        flows.append_available(state, f"{tmp_path}/kept", f"{tmp_path}/other").awaitTermination()

    def kept(path):
        return sorted((r.k or "", (r.ts - dt.datetime(2024, 1, 1)).days) for r in spark.read.schema(READ).parquet(path).collect())

    return kept(root), kept(f"{tmp_path}/kept")


def test_late_older_rows_are_copies(spark, tmp_path):
    batches = [[read("a", 5), read("b", 5)], [read("a", 3), read("c", 4)], [read("b", 9), read(None, 20)], [read("z", 30), read(None, 22)], [read("a", 31), read(None, 26)]]
    stored, state = copies(spark, tmp_path, batches)
    assert stored == state == [("", 20), ("a", 5), ("a", 31), ("b", 5), ("c", 4), ("z", 30)]


def test_rows_far_apart_are_kept_however_they_are_dealt(spark, tmp_path):
    rows = [read("a", d) for d in (0, 3, 8, 12, 16, 40)] + [read("b", 1)]
    expected = [("a", 0), ("a", 8), ("a", 16), ("a", 40), ("b", 1)]
    for name, batches in (("one", [rows]), ("some", [rows[:2], rows[2:4], rows[4:]])):
        (tmp_path / name).mkdir()
        assert copies(spark, tmp_path / name, batches)[0] == expected


def test_old_batches_are_not_opened(spark, tmp_path):
    root = str(tmp_path / "rows")
    for number, day in enumerate((0, 30, 60, 62)):
        stamp = int((dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day)).timestamp() * 1e6)
        tables.set_mark(spark, f"{root}/{flows.SPANS}", f"{number}_{stamp}_{stamp}")
    now = int((dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=64)).timestamp() * 1e6)
    near = flows.near_batches(spark, root, 9, (now, now), dt.timedelta(days=7))
    assert near == [f"{root}/batch=2", f"{root}/batch=3"]
    assert flows.near_batches(spark, root, 3, (now, now), dt.timedelta(days=7)) == [f"{root}/batch=2"]
    assert flows.near_batches(spark, root, 9, (None, None), dt.timedelta(days=7)) == []
