"""Streaming forms over files that arrive in steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tiermart.operators.intervals import islands
from tiermart.plans import shortages
from tiermart.sinks import tables
from tiermart.streaming import flows

SCHEMA = "k string, ts timestamp"
GAP = dt.timedelta(hours=13)


def arrive(spark, path, *rows):
    frame = spark.createDataFrame(list(rows), "k string, t string")
    frame.select("k", F.col("t").cast("timestamp").alias("ts")).write.mode("append").parquet(path)


def load(spark, inbox, out, state):
    stream = flows.stream_files(spark, inbox, SCHEMA)
    flows.append_available(stream, out, state).awaitTermination()


def test_only_new_files_are_loaded(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, inbox, ("a", "2024-01-05 00:00:00"))
    for _ in range(2):
        load(spark, inbox, out, state)
    assert spark.read.parquet(out).count() == 1
    arrive(spark, inbox, ("late", "2024-01-01 00:00:00"))
    load(spark, inbox, out, state)
    assert {r.k for r in spark.read.parquet(out).collect()} == {"a", "late"}


def test_processed_files_are_archived(spark, tmp_path):
    inbox, done, out, state = (str(tmp_path / n) for n in ("in", "done", "out", "state"))
    for text in ("a", "b", "c"):
        arrive(spark, inbox, (text, "2024-01-05 00:00:00"))
        stream = flows.stream_files(spark, inbox, SCHEMA, archive=done, maxFilesPerTrigger="1")
        flows.append_available(stream, out, state).awaitTermination()
    assert list((tmp_path / "done").rglob("*.parquet"))
    assert {r.k for r in spark.read.parquet(out).collect()} == {"a", "b", "c"}


def deduplicated(spark, inbox, out, state, way):
    stream = flows.stream_files(spark, inbox, SCHEMA, maxFilesPerTrigger="1")
    if way == "state":
        flows.append_available(flows.drop_late_copies(stream, ["k"], "ts"), out, state).awaitTermination()
    else:
        flows.append_first_copies(stream, ["k"], "ts", out, state).awaitTermination()
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(out)


@pytest.mark.parametrize("way", ["state", "batches"])
def test_keys_come_back_after_they_are_forgotten(spark, tmp_path, way):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    keys = spark.range(50).selectExpr("concat('k', id) as k")
    for day in ("2024-01-01", "2024-01-07", "2024-01-16"):
        keys.withColumn("ts", F.lit(day).cast("timestamp")).coalesce(1).write.mode("append").parquet(inbox)
        deduplicated(spark, inbox, out, state, way)
        # A row of another key moves the watermark on.
        if day == "2024-01-07":
            arrive(spark, inbox, ("step", "2024-01-15 12:00:00"))
            deduplicated(spark, inbox, out, state, way)
    assert deduplicated(spark, inbox, out, state, way).count() == 101


@pytest.mark.parametrize("way", ["state", "batches"])
def test_copies_within_seven_days_are_dropped(spark, tmp_path, way):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    times = [("a", "2024-01-01"), ("a", "2024-01-06"), ("b", "2024-01-02")]
    for row in times:
        arrive(spark, inbox, row)
        found = deduplicated(spark, inbox, out, state, way)
    assert sorted(r.k for r in found.collect()) == ["a", "b"]


def test_periods_equal_batch_islands(spark, tmp_path):
    inbox, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    steps = [
        [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 13:00:00"), ("b", "2024-01-01 00:00:00")],
        [("a", "2024-01-02 02:00:01"), ("b", "2024-01-01 05:00:00")],
    ]
    setting = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(setting)
    for rows in steps:
        arrive(spark, inbox, *rows)
        periods = flows.stream_periods(flows.stream_files(spark, inbox, SCHEMA), ["k"], "ts", GAP)
        flows.replace_available(periods, root, "p", state).awaitTermination()
    assert spark.conf.get(setting) == before
    found = tables.open_table(spark, root, "p").select("k", "start_date", "end_date")
    batch = islands(spark.read.parquet(inbox), ["k"], "ts", GAP)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.collect()))


def test_closed_shortages_equal_the_batch_plan(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "supplier_id long, facility_id string, product_code string, snapshot_timestamp timestamp"
    rows = [(1, f, "p", f"2024-01-0{d} 00:00:00") for f in ("F", " ", None) for d in (1, 2, 5)]
    late = [(1, "F", "q", "2024-03-01 00:00:00")]
    for part in (rows, late, late):
        frame = spark.createDataFrame(part, "supplier_id long, facility_id string, product_code string, t string")
        frame.select("supplier_id", "facility_id", "product_code", F.col("t").cast("timestamp").alias("snapshot_timestamp")).write.mode("append").parquet(inbox)
        periods = flows.stream_shortages(flows.stream_files(spark, inbox, schema), dt.timedelta(days=2))
        flows.append_available(periods, out, state).awaitTermination()
    found = spark.read.parquet(out).select("facility_id", "product_code", "start_date", "end_date")
    batch = shortages.shortage_periods(spark.read.parquet(inbox)).where("product_code = 'p'")
    expected = batch.select("facility_id", "product_code", "start_date", "end_date")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert found.count() > 0


def test_a_new_checkpoint_goes_on_after_older_versions(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    for n, state in enumerate(("s1", "s2"), 1):
        arrive(spark, inbox, (f"k{n}", "2024-01-01 00:00:00"))
        periods = flows.stream_periods(flows.stream_files(spark, inbox, SCHEMA), ["k"], "ts", GAP)
        flows.replace_available(periods, root, "p", str(tmp_path / state)).awaitTermination()
    assert tables.versions(spark, root, "p")[-1] > 1
    assert tables.open_table(spark, root, "p").count() == 2
