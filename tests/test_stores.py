"""Stored tables: bucketed parts, states of folders, refreshed mart, marked loads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks import shapes
from tiermart.functions import fixed
from tiermart.plans import sales_lines, sales_mart, shortages, telemetry
from tiermart.sinks import bucketed, mart, states, tables
from tiermart.sinks import sales_lines as stored_lines
from tiermart.sinks import shortages as stored_shortages

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


# Bucketed parts

LAYOUT = bucketed.Layout(("k", "l"), ("k",), 4)


def test_parts_are_read_and_merged_in_place(spark, tmp_path):
    root = str(tmp_path)
    made = [spark.range(100 * i, 100 * i + 60).selectExpr("id % 7 as k", "string(id) as l", "id") for i in range(3)]
    for i, part in enumerate(made):
        assert bucketed.write_part(part, f"{root}/run={i}", LAYOUT) == 60
    paths = [f"{root}/run={i}" for i in range(3)]
    whole = bucketed.open_parts(spark, root, paths, LAYOUT)
    assert rows(whole) == rows(made[0].union(made[1]).union(made[2]))
    assert bucketed.merge_parts(spark, root, paths, f"{root}/merged=2", LAYOUT) == 180
    assert rows(bucketed.open_parts(spark, root, [f"{root}/merged=2"], LAYOUT)) == rows(whole)
    files = [n for n in tables.names_in(spark, f"{root}/merged=2") if n.endswith(".parquet")]
    assert len(files) <= 4
    # Written again, as after a run that was cut short.
    assert bucketed.write_part(made[0], f"{root}/run=1", LAYOUT) == 60
    assert rows(bucketed.open_parts(spark, root, paths[:2], LAYOUT)) == rows(made[0].union(made[0]))


def test_merging_needs_no_shuffle(spark, tmp_path):
    root = str(tmp_path)
    part = spark.range(50).selectExpr("id as k", "string(id) as l")
    for i in range(2):
        bucketed.write_part(part, f"{root}/run={i}", LAYOUT)
    with bucketed.settings(spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
        plan = bucketed.open_parts(spark, root, [f"{root}/run=0", f"{root}/run=1"], LAYOUT)
        assert plan.rdd.getNumPartitions() == 4
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_upsert_finds_stored_history_without_a_shuffle(spark, tmp_path, plan_of):
    root = str(tmp_path)
    stored_lines.create_lines(shapes.prior_lines(spark, SF_DIR), root, buckets=6)
    history = tables.stage_once(shapes.history_lines(spark, SF_DIR))
    active = tables.stage_once(shapes.active_lines(spark, SF_DIR))
    stored_lines.run_upsert(active, history, root)
    known = stored_lines.open_history(spark, root)
    plan = plan_of(stored_lines.unknown_history(history, known, active))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    # Walk up from the scan to the join that it feeds.
    for line in reversed(lines[:scan]):
        level = len(line) - len(line.lstrip(" :+-"))
        if level < depth:
            depth = level
            assert "Exchange" not in line
            if "Join" in line:
                break
    else:
        pytest.fail("no join above the history scan")


def test_merged_runs_keep_rows_and_readers(spark, tmp_path):
    root = str(tmp_path)
    target = shapes.prior_lines(spark, SF_DIR)
    active, history = (tables.stage_once(f(spark, SF_DIR)) for f in (shapes.active_lines, shapes.history_lines))
    stored_lines.create_lines(target, root, buckets=3)
    stored_lines.run_upsert(active, history, root)
    before = rows(stored_lines.open_lines(spark, root))
    reader = stored_lines.open_lines(spark, root)
    # A merge that did not finish is not seen, and does no harm to the next.
    history_folder = f"{root}/{stored_lines.HISTORY}"
    spark.range(3).write.option(tables.MARKING, "false").parquet(f"{history_folder}/merged=2")
    assert rows(stored_lines.open_lines(spark, root)) == before
    merged = stored_lines.merge_runs(spark, root)
    assert rows(stored_lines.open_lines(spark, root)) == rows(reader) == before
    assert stored_lines.merge_runs(spark, root) == merged
    assert stored_lines.drop_merged_runs(spark, root) == 2
    assert stored_lines.drop_merged_runs(spark, root) == 0
    assert rows(stored_lines.open_lines(spark, root)) == before
    expected = sales_lines.upsert_sales_lines(sales_lines.upsert_sales_lines(target, active, history), active, history)
    stored_lines.run_upsert(active, history, root)
    assert rows(stored_lines.open_lines(spark, root)) == rows(expected)


# States


def part(spark, name, *values):
    return spark.createDataFrame([(name, v) for v in values], "name string, v int")


def test_a_commit_is_seen_whole_and_once(spark, tmp_path):
    root = str(tmp_path)
    first, n = states.write_parts(part(spark, "a", 1, 2).union(part(spark, "b", 3)), root, str, "name")
    assert n == 3 and states.read_state(spark, root).number == 0
    one = states.commit(spark, root, states.State(), first, {"x": 5})
    seen = states.read_state(spark, root)
    assert seen == one and seen.notes == {"x": 5}
    new, _ = states.write_parts(part(spark, "b", 9).union(part(spark, "c", 4)), root, str, "name")
    # Between writing and committing a reader sees the old state.
    assert rows(states.open_parts(spark, root, states.read_state(spark, root))) == ["('a', 1)", "('a', 2)", "('b', 3)"]
    two = states.commit(spark, root, seen, {**new, "a": None}, {"y": "z"})
    assert rows(states.open_parts(spark, root, two)) == ["('b', 9)", "('c', 4)"]
    assert two.notes == {"x": 5, "y": "z"}
    # Readers of the old state are not disturbed until old states are dropped.
    assert len(rows(states.open_parts(spark, root, seen))) == 3
    assert states.drop_old_states(spark, root, keep=1) == 2
    assert rows(states.open_parts(spark, root, states.read_state(spark, root))) == ["('b', 9)", "('c', 4)"]


def test_the_second_writer_fails_and_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    base = states.commit(spark, root, states.State(), states.write_parts(part(spark, "a", 1), root, str, "name")[0])
    mine, theirs = (states.write_parts(part(spark, "a", v), root, str, "name")[0] for v in (2, 3))
    states.commit(spark, root, base, theirs)
    with pytest.raises(states.Conflict):
        states.commit(spark, root, base, mine)
    assert rows(states.open_parts(spark, root, states.read_state(spark, root))) == ["('a', 3)"]
    assert not [n for n in tables.names_in(spark, f"{root}/{states.STATES}") if n.startswith("draft")]


# Shortage history


SNAPSHOT = "supplier_id int, facility_id string, product_code string, snapshot_timestamp timestamp_ntz"


def snapshots(spark, *given):
    return spark.createDataFrame([(1, "F1", p, dt.datetime.fromisoformat(t)) for p, t in given], SNAPSHOT)


def history_rows(spark, root):
    return rows(stored_shortages.open_history(spark, root).drop(stored_shortages.MONTH))


def test_two_consolidations_at_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    stored_shortages.create_history(shortages.shortage_periods(snapshots(spark, ("P", "2024-01-30 05:00"))), root)
    new = snapshots(spark, ("P", "2024-01-30 09:00"), ("Q", "2024-02-01 01:00"))
    write = stored_shortages._write

    def slow(after, to):
        # Another run commits between this one's reading and its commit.
        monkeypatch.setattr(stored_shortages, "_write", write)
        stored_shortages.run_consolidation(snapshots(spark, ("R", "2024-01-31 01:00")), root, dt.date(2024, 2, 1))
        return write(after, to)

    monkeypatch.setattr(stored_shortages, "_write", slow)
    with pytest.raises(states.Conflict):
        stored_shortages.run_consolidation(new, root, dt.date(2024, 2, 1))
    seen = history_rows(spark, root)
    assert len(seen) == 2 and not any("'Q'" in r for r in seen)
    assert stored_shortages.run_consolidation(new, root, dt.date(2024, 2, 1)) == 1
    assert len(history_rows(spark, root)) == 3


@pytest.mark.parametrize("stop", ["before commit", "after commit"])
def test_stream_applies_each_batch_once(spark, tmp_path, monkeypatch, stop):
    root, source = f"{tmp_path}/store", f"{tmp_path}/in"
    first = snapshots(spark, ("P", "2024-01-28 05:00"))
    expected = shortages.shortage_periods(first)
    stored_shortages.create_history(expected, root)
    deliveries = [
        snapshots(spark, ("P", "2024-01-28 10:00"), ("Q", "2024-01-31 20:00")),
        snapshots(spark, ("Q", "2024-02-01 03:00"), ("P", "2024-02-01 04:00")),
        snapshots(spark, ("Q", "2024-02-02 03:00")),
    ]

    def run():
        stream = spark.readStream.schema(SNAPSHOT).parquet(source)
        query = stored_shortages.consolidate_stream(stream, root, f"{tmp_path}/state")
        query.awaitTermination()

    commit = states.commit

    def cut(*arguments, **named):
        if stop == "after commit":
            commit(*arguments, **named)
        raise RuntimeError("cut short")

    for i, delivery in enumerate(deliveries):
        delivery.coalesce(1).write.mode("append").parquet(source)
        if i == 1:
            monkeypatch.setattr(states, "commit", cut)
            with pytest.raises(Exception, match="cut short"):
                run()
            monkeypatch.setattr(states, "commit", commit)
        run()
        run()
        day = delivery.agg(F.max(F.to_date("snapshot_timestamp"))).first()[0]
        expected = tables.stage_once(shortages.consolidate(expected, shortages.shortage_periods(delivery), day))
        assert history_rows(spark, root) == rows(expected)


# Mart


def channel_rows(spark, *given):
    """Rows of (order, push ordered, b2b delivered)."""
    schema = "order_prog_id string, ordered_qty_push double, delivered_qty_b2b double"
    base = spark.createDataFrame(list(given), schema)
    rest = {c: F.lit(None).cast("double") for c in fixed.CHANNEL_TOTALS if c not in base.columns}
    keys = {c: F.lit("1") for c in fixed.ORDER_KEYS if c not in base.columns}
    return base.withColumns(keys | rest).withColumn("history_prog_id", F.lit(1))


def mart_orders(spark, *given):
    """Orders of (order, date), other columns as in the derived orders."""
    like = shapes.mart_orders(spark, SF_DIR)
    base = spark.createDataFrame([(o, dt.datetime.fromisoformat(d)) for o, d in given], "order_prog_id string, order_date timestamp_ntz")
    keys = {c: F.lit("1") for c in fixed.ORDER_KEYS if c != "order_prog_id"}
    rest = {f.name: F.lit(None).cast(f.dataType) for f in like.schema if f.name not in (*base.columns, *keys)}
    return base.withColumns(keys | rest).withColumn("history_prog_id", F.lit(1)).select(*like.columns)


def folders(spark, root):
    return {n: f for n, f in states.read_state(spark, root).parts.items() if n.startswith("month/")}


def test_refreshed_mart_equals_a_rebuild(spark, tmp_path):
    root, as_of = str(tmp_path), dt.date(2024, 6, 10)
    orders = mart_orders(spark, *((f"O{i}", f"2024-0{1 + i % 5}-0{1 + i % 9}") for i in range(20)), ("O99", "2023-06-09"))
    lines = [(f"O{i % 22}", float(i % 4) if i % 3 else None, float(i)) for i in range(60)] + [(None, 1.0, 2.0), (None, 1.0, None)]
    now = list(lines)
    mart.create_mart(orders, channel_rows(spark, *now), as_of, root)
    rng = random.Random(3)
    for step in range(3):
        gone = rng.sample(now, 4) if step else [r for r in now if r[0] in ("O3", None)]
        came = [("O3", None, None), ("O7", -2.0, 1.0), (None, 5.0, 5.0), ("O50", 1.0, 1.0)][step:]
        for r in gone:
            now.remove(r)
        now += came
        changes = channel_rows(spark, *came).withColumn(mart.SIGN, F.lit(1)).unionByName(channel_rows(spark, *gone).withColumn(mart.SIGN, F.lit(-1)))
        before = folders(spark, root)
        months = mart.refresh_mart(orders, changes, as_of, root)
        expected = sales_mart.sales_orders_extended(orders, channel_rows(spark, *now), as_of)
        assert rows(mart.open_mart(spark, root).drop(mart.MONTH)) == rows(expected)
        kept = {n: f for n, f in folders(spark, root).items() if n not in months}
        assert kept == {n: f for n, f in before.items() if n not in months}
        touched = {r[0] for r in (*gone, *came)}
        assert set(months) == {f"month/2024{1 + i % 5:02d}" for i in range(20) if f"O{i}" in touched}


def test_mart_follows_orders_and_the_window(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mart, "MERGE_AFTER", 2)
    root = str(tmp_path)
    given = [("O1", "2023-06-20"), ("O2", "2023-07-05"), ("O3", "2024-05-01")]
    lines = channel_rows(spark, ("O1", 1.0, None), ("O2", 2.0, 1.0), ("O4", None, 4.0))
    none = channel_rows(spark).withColumn(mart.SIGN, F.lit(1))
    mart.create_mart(mart_orders(spark, *given), lines, dt.date(2024, 6, 10), root)
    changed = spark.sql("select timestamp_ntz'2024-05-01' order_date union all select timestamp_ntz'2024-06-30'")
    steps = [
        (dt.date(2024, 6, 10), [("O1", "2023-06-20"), ("O2", "2023-07-05"), ("O3", "2024-06-30")], changed),
        (dt.date(2024, 7, 1), given, changed),
        (dt.date(2024, 7, 20), [*given, ("O4", "2024-07-02")], spark.sql("select timestamp_ntz'2024-07-02' order_date")),
        (dt.date(2024, 6, 1), [*given, ("O4", "2024-07-02")], None),
    ]
    for as_of, now, dates in steps:
        mart.refresh_mart(mart_orders(spark, *now), none, as_of, root, dates)
        expected = sales_mart.sales_orders_extended(mart_orders(spark, *now), lines, as_of)
        assert rows(mart.open_mart(spark, root).drop(mart.MONTH)) == rows(expected)
    assert mart.open_mart(spark, root, [202407]).count() == 1


# Scratch


def test_intermediate_tables_go_with_their_run(spark, tmp_path):
    out = str(tmp_path / "out")
    with tables.scratch(spark) as folder:
        once = tables.stage_once(spark.range(5))
        assert any("stage-" in n for n in tables.names_in(spark, folder))
        once.write.parquet(out)
    assert tables.names_in(spark, folder) == []
    assert spark.read.parquet(out).count() == 5
    other = tables.shared_folder(spark, "later")
    assert not other.startswith(folder)


def test_audit_needs_keys_only(spark):
    prior, past = (shapes.prior_keys(spark, SF_DIR), shapes.history_keys(spark, SF_DIR))
    active = tables.stage_once(shapes.active_lines(spark, SF_DIR))
    whole = sales_lines.upsert_audit(shapes.prior_lines(spark, SF_DIR), active, shapes.history_lines(spark, SF_DIR))
    assert rows(sales_lines.upsert_audit(prior, active, past)) == rows(whole)


# Loads


def reads(spark, *given):
    return spark.createDataFrame(list(given), "id string, date string, time string, note string")


def test_marked_loads_take_late_and_equal_rows(spark, tmp_path):
    root = str(tmp_path)
    one = [("1", "2024-01-01", "10:00:00", "a"), ("2", "2024-01-03", "09:00:00", None)]
    two = [("3", "2024-01-03", "09:00:00", "equal to the mark"), ("4", "2024-01-02", "23:59:59", "late"), ("5", "2023-12-31", "00:00:00", "too late")]
    load = telemetry.load_with_mark
    assert load(spark, reads(spark), root) == 0
    assert load(spark, reads(spark, *one), root) == 2
    assert states.read_state(spark, root).notes[telemetry.MARK] == "2024-01-03 09:00:00"
    assert load(spark, reads(spark, *one), root) == 0
    assert load(spark, reads(spark, *one, *two), root) == 2
    assert load(spark, reads(spark, *one, *two), root, overlap=dt.timedelta(days=30)) == 1
    assert load(spark, reads(spark, ("9", None, "1", "no date")), root) == 1
    assert load(spark, reads(spark, ("9", None, "1", "no date")), root) == 0
    found = telemetry.open_loads(spark, root)
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 4, 5, 9]
    assert states.read_state(spark, root).notes[telemetry.MARK] == "2024-01-03 09:00:00"


def test_only_near_days_of_source_and_table_are_read(spark, tmp_path, plan_of):
    path = str(tmp_path / "source")
    reads(spark, ("1", "2024-01-01", "10:00:00", "a")).write.parquet(path)
    plan = plan_of(telemetry.days_since(spark.read.parquet(path), "2024-01-20 08:00:00", dt.timedelta(days=2)))
    assert "GreaterThanOrEqual(date,2024-01-18)" in plan


def test_append_writes_once_and_nothing_for_no_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    for n in (3, 0, 2):
        assert tables.append_rows(spark.range(0, n, 1, 1).mapInArrow(counted, "id long"), path) == n
    assert runs.value == 2  # a plan without rows has no task
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 0, 1, 1, 2]
    assert not [n for n in tables.names_in(spark, path) if n.startswith("_append")]


def test_lines_staged_by_order_stay_in_their_buckets(spark, tmp_path, plan_of):
    root = str(tmp_path)
    feed = bucketed.stage(shapes.sales_feed(spark, SF_DIR), bucketed.Layout(("src_order_id",), ("src_order_id",), 4))
    ties = shapes.tie_breaks()
    target = sales_lines.history_lines(shapes.prior_feed(feed), ties)
    stored_lines.create_lines(target, root, buckets=4, by=["order_prog_id"])
    active = stored_lines.stage_lines(sales_lines.active_lines(feed, ties), root)
    history = stored_lines.stage_lines(sales_lines.history_lines(shapes.past_feed(feed), ties), root)
    with bucketed.settings(spark, bucketed.IN_PLACE):
        for lines in (sales_lines.active_lines(feed, ties), target):
            assert "Exchange" not in plan_of(lines)
        missing = stored_lines.unknown_history(history, stored_lines.open_history(spark, root), active)
        assert "Exchange" not in plan_of(missing)
    expected = target
    for _ in range(2):
        counts = {r.step: r.n_rows for r in sales_lines.upsert_audit(expected, active, history).collect()}
        assert stored_lines.run_upsert(active, history, root, staged=True) == counts
        expected = tables.stage_once(sales_lines.upsert_sales_lines(expected, active, history))
        assert rows(stored_lines.open_lines(spark, root)) == rows(expected)
        stored_lines.merge_runs(spark, root)
    # A bucket is one file, so nothing was scattered on the way.
    files = [f for f in tables.names_in(spark, f"{root}/{stored_lines.HISTORY}/merged=3") if f.endswith(".parquet")]
    assert len(files) <= 4
    with pytest.raises(ValueError):
        stored_lines.create_lines(target, f"{root}/other", by=["uom"])
