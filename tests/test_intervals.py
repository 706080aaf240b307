"""Islands, consolidation and containment on hand-made and random rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tiermart.operators.intervals import island_rows, islands, not_contained
from checks import shapes
from tiermart.plans import shortages
from tiermart.sinks import shortages as stored

KEYS = shortages.KEYS
GAP = shortages.GAP
SNAPSHOT = "supplier_id long, facility_id string, product_code string, snapshot_timestamp {}"
INTERVAL = (
    "supplier_id long, facility_id string, product_code string,"
    " start_date timestamp_ntz, end_date timestamp_ntz"
)


def at(text):
    return dt.datetime.fromisoformat(text)


def intervals(spark, *rows, key=(1, "F1", "P1")):
    return spark.createDataFrame([(*key, at(a), at(b)) for a, b in rows], INTERVAL)


def bounds(df):
    return sorted((r.start_date, r.end_date) for r in df.collect())


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_gap_edge(spark, kind):
    times = ["2024-01-01 00:00:00", "2024-01-01 13:00:00", "2024-01-02 02:00:01"]
    text = spark.createDataFrame([(1, "F1", "P1", t) for t in times], SNAPSHOT.format("string"))
    seen = text.withColumn("snapshot_timestamp", F.col("snapshot_timestamp").cast(kind))
    found = shortages.shortage_periods(seen).select(
        F.col("start_date").cast("string"), F.col("end_date").cast("string")
    )
    assert sorted(map(tuple, found.collect())) == [(times[0], times[1]), (times[2], times[2])]


def test_blank_facilities_are_dropped(spark):
    rows = [(1, f, "P1", at("2024-01-01")) for f in (None, "", "  ", " F1 ")]
    seen = spark.createDataFrame(rows, SNAPSHOT.format("timestamp_ntz"))
    assert [r.facility_id for r in shortages.shortage_periods(seen).collect()] == [" F1 "]


def brute_rows(rows, gap):
    """Row-by-row reading of the whole key: lag, flag and running sum."""
    out = []
    by_key = {}
    for *key, ts in rows:
        by_key.setdefault(tuple(key), []).append(ts)
    for key, times in by_key.items():
        times.sort(key=lambda t: (t is None, t))
        previous, island = None, 0
        for ts in times:
            broken = previous is None or (ts is not None and ts > previous + gap)
            island += broken
            out.append((*key, ts, previous, int(broken), island))
            previous = ts
    return out


def brute_islands(rows, gap):
    groups = {}
    for *key, ts, _, _, island in brute_rows(rows, gap):
        groups.setdefault((*key, island), []).append(ts)
    found = set()
    for (*key, _), times in groups.items():
        known = [t for t in times if t is not None]
        found.add((*key, min(known, default=None), max(known, default=None)))
    return found


def order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("seed", range(3))
def test_islands_equal_row_by_row_reading(spark, seed):
    """Ties, NULL times, NULL keys, and one key with most of the rows."""
    pick = random.Random(seed)
    start = at("2023-12-31 20:00:00")
    rows = []
    for _ in range(600):
        key = (1, "F1", "P1") if pick.random() < 0.4 else (
            pick.choice([1, 2, None]), pick.choice(["F1", "F2"]), pick.choice(["P1", "P2", None])
        )
        ts = start + dt.timedelta(minutes=pick.randrange(0, 60 * 24 * 40, 7))
        rows.append((*key, pick.choice([ts, ts, ts, ts, start, None])))
    seen = spark.createDataFrame(rows, SNAPSHOT.format("timestamp_ntz"))
    detail = island_rows(seen, KEYS, "snapshot_timestamp", GAP)
    assert order(map(tuple, detail.collect())) == order(brute_rows(rows, GAP))
    found = islands(seen, KEYS, "snapshot_timestamp", GAP)
    assert order(map(tuple, found.collect())) == order(brute_islands(rows, GAP))


def test_islands_of_a_key_are_more_than_a_gap_apart(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    runs = islands(events, ["user_id"], "ts", GAP)
    after = runs.withColumnsRenamed({"start_date": "s", "end_date": "e"})
    close = runs.join(after, "user_id").where(
        (F.col("s") > F.col("start_date")) & (F.col("s") <= F.col("end_date") + F.lit(GAP))
    )
    assert close.isEmpty()


def test_copies_are_written_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("tiermart.operators.intervals.COPIES_PER_TASK_ROW", 10)
    rows = [(1, "F1", "P1", at("2024-01-01"))] * 25 + [(1, "F1", "P1", at("2024-01-03"))]
    seen = spark.createDataFrame(rows, SNAPSHOT.format("timestamp_ntz"))
    detail = island_rows(seen, KEYS, "snapshot_timestamp", GAP)
    assert order(map(tuple, detail.collect())) == order(brute_rows(rows, GAP))


def test_hot_key_is_reduced_before_the_shuffle(spark, plan_of):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = plan_of(islands(events, ["user_id"], "ts", GAP)).splitlines()
    first_exchange = max(i for i, line in enumerate(lines) if "Exchange hash" in line)
    assert "partial_min" in lines[first_exchange + 1]
    assert "_slice" in lines[first_exchange] or "_groupingexpression" in lines[first_exchange]


@pytest.mark.parametrize("seed", range(3))
def test_containment_equals_pairwise_test(spark, seed):
    pick = random.Random(seed)

    def some(n, longest):
        found = []
        for _ in range(n):
            key = (1, "F1", "P1") if pick.random() < 0.5 else (
                pick.choice([1, None]), pick.choice(["F1", "F2"]), "P1"
            )
            start = at("2023-12-30") + dt.timedelta(minutes=pick.randrange(0, 60 * 24 * 6, 11))
            found.append((*key, start, start + dt.timedelta(minutes=pick.randrange(longest))))
        return found

    asked, others = some(150, 400), some(150, 1200)
    others += [(1, "F1", "P1", None, at("2024-02-01")), (1, "F1", "P1", at("2023-12-01"), None)]
    others += [asked[0]] * 3

    def inside(n, s):
        known = None not in n[:3] and s[3] is not None and s[4] is not None
        return known and n[:3] == s[:3] and s[3] <= n[3] and s[4] >= n[4]

    expected = [n for n in asked if not any(inside(n, s) for s in others)]
    found = not_contained(
        spark.createDataFrame(asked, INTERVAL), spark.createDataFrame(others, INTERVAL), KEYS
    )
    assert order(map(tuple, found.collect())) == order(expected)


def consolidate(spark, history, new, as_of=dt.date(2024, 1, 10)):
    return bounds(
        shortages.consolidate(intervals(spark, *history), intervals(spark, *new), as_of)
    )


def test_extension_can_shrink(spark):
    history = [("2024-01-08 00:00", "2024-01-10 00:00")]
    new = [("2024-01-08 06:00", "2024-01-09 00:00")]
    assert consolidate(spark, history, new) == [(at("2024-01-08"), at("2024-01-09"))]


def test_only_the_first_period_extends(spark):
    history = [("2024-01-08 00:00", "2024-01-10 00:00")]
    new = [("2024-01-09 00:00", "2024-01-10 06:00"), ("2024-01-10 08:00", "2024-01-10 20:00")]
    assert consolidate(spark, history, new) == [
        (at("2024-01-08"), at("2024-01-10 06:00")),
        (at("2024-01-10 08:00"), at("2024-01-10 20:00")),
    ]


def test_contained_period_is_not_inserted(spark):
    history = [("2024-01-01 00:00", "2024-01-09 00:00"), ("2024-01-09 20:00", "2024-01-10 00:00")]
    new = [("2024-01-02 00:00", "2024-01-03 00:00"), ("2024-01-09 22:00", "2024-01-10 04:00")]
    found = consolidate(spark, history, new)
    # The first new period ends before the open interval starts, so nothing extends.
    assert found == sorted([(at(a), at(b)) for a, b in history] + [(at(new[1][0]), at(new[1][1]))])


def test_old_history_is_not_extended(spark):
    history = [("2024-01-01 00:00", "2024-01-02 23:59")]
    new = [("2024-01-03 01:00", "2024-01-03 02:00")]
    assert len(consolidate(spark, history, new)) == 2
    assert len(consolidate(spark, history, new, dt.date(2024, 1, 9))) == 1


def test_all_rows_with_the_extended_start_get_the_new_end(spark):
    history = [("2024-01-08 00:00", "2024-01-10 00:00"), ("2024-01-08 00:00", "2024-01-08 05:00")]
    new = [("2024-01-10 01:00", "2024-01-10 09:00")]
    assert consolidate(spark, history, new) == [(at("2024-01-08"), at("2024-01-10 09:00"))] * 2


def test_other_columns_of_history_survive(spark):
    history = intervals(spark, ("2024-01-08 00:00", "2024-01-10 00:00"))
    history = history.withColumn("note", F.lit("x"))
    new = intervals(spark, ("2024-01-12 00:00", "2024-01-12 01:00"))
    found = shortages.consolidate(history, new, dt.date(2024, 1, 12)).collect()
    assert sorted(str(r.note) for r in found) == ["None", "x"]


def test_no_pairwise_joins(spark, plan_of):
    history = intervals(spark, ("2024-01-08 00:00", "2024-01-10 00:00"))
    plan = plan_of(shortages.consolidate(history, history, dt.date(2024, 1, 10)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_recent_history_is_pushed_to_the_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "history")
    intervals(spark, ("2024-01-08 00:00", "2024-01-10 00:00")).write.parquet(path)
    plan = plan_of(shortages.open_baseline(spark.read.parquet(path), dt.date(2024, 1, 10)))
    assert "GreaterThanOrEqual(end_date,2024-01-03T00:00)" in plan


def stored_rows(spark, root):
    return order(map(tuple, stored.open_history(spark, root).drop(stored.MONTH).collect()))


def test_stored_history_follows_the_plan(spark, tmp_path):
    """Three runs over the events, month by month, against the one-table plan."""
    root = str(tmp_path)
    seen = shapes.snapshots(spark, "/root/testdata/sf0.001").withColumn(
        "snapshot_timestamp", F.col("snapshot_timestamp") + F.lit(dt.timedelta(days=12))
    )

    def until(first, last):
        return seen.where(F.col("snapshot_timestamp").between(F.lit(first), F.lit(last)))

    expected = shortages.shortage_periods(until("2024-01-01", "2024-01-25"))
    stored.create_history(expected, root)
    for day in (28, 31, 34):
        as_of = dt.date(2024, 1, 1) + dt.timedelta(days=day)
        new = until(str(as_of - dt.timedelta(days=7)), str(as_of))
        before = expected.count()
        expected = shortages.consolidate(expected, shortages.shortage_periods(new), as_of)
        path = str(tmp_path / f"expected{day}")
        expected.write.parquet(path)
        expected = spark.read.parquet(path)
        assert stored.run_consolidation(new, root, as_of) == expected.count() - before
        assert stored_rows(spark, root) == order(map(tuple, expected.collect()))


def test_run_cut_short_leaves_the_history(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    stored.create_history(intervals(spark, ("2024-01-08 00:00", "2024-01-10 00:00")), root)
    new = spark.createDataFrame(
        [(1, "F1", "P1", at("2024-01-10 01:00")), (2, "F1", "P1", at("2024-01-10 02:00"))],
        SNAPSHOT.format("timestamp_ntz"),
    )
    untouched = stored_rows(spark, root)

    def cut(*_):
        raise RuntimeError("cut short")

    commit = stored.states.commit
    monkeypatch.setattr(stored.states, "commit", cut)
    with pytest.raises(RuntimeError):
        stored.run_consolidation(new, root, dt.date(2024, 1, 10))
    assert stored_rows(spark, root) == untouched
    monkeypatch.setattr(stored.states, "commit", commit)
    assert stored.run_consolidation(new, root, dt.date(2024, 1, 10)) == 1
    assert stored_rows(spark, root) == order([
        (1, "F1", "P1", at("2024-01-08"), at("2024-01-10 01:00")),
        (2, "F1", "P1", at("2024-01-10 02:00"), at("2024-01-10 02:00")),
    ])


def test_a_dense_key_leaves_no_task_with_more_than_a_second(spark, plan_of):
    """Half a million microsecond steps of one key: rows per task of each window stay those of an hour's seconds."""
    step = F.lit(at("2024-01-08")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)") * F.lit(0.0001).cast("decimal(18,6)"))
    dense = spark.range(200_000).select(F.lit(1).alias("supplier_id"), F.lit("F1").alias("facility_id"), F.lit("P").alias("product_code"), step.cast("timestamp_ntz").alias("snapshot_timestamp"))
    detail = island_rows(dense, KEYS, "snapshot_timestamp", GAP)
    before = F.lag("snapshot_timestamp").over(Window.orderBy("snapshot_timestamp"))
    wrong = detail.withColumn("expected", before).where("NOT previous_timestamp <=> expected OR period_group_id <> 1")
    assert detail.count() == 200_000 and wrong.isEmpty()
    plan = plan_of(detail)
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("snapshot_timestamp" in line.split("windowspecdefinition")[1].split("specifiedwindowframe")[0] for line in windows if "windowspecdefinition" in line)


def test_run_without_changes_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    stored.create_history(intervals(spark, ("2024-01-08 00:00", "2024-01-10 00:00")), root)
    none = spark.createDataFrame([], SNAPSHOT.format("timestamp_ntz"))
    assert stored.run_consolidation(none, root, dt.date(2024, 1, 10)) == 0
    assert stored.states.read_state(spark, f"{root}/{stored.HISTORY}").number == 1
