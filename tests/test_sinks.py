"""Versions, empty loads, appends and bucketed layout."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tiermart.sinks import tables


def test_publish_replaces_what_it_reads(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(spark.range(3), root, "t")
    table = tables.open_table(spark, root, "t")
    done = tables.publish(table.where("id > 0"), root, "t")
    assert (done.n_rows, tables.versions(spark, root, "t")) == (2, [1, 2])
    assert spark.table("t").count() == 2
    assert tables.open_table(spark, root, "t", version=1).count() == 3


def test_unfinished_version_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(spark.range(3), root, "t")
    (tmp_path / "t" / "v=2").mkdir()
    assert tables.open_table(spark, root, "t").count() == 3
    assert tables.publish(spark.range(1), root, "t").path.endswith("v=3")


def test_empty_reload_keeps_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    tables.reload_staging(spark.range(3), root, "t")
    assert tables.reload_staging(spark.range(0), root, "t").n_rows == 0
    assert tables.open_table(spark, root, "t").count() == 3
    assert tables.publish(spark.range(0), root, "t").n_rows == 0
    assert tables.open_table(spark, root, "t").count() == 0


def test_counts_come_from_the_write(spark, tmp_path):
    rows = spark.range(10).withColumn("_step", F.col("id") % 2)
    odd = F.count_if(F.col("_step") == 1).alias("odd")
    done = tables.publish(rows, str(tmp_path), "t", counts=[odd], drop=["_step"])
    assert (done.n_rows, done.counts) == (10, {"odd": 5})
    assert spark.read.parquet(done.path).columns == ["id"]


def test_old_versions_are_dropped(spark, tmp_path):
    for n in range(1, 5):
        tables.publish(spark.range(n), str(tmp_path), "t")
    tables.drop_old_versions(spark, str(tmp_path), "t")
    assert tables.versions(spark, str(tmp_path), "t") == [3, 4]
    assert tables.publish(spark.range(9), str(tmp_path), "t").path.endswith("v=5")


def test_staging_is_removed(spark):
    with tables.staging(spark, "x") as folder:
        spark.range(1).write.parquet(f"{folder}/t")
        assert Path(folder).is_dir()
    assert not Path(folder).exists()


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.open_table(spark, str(tmp_path), "nothing")


def test_shared_folder_is_the_named_one(spark):
    assert tables.shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_bucketed_tables_join_without_a_shuffle(spark, plan_of):
    rows = spark.range(100).selectExpr("id % 7 as customer_code", "id as branch_code")
    for name in ("bucketed_a", "bucketed_b"):
        tables.write_bucketed(rows, name, 4, ["customer_code"], ["branch_code"])
    a, b = spark.table("bucketed_a"), spark.table("bucketed_b")
    plan = plan_of(a.join(b, "customer_code"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    spark.sql("drop table bucketed_a")
    spark.sql("drop table bucketed_b")


def test_no_empty_version_is_ever_committed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.reload_staging(spark.range(3), root, "t")
    seen = []

    def delete(session, path, really=tables._delete):
        seen.append(tables.versions(session, root, "t"))
        really(session, path)

    monkeypatch.setattr(tables, "_delete", delete)
    tables.reload_staging(spark.range(0), root, "t")
    assert seen == [[1]]


def test_a_cluster_needs_a_named_shared_folder():
    class Cluster:
        class conf:
            @staticmethod
            def get(name, default=None):
                return default

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(ValueError):
        tables.shared_folder(Cluster, "x")
