"""File reads: names, headers, empty matches, nested payloads, watermarks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tiermart.functions import fixed, names, typing
from tiermart.plans import catalog, loads, shipments, suppliers, telemetry
from tiermart.sinks import ledger
from tiermart.sources import bronze, delimited, incremental

CATALOG_HEADER = ",".join(fixed.CATALOG_COLUMNS)


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_catalog_files(spark, tmp_path):
    row = "1,ring,a,b,c,d,e,F,adult,30"
    write(tmp_path, "20240305_product_masterdata.csv", CATALOG_HEADER + ",extra", row + ",x")
    write(tmp_path, "product_masterdata.csv", CATALOG_HEADER, "2" + row[1:])
    write(tmp_path, "20240305_other.csv", CATALOG_HEADER, "3" + row[1:])
    found = catalog.standardise_catalog(catalog.read_catalog(spark, str(tmp_path)))
    dates = {r.ext_product_code: r.record_date for r in found.collect()}
    assert dates == {"1": dt.datetime(2024, 3, 5), "2": None}
    assert found.columns == [
        *[fixed.CATALOG_NAMES.get(c, c) for c in fixed.CATALOG_COLUMNS], "record_date"
    ]


def test_catalog_dedup_keeps_the_newest_file(spark):
    columns = [*fixed.CATALOG_COLUMNS, "filename"]
    rows = [
        ["1", desc, *["x"] * 8, f"{day}product_masterdata.csv"]
        for desc, day in [("old", "20240101_"), ("new", "20240102_"), ("undated", "")]
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    found = catalog.standardise_catalog(raw, dedup=True, run_ts=F.current_timestamp())
    assert [r.ext_product_desc for r in found.collect()] == ["new"]
    assert "ingestion_timestamp" in found.columns


def test_no_matching_file_gives_no_rows(spark, tmp_path):
    found = suppliers.read_missing_products(spark, str(tmp_path))
    assert found.columns == ["id_deposito", "minsan", "filename"] and found.isEmpty()


def test_missing_products_are_trimmed_and_stamped(spark, tmp_path):
    write(tmp_path, "missing_products_20240101_010203.csv", "id_deposito;minsan", "  D1 ; 12 ")
    raw = suppliers.read_missing_products(spark, str(tmp_path))
    stamp = F.lit("2024-02-01 06:00:00").cast("timestamp_ntz")
    row = suppliers.ingest_missing_products(raw, stamp).first()
    assert tuple(row) == (
        "D1", "12", "missing_products_20240101_010203.csv", dt.datetime(2024, 2, 1, 6)
    )


def test_depots_are_renamed(spark, tmp_path):
    write(
        tmp_path, "supplier_a_depot_masterdata_20240101_010203.csv",
        "cod_ministeriale;id_deposito_principale", " M1; D1 ",
    )
    found = suppliers.ingest_depots(suppliers.read_depots(spark, str(tmp_path)))
    assert found.columns[:2] == ["codice_ministeriale", "id_deposito"]
    assert tuple(found.first())[:2] == ("M1", "D1")


@pytest.mark.parametrize("fixed_layout", [True, False])
def test_swapped_header_fails(spark, tmp_path, fixed_layout):
    write(tmp_path, "a.csv", "x;y", *["1;2"] * 50)
    write(tmp_path, "b.csv", "y;x", "3;4")
    found = delimited.read_delimited(
        spark, f"{tmp_path}/*.csv", ["x", "y"], sep=";", fixed_layout=fixed_layout
    )
    with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE"):
        found.collect()


def test_file_names_are_decoded(spark, tmp_path):
    for name in ("a b_20240101.csv", "p+q r.csv", "100%.csv"):
        write(tmp_path, name, "x", "1")
    found = delimited.read_delimited(spark, f"{tmp_path}/*.csv", ["x"])
    assert {r.filename for r in found.collect()} == {"a b_20240101.csv", "p+q r.csv", "100%.csv"}


def test_ledger_lists_files_without_rows(spark, tmp_path):
    inbox, out, book = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    inbox.mkdir()
    write(inbox, "missing_products_1.csv", "id_deposito;minsan", "D1;1")
    write(inbox, "missing_products_2.csv", "id_deposito;minsan")
    write(inbox, "other.csv", "id_deposito;minsan", "D1;1")
    assert loads.load_missing_products(spark, str(inbox), out, book) == 1
    assert spark.read.parquet(book).count() == 2
    write(inbox, "missing_products_3.csv", "id_deposito;minsan", "D3;3")
    listing = delimited.list_files(spark, str(inbox), fixed.MISSING_PRODUCT_FILES)
    known = ledger.read_ledger(spark, book)
    assert [r.filename for r in ledger.new_files(listing, known).collect()] == [
        "missing_products_3.csv"
    ]
    assert loads.load_missing_products(spark, str(inbox), out, book) == 1


def test_no_folder_has_no_files(spark, tmp_path):
    assert loads.load_catalog(spark, str(tmp_path / "none"), str(tmp_path / "t"), str(tmp_path / "l")) == 0


def test_a_file_sent_again_under_its_name_is_loaded(spark, tmp_path):
    inbox, target, book = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "l")
    inbox.mkdir()
    row = "1,ring,a,b,c,d,e,F,adult,30"
    write(inbox, "product_masterdata.csv", CATALOG_HEADER, row)
    assert loads.load_catalog(spark, str(inbox), target, book) == 1
    write(inbox, "product_masterdata.csv", CATALOG_HEADER, row, row)
    assert loads.load_catalog(spark, str(inbox), target, book) == 2
    assert ledger.open_loaded(spark, target, book).count() == 3


def test_a_file_that_lands_during_a_load_comes_with_the_next(spark, tmp_path):
    inbox, target, book = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "l")
    inbox.mkdir()
    write(inbox, "missing_products_1.csv", "id_deposito;minsan", "D1;1")
    listing = delimited.list_files(spark, str(inbox), fixed.MISSING_PRODUCT_FILES)

    def read(paths):
        write(inbox, "missing_products_2.csv", "id_deposito;minsan", "D2;2")
        assert len(paths) == 1
        return suppliers.read_missing_product_files(spark, paths)

    assert ledger.load_new_files(listing, read, target, book) == 1
    assert loads.load_missing_products(spark, str(inbox), target, book) == 1
    found = ledger.open_loaded(spark, target, book)
    assert sorted(r.minsan for r in found.collect()) == ["1", "2"]


def test_a_load_cut_short_before_the_ledger_is_repeated(spark, tmp_path, monkeypatch):
    inbox, target, book = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "l")
    inbox.mkdir()
    write(inbox, "missing_products_1.csv", "id_deposito;minsan", "D1;1")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "append_rows", lost)
        with pytest.raises(RuntimeError):
            loads.load_missing_products(spark, str(inbox), target, book)
    with pytest.raises(FileNotFoundError):
        ledger.open_loaded(spark, target, book)
    assert loads.load_missing_products(spark, str(inbox), target, book) == 1
    assert ledger.open_loaded(spark, target, book).count() == 1
    assert spark.read.parquet(target).count() == 1


def test_old_files_are_not_read_again(spark, tmp_path):
    inbox, target, book = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "l")
    inbox.mkdir()
    asked = []

    def read(paths):
        asked.append([p.rsplit("/", 1)[1] for p in paths])
        return suppliers.read_missing_product_files(spark, paths)

    for n in (1, 2):
        write(inbox, f"missing_products_{n}.csv", "id_deposito;minsan", f"D;{n}")
        listing = delimited.list_files(spark, str(inbox), fixed.MISSING_PRODUCT_FILES)
        assert ledger.load_new_files(listing, read, target, book) == 1
    assert asked == [["missing_products_1.csv"], ["missing_products_2.csv"]]


def test_names_without_dates(spark):
    row = spark.range(1).select(
        names.name_date(F.lit("product_masterdata.csv")).alias("d"),
        names.name_date(F.lit("x_99999999.csv")).alias("bad"),
        names.name_stamp(F.lit("x_20240101.csv")).alias("s"),
    ).first()
    assert tuple(row) == (None, None, "")


SHIPMENT = {
    "header": {"transactionId": "T1", "documentDate": "2024-01-01"},
    "packages": [{"packageId": "K1", "isRfidActive": True}, {"packageId": None}],
}


def test_payload_files(spark, tmp_path):
    later = {"header": {"transactionId": "T1", "documentDate": "2024-01-02"}, "packages": []}
    bare = {"header": {"transactionId": "T2"}}
    lost = {"header": {"transactionId": None}, "packages": [{"packageId": "K1"}]}
    for name, payload in [
        ("a", {"items": [SHIPMENT, later]}), ("b", {"items": [bare, lost]}), ("c", {}),
        ("d", {"items": []}),
    ]:
        (tmp_path / f"{name}.json").write_text(json.dumps(payload, indent=1))
    records = bronze.read_payloads(spark, str(tmp_path), fixed.SHIPMENT_RECORD)
    master, details = shipments.flatten_shipments(records)
    found = {r.transaction_id: r.document_date for r in master.collect()}
    assert found == {"T1": "2024-01-02", "T2": None}
    assert [(r.transaction_id, r.package_id) for r in details.collect()] == [(None, "K1")]


def test_pallets_from_text(spark):
    text = json.dumps({
        "palletId": "L1", "status": "open",
        "packages": [{"packageId": "K1", "scannedAt": "a"}, {"packageId": "K1", "scannedAt": "b"}],
    })
    raw = spark.createDataFrame([(text,), (text.replace("L1", "L2"),)], "t string")
    records = raw.select(bronze.parse_records(F.col("t"), fixed.PALLET_RECORD).alias("r"))
    master, details = shipments.flatten_pallets(records.select("r.*"))
    assert sorted((r.pallet_id, r.pallet_status) for r in master.collect()) == [
        ("L1", "open"), ("L2", "open")
    ]
    assert sorted((r.pallet_id, r.package_id, r.scanned_at) for r in details.collect()) == [
        ("L1", "K1", "b"), ("L2", "K1", "b")
    ]


def test_bronze_window_prunes_folders(spark, tmp_path, plan_of):
    path = str(tmp_path / "bronze")
    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(12)]
    raw = spark.createDataFrame([(d, [(d.day,)]) for d in days] + [(days[0], [])],
                                "seen date, items array<struct<n int>>")
    bronze.archive_payloads(raw, "seen", path)
    assert (tmp_path / "bronze" / "year=2024" / "month=01" / "day=05").is_dir()
    recent = bronze.read_bronze(spark, path, "n int", days[-1])
    assert sorted(r.n for r in recent.collect()) == [6, 7, 8, 9, 10, 11, 12]
    scan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in scan or "PartitionFilters: [(make_date" in scan


TELEMETRY = "id string, date string, time string"


def test_delta_against_a_stored_target(spark, tmp_path):
    source = spark.createDataFrame(
        [("1", "2024-01-01", "1970-01-01 10:00:00"), ("2", "2024-01-01", "1970-01-01 10:00:01"),
         ("abc", "2024-01-02", "09:00:00"), ("4", None, "11:00:00")], TELEMETRY)
    path = str(tmp_path / "target")
    assert telemetry.load_telemetry(spark, source, str(tmp_path / "first")) == 4
    spark.createDataFrame([(1, "2024-01-01", "10:00:00")], "id long, date string, time string") \
        .write.parquet(path)
    assert telemetry.load_telemetry(spark, source, path) == 2
    files = sorted((tmp_path / "target").iterdir())
    assert telemetry.load_telemetry(spark, source, path) == 0
    assert sorted((tmp_path / "target").iterdir()) == files
    rows = spark.read.parquet(path).collect()
    assert sorted((r.id or 0, r.time) for r in rows) == [
        (0, "09:00:00"), (1, "10:00:00"), (2, "10:00:01")
    ]


def test_empty_target_loads_everything(spark):
    source = spark.createDataFrame([("4", None, "11:00:00")], TELEMETRY)
    target = source.where("false")
    assert incremental.incremental_delta(source, target).count() == 1


def test_watermark_date_reaches_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "source")
    spark.createDataFrame([("1", "2024-01-01", "10:00:00")], TELEMETRY).write.parquet(path)
    plan = plan_of(incremental.newer_than(spark.read.parquet(path), "2024-01-02 10:00:00"))
    assert "GreaterThanOrEqual(date,2024-01-02)" in plan


@pytest.mark.parametrize("mark", ["2024-01-01 10:00:00", "2024", "x y", " 5", ""])
def test_implied_date_filter_loses_nothing(spark, mark):
    values = ["2024", "2024-01", "2024-01-01", "2024-01-02", "", "x", "x y", " 5", "~"]
    rows = [(str(i), d, t) for i, (d, t) in enumerate(
        (d, t) for d in values for t in ("09:00:00", "10:00:00", "10:00:01"))]
    found = incremental.newer_than(spark.createDataFrame(rows, TELEMETRY), mark)
    assert {r.id for r in found.collect()} == {i for i, d, t in rows if f"{d} {t}" > mark}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_typed_delta(spark, kind):
    both = spark.sql(f"select cast(t as {kind}) event_ts from values "
                     "('2024-01-01 10:00:00.000001'), ('2024-01-01 10:00:00.000002') v(t)")
    old = both.where("event_ts < '2024-01-01 10:00:00.000002'")
    assert incremental.typed_delta(both, old).count() == 1
    assert incremental.typed_delta(both, old.where("false")).count() == 2


def test_clock_text(spark):
    row = spark.range(1).select(
        typing.clock_text(F.lit("1970-01-01 12:34:56.123")).alias("last_eight"),
        typing.clock_text(F.lit("1970-01-01 12:34:56.123"), tolerant=True).alias("clock"),
        typing.clock_text(F.lit("noon"), tolerant=True).alias("none"),
        typing.as_long(F.lit("abc")).alias("bad_id"),
    ).first()
    assert tuple(row) == ("4:56.123", "12:34:56", None, None)


def test_event_time(spark):
    rows = [("1", "2024-01-01", "1970-01-01 12:34:56.123"), ("2", "bad", "10:00:00"),
            ("3", None, "10:00:00")]
    found = incremental.with_event_time(spark.createDataFrame(rows, TELEMETRY)).collect()
    assert [r.event_ts for r in found] == [dt.datetime(2024, 1, 1, 12, 34, 56), None, None]


def test_split_types(spark):
    found = typing.split_types(spark.createDataFrame([("7",), ("x",), (None,)], "c string"), "c")
    assert found.columns == ["c_long", "c_string"]
    assert sorted(map(str, map(tuple, found.collect()))) == [
        "(7, None)", "(None, 'x')", "(None, None)"
    ]


def test_file_load_runs_once_per_file(spark, tmp_path):
    inbox, target, book = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "l")
    inbox.mkdir()
    row = "1,ring,a,b,c,d,e,F,adult,30"
    write(inbox, "20240305_product_masterdata.csv", CATALOG_HEADER, row)
    assert loads.load_catalog(spark, str(inbox), target, book) == 1
    write(inbox, "20240306_product_masterdata.csv", CATALOG_HEADER, row, row)
    write(inbox, "20240307_product_masterdata.csv", CATALOG_HEADER)
    assert loads.load_catalog(spark, str(inbox), target, book) == 2
    assert loads.load_catalog(spark, str(inbox), target, book) == 0
    assert spark.read.parquet(target).count() == 3
    assert spark.read.parquet(book).count() == 3


def test_supplier_loads(spark, tmp_path):
    write(tmp_path, "missing_products_20240101_010203.csv", "id_deposito;minsan", "D1;12")
    write(tmp_path, "supplier_a_depot_masterdata_20240101_010203.csv",
          "cod_ministeriale;id_deposito_principale", "M1;D1", "M2;D2")
    folder, out = str(tmp_path), str(tmp_path / "out")
    assert loads.load_missing_products(spark, folder, f"{out}/m", f"{out}/ml") == 1
    assert loads.load_depots(spark, folder, f"{out}/d", f"{out}/dl") == 2


def test_shipment_load(spark, tmp_path):
    day = dt.date(2024, 1, 5)
    for name, record, value in [
        ("s", fixed.SHIPMENT_RECORD, {"items": [SHIPMENT]}),
        ("p", fixed.PALLET_RECORD, {"items": [{"palletId": "L1", "packages": []}]}),
    ]:
        text = spark.createDataFrame([(json.dumps(value), day)], "t string, seen date")
        payload = text.select(F.from_json("t", bronze.envelope(record)).alias("p"), "seen")
        bronze.archive_payloads(payload.select("p.*", "seen"), "seen", str(tmp_path / name))
    done = loads.load_shipments(
        spark, str(tmp_path / "s"), str(tmp_path / "p"), str(tmp_path / "out"), day
    )
    assert {name: result.n_rows for name, result in done.items()} == {
        "shipments_master": 1, "shipments_details": 1, "pallets_master": 1, "pallets_details": 0
    }


def test_stored_mark_agrees_with_the_whole_scan(spark):
    for rows in (
        [("2024-01-01", "10:00:00"), ("2024-01-02", "01:00:00"), ("2024-01-02", None)],
        [("2024-01-01", "10:00:00"), ("2024-01-02", None)],
        [(None, "10:00:00")],
        [],
    ):
        frame = spark.createDataFrame(rows, "date string, time string")
        assert incremental.stored_mark(frame) == incremental.watermark(frame).first()[0]
