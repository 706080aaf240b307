"""Named queries, each over whole tables of one scale-factor folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import shapes
from tiermart.functions import fixed, names, sales, typing
from tiermart.operators import changes, intervals, overlaps
from tiermart.plans import catalog, loads, sales_lines, sales_mart, shipments, shortages, suppliers, telemetry
from tiermart.sinks import bucketed, ledger, mart, tables
from tiermart.sinks import sales_lines as stored_lines
from tiermart.sinks import shortages as stored_shortages
from tiermart.sources import bronze, incremental, variants
from tiermart.streaming import flows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Catalogue and supplier files


@query
def q01_catalog_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.conform_names(shapes.catalog_rows(spark, sf_dir))


@query
def q02_file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = shapes.file_uris(spark, sf_dir)
    named = files.select("event_id", names.file_name(F.col("uri")).alias("filename"))
    return named.withColumn("file_datetime", names.name_stamp(F.col("filename")))


@query
def q03_file_record_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    standard = catalog.standardise_catalog(shapes.catalog_rows(spark, sf_dir))
    return standard.withColumn("record_date", F.col("record_date").cast("timestamp_ntz"))


@query
def q04_missing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shapes.missing_products(spark, sf_dir)
    return suppliers.ingest_missing_products(rows, shapes.run_ts())


@query
def q35_file_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as supplier files in two deliveries, each loaded; the third load finds nothing."""
    root = tables.shared_folder(spark, "deliveries")
    rows = shapes.missing_products(spark, sf_dir)
    later = F.substring("filename", 18, 8) >= "20240115"
    for name, part in (("missing_products_1", rows.where(~later)), ("missing_products_2", rows.where(later))):
        lines = part.select(*fixed.MISSING_PRODUCT_COLUMNS)
        tables.write_named_files(lines, f"{root}/in", name, header="true", sep=";", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        loads.load_missing_products(spark, f"{root}/in", f"{root}/rows", f"{root}/ledger", shapes.run_ts())
    loads.load_missing_products(spark, f"{root}/in", f"{root}/rows", f"{root}/ledger", shapes.run_ts())
    loaded = ledger.open_loaded(spark, f"{root}/rows", f"{root}/ledger")
    files = F.regexp_extract("filename", r"^(missing_products_\d)_\d+\.csv$", 1)
    return loaded.select("id_deposito", "minsan", files.alias("delivery"), F.col("load_run").cast("int").alias("load_run"), "record_timestamp")


PLAIN_CSV = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@query
def q36_catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as comma-separated catalogue files with one column too many, loaded by name of column."""
    root = tables.shared_folder(spark, "catalogue")
    rows = shapes.catalog_rows(spark, sf_dir).withColumn("target_user", F.lit('adult, "plain"'))
    names = [*reversed(fixed.CATALOG_COLUMNS), "unused"]
    tables.write_named_files(rows.withColumn("unused", F.lit("x")).select(*names), f"{root}/in", "20240105_product_masterdata", suffix="_product_masterdata.csv", sep=",", **PLAIN_CSV)
    loads.load_catalog(spark, f"{root}/in", f"{root}/rows", f"{root}/ledger")
    loaded = ledger.open_loaded(spark, f"{root}/rows", f"{root}/ledger").drop("load_run")
    return loaded.withColumn("record_date", F.col("record_date").cast("timestamp_ntz"))


@query
def q37_depot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as depot files of a fixed layout, renamed and trimmed."""
    root = tables.shared_folder(spark, "depots")
    rows = shapes.depot_rows(spark, sf_dir)
    tables.write_named_files(rows.select(*fixed.DEPOT_COLUMNS), f"{root}/in", "supplier_a_depot_masterdata", sep=";", **PLAIN_CSV)
    loads.load_depots(spark, f"{root}/in", f"{root}/rows", f"{root}/ledger", shapes.run_ts())
    return ledger.open_loaded(spark, f"{root}/rows", f"{root}/ledger").select(*fixed.DEPOT_NAMES.values(), "record_timestamp")


# Nested records


@query
def q38_drifting_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text whose fields come, go and change their type, as typed columns; unreadable text is kept apart."""
    records, unreadable = variants.parsed(shapes.drifting_json(spark, sf_dir), "text")
    flat = variants.split_variants(variants.flat_records(records.drop("text")))
    apart = unreadable.select("event_id", F.col("text").alias("unreadable"))
    return flat.unionByName(apart, allowMissingColumns=True).select(
        "event_id", "id", F.col("seen.n").alias("seen_n"), F.col("seen.page").alias("seen_page"),
        "size_bigint", "size_object_h_string", "size_object_w_bigint", "size_string", "unreadable",
    )


@query
def q39_observed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' properties with numbers, decimals and text in one field: a column for each."""
    records, _ = variants.parsed(shapes.mixed_props(spark, sf_dir), "props")
    flat = variants.split_variants(variants.flat_records(records.drop("props")))
    return flat.withColumn("k_decimal", F.col("k_decimal").cast("double"))


@query
def q05_shipments_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments.flatten_shipments(shapes.shipment_records(spark, sf_dir))[0]


@query
def q06_shipments_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments.flatten_shipments(shapes.shipment_records(spark, sf_dir))[1]


def _pallets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return shipments.flatten_pallets(
        shapes.pallet_records(spark, sf_dir),
        master_order=[F.col("target_date").desc_nulls_first()],
        detail_order=[
            F.col("scanned_at").desc_nulls_first(),
            F.col("operator_id").desc_nulls_first(),
        ],
    )


@query
def q07_pallets_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pallets(spark, sf_dir)[0]


@query
def q08_pallets_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pallets(spark, sf_dir)[1]


@query
def q09_rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all payloads as JSON by day, then read the seven days back."""
    root = tables.shared_folder(spark, "bronze")
    payloads = shapes.event_payloads(spark, sf_dir)
    bronze.archive_payloads(payloads.select("items", "ts"), "ts", root)
    return bronze.read_bronze(spark, root, shapes.EVENT_RECORD, shapes.BRONZE_AS_OF)


# Telemetry


@query
def q10_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.watermark(shapes.loaded_telemetry(spark, sf_dir))


@query
def q11_incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.incremental_delta(
        shapes.telemetry(spark, sf_dir), shapes.loaded_telemetry(spark, sf_dir)
    )


@query
def q12_time_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = incremental.normalise_time(shapes.telemetry(spark, sf_dir))
    return incremental.with_event_time(normal)


@query
def q40_marked_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load without some rows, then all rows: late ones and those equal to the mark come in, known ones do not."""
    root = tables.shared_folder(spark, "marked")
    reads = shapes.telemetry(spark, sf_dir)
    number = F.col("id").cast("bigint")
    first = reads.where((F.col("date") < "2024-01-20") & (number % 17 != 0))
    for source in (first, reads, reads):
        telemetry.load_with_mark(spark, source, root, overlap=dt.timedelta(days=60))
    loaded = telemetry.open_loads(spark, root)
    return loaded.withColumn("load_run", F.col("load_run").cast("int"))


# Sales lines


@query
def q13_active_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.active_lines(spark, sf_dir)


@query
def q14_history_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.history_lines(spark, sf_dir)


@query
def q15_active_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.swap_active(
        shapes.prior_lines(spark, sf_dir), shapes.active_lines(spark, sf_dir)
    )


@query
def q16_history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.append_missing(
        shapes.prior_lines(spark, sf_dir),
        shapes.history_lines(spark, sf_dir),
        sales_lines.TARGET_KEYS,
    )


@query
def q17_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines.upsert_sales_lines(
        shapes.prior_lines(spark, sf_dir),
        shapes.active_lines(spark, sf_dir),
        shapes.history_lines(spark, sf_dir),
    )


@query
def q41_stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on the stored, bucketed lines; the runs are merged between them and old folders dropped."""
    root = tables.shared_folder(spark, "lines")
    # All feeds come from one, so its rows are gathered by order once.
    by_order = bucketed.Layout(("src_order_id",), ("src_order_id", "src_line_id"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    feed, ties = bucketed.stage(shapes.sales_feed(spark, sf_dir), by_order), shapes.tie_breaks()
    stored_lines.create_lines(sales_lines.history_lines(shapes.prior_feed(feed), ties), root, by=["order_prog_id"])
    active = stored_lines.stage_lines(sales_lines.active_lines(feed, ties), root)
    history = stored_lines.stage_lines(sales_lines.history_lines(shapes.past_feed(feed), ties), root)
    stored_lines.run_upsert(active, history, root, staged=True)
    stored_lines.merge_runs(spark, root)
    stored_lines.drop_merged_runs(spark, root)
    stored_lines.run_upsert(active, history, root, staged=True)
    return stored_lines.open_lines(spark, root)


# Shortage intervals


def _island_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = shortages.known_facilities(shapes.snapshots(spark, sf_dir))
    return intervals.island_rows(known, shortages.KEYS, "snapshot_timestamp", shortages.GAP)


@query
def q18_gap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _island_rows(spark, sf_dir).drop("period_group_id")


@query
def q19_island_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _island_rows(spark, sf_dir).drop("previous_timestamp")


@query
def q20_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortages.shortage_periods(shapes.snapshots(spark, sf_dir))


@query
def q21_open_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortages.open_baseline(
        shapes.shortage_history(spark, sf_dir), shapes.SHORTAGES_AS_OF
    )


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortages.match_baseline(
        shapes.shortage_news(spark, sf_dir), q21_open_baseline(spark, sf_dir)
    )


@query
def q22_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortages.find_extensions(_matched(spark, sf_dir))


@query
def q23_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortages.find_inserts(
        _matched(spark, sf_dir), shapes.shortage_history(spark, sf_dir)
    )


@query
def q24_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortages.consolidate(
        shapes.shortage_history(spark, sf_dir),
        shapes.shortage_news(spark, sf_dir),
        shapes.SHORTAGES_AS_OF,
        stage=tables.stage_once,
    )


@query
def q42_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New periods with every stored interval of their key that lies within the gap."""
    return overlaps.overlapping(
        shapes.shortage_news(spark, sf_dir), shapes.shortage_history(spark, sf_dir), shortages.KEYS, tolerance=shortages.GAP
    )


# Sales mart


@query
def q25_channel_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_mart.channel_totals(shapes.channel_rows(spark, sf_dir))


def _with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_mart.with_channel_totals(
        shapes.mart_orders(spark, sf_dir), shapes.channel_rows(spark, sf_dir)
    )


@query
def q26_channel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*fixed.ORDER_KEYS, "order_channel", *fixed.CHANNEL_TOTALS]
    return _with_totals(spark, sf_dir).select(*columns)


@query
def q27_order_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = sales_mart.channel_of_order().alias("order_channel")
    return _with_totals(spark, sf_dir).select("order_prog_id", label)


@query
def q28_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [column.alias(name) for name, column in sales.surrogate_keys().items()]
    return shapes.mart_orders(spark, sf_dir).select("order_prog_id", *keys)


@query
def q29_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = sales.calendar_columns("delivery_note_date")
    orders = shapes.mart_orders(spark, sf_dir).select("order_prog_id", "delivery_note_date")
    return orders.withColumns(parts)


@query
def q30_sales_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_mart.sales_orders_extended(
        shapes.mart_orders(spark, sf_dir),
        shapes.channel_rows(spark, sf_dir),
        shapes.MART_AS_OF,
    )


@query
def q43_refreshed_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that lacks some channel rows, has others twice and is a month old, refreshed from the changes."""
    root = tables.shared_folder(spark, "mart")
    orders, channels = shapes.mart_orders(spark, sf_dir), shapes.channel_rows(spark, sf_dir)
    number = F.substring("order_prog_id", 2, 20).cast("bigint") % 10
    missing, twice = channels.where(number == 3), channels.where(number == 4)
    mart.create_mart(orders, channels.where(number != 3).unionByName(twice), shapes.MART_AS_OF - dt.timedelta(days=31), root)
    changed = missing.withColumn(mart.SIGN, F.lit(1)).unionByName(twice.withColumn(mart.SIGN, F.lit(-1)))
    mart.refresh_mart(orders, changed, shapes.MART_AS_OF, root)
    return mart.open_mart(spark, root).drop(mart.MONTH)


# Table writes


@query
def q31_staging_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all shipments, reload the finished ones, then try an empty reload."""
    root = tables.shared_folder(spark, "staging")
    master = q05_shipments_master(spark, sf_dir)
    tables.reload_staging(master, root, "shipments_master_staging")
    finished = master.where("delivery_status = 'F'")
    tables.reload_staging(finished, root, "shipments_master_staging")
    nothing = master.where("delivery_status = 'none'")
    tables.reload_staging(nothing, root, "shipments_master_staging")
    return tables.open_table(spark, root, "shipments_master_staging")


@query
def q32_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all events against a ledger of those before 2024-01-15."""
    files = q02_file_metadata(spark, sf_dir)
    done = files.where(F.substring("file_datetime", 1, 8).between("20240101", "20240114"))
    return ledger.new_files(files, done)


@query
def q33_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines.upsert_audit(
        shapes.prior_keys(spark, sf_dir),
        shapes.active_lines(spark, sf_dir),
        shapes.history_keys(spark, sf_dir),
    )


@query
def q34_split_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value that is a number in most events and text in errors."""
    number = F.get_json_object("props", "$.k")
    mixed = shapes.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(number).alias("k")
    )
    return typing.split_types(mixed, "k")


# Streaming


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pattern matches ``events.parquet`` as one file and as a folder."""
    schema = shapes.table(spark, sf_dir, "events").schema
    events = flows.stream_files(spark, f"{sf_dir}/events.parquet*", schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def s01_delta_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two availableNow runs; the second finds nothing new."""
    root = tables.shared_folder(spark, "delta")
    for _ in range(2):
        events = _event_stream(spark, sf_dir)
        reads = events.select(
            F.col("event_id").cast("string").alias("id"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.concat(F.lit("1970-01-01 "), F.date_format("ts", "HH:mm:ss")).alias("time"),
        )
        normal = incremental.normalise_time(reads)
        flows.append_available(normal, f"{root}/rows", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@query
def s02_late_reload_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = tables.shared_folder(spark, "reload")
    reads = _event_stream(spark, sf_dir).select(
        "ts", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("date")
    )
    kept = flows.drop_late_copies(reads, ["user_id", "date"], "ts").drop("ts")
    flows.append_available(kept, f"{root}/rows", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@query
def s03_shortage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = tables.shared_folder(spark, "periods")
    user = F.col("user_id")
    seen = _event_stream(spark, sf_dir).select(
        (user % 10).alias("supplier_id"),
        F.concat(F.lit("F"), user % 3).alias("facility_id"),
        user.cast("string").alias("product_code"),
        F.col("ts").alias("snapshot_timestamp"),
    )
    periods = flows.stream_periods(seen, shortages.KEYS, "snapshot_timestamp")
    flows.replace_available(periods, root, "periods", f"{root}/state").awaitTermination()
    stored = tables.open_table(spark, root, "periods")
    return stored.select(
        *shortages.KEYS,
        F.col("start_date").cast("timestamp_ntz").alias("start_date"),
        F.col("end_date").cast("timestamp_ntz").alias("end_date"),
    )


@query
def s04_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late reload by stored batches instead of state."""
    root = tables.shared_folder(spark, "copies")
    reads = _event_stream(spark, sf_dir).select("ts", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("date"))
    for _ in range(2):
        flows.append_first_copies(reads, ["user_id", "date"], "ts", f"{root}/rows", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/rows").select("user_id", "date")


@query
def s05_shortage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late snapshots consolidated into the stored history by a stream that is run twice."""
    root = tables.shared_folder(spark, "runs")
    stored_shortages.create_history(shapes.shortage_history(spark, sf_dir), root)
    user = F.col("user_id")
    seen = _event_stream(spark, sf_dir).where("ts >= '2024-01-24'").select(
        (user % 10).alias("supplier_id"),
        F.concat(F.lit("F"), user % 3).alias("facility_id"),
        user.cast("string").alias("product_code"),
        F.col("ts").cast("timestamp_ntz").alias("snapshot_timestamp"),
    )
    for _ in range(2):
        stored_shortages.consolidate_stream(seen, root, f"{root}/state", shapes.SHORTAGES_AS_OF).awaitTermination()
    return stored_shortages.open_history(spark, root).drop(stored_shortages.MONTH)
