"""Runs of the file and record pipelines, from their inputs to stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession

from tiermart.functions import fixed
from tiermart.plans import catalog, shipments, suppliers
from tiermart.sinks.ledger import load_new_files
from tiermart.sinks.tables import Published, reload_staging, staging
from tiermart.sources.bronze import read_bronze
from tiermart.sources.delimited import list_files


def load_catalog(
    spark: SparkSession, folder: str, target: str, ledger: str, dedup: bool = False
) -> int:
    """Load new product catalogue files; returns the rows added."""
    return load_new_files(
        list_files(spark, folder, fixed.CATALOG_FILES),
        lambda paths: catalog.standardise_catalog(catalog.read_files(spark, paths), dedup),
        target, ledger,
    )


def load_missing_products(
    spark: SparkSession, folder: str, target: str, ledger: str, run_ts: Column | None = None
) -> int:
    return load_new_files(
        list_files(spark, folder, fixed.MISSING_PRODUCT_FILES),
        lambda paths: suppliers.ingest_missing_products(
            suppliers.read_missing_product_files(spark, paths), run_ts
        ),
        target, ledger,
    )


def load_depots(
    spark: SparkSession, folder: str, target: str, ledger: str, run_ts: Column | None = None
) -> int:
    return load_new_files(
        list_files(spark, folder, fixed.DEPOT_FILES),
        lambda paths: suppliers.ingest_depots(suppliers.read_depot_files(spark, paths), run_ts),
        target, ledger,
    )


def load_shipments(
    spark: SparkSession, shipment_path: str, pallet_path: str, root: str, as_of: dt.date
) -> dict[str, Published]:
    """Reload the four staging tables from the archived records of the last days.

    The records of the window are parsed once and stored; both tables of a feed come from there.
    """
    with staging(spark, "shipments") as folder:
        read_bronze(spark, shipment_path, fixed.SHIPMENT_RECORD, as_of).write.parquet(f"{folder}/s")
        read_bronze(spark, pallet_path, fixed.PALLET_RECORD, as_of).write.parquet(f"{folder}/p")
        sent, stacked = spark.read.parquet(f"{folder}/s"), spark.read.parquet(f"{folder}/p")
        shipment_master, shipment_details = shipments.flatten_shipments(sent)
        pallet_master, pallet_details = shipments.flatten_pallets(stacked)
        results = {
            "shipments_master": shipment_master,
            "shipments_details": shipment_details,
            "pallets_master": pallet_master,
            "pallets_details": pallet_details,
        }
        return {
            name: reload_staging(rows, root, f"{name}_staging") for name, rows in results.items()
        }
