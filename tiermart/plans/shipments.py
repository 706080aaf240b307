"""Nested shipment and pallet records as flat master and detail tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.functions import fixed
from tiermart.operators.latest import latest_by_key, newest


def _flat(
    df: DataFrame, paths: Mapping[str, str], keys: Sequence[str], order: Sequence[Column] | None
) -> DataFrame:
    """``paths`` as columns, without NULLs in the last key and one row per key."""
    flat = df.select(*[F.col(path).alias(name) for name, path in paths.items()])
    known = flat.where(F.col(keys[-1]).isNotNull())
    rest = newest(*[name for name in paths if name not in keys])
    return latest_by_key(known, keys, [*(order or []), *rest])


def _packages(df: DataFrame) -> DataFrame:
    """One row per package; a record without packages gives none."""
    return df.withColumn("package", F.explode("packages")).drop("packages")


def flatten_shipments(
    records: DataFrame,
    master_order: Sequence[Column] | None = None,
    detail_order: Sequence[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One row per transaction and one row per package.

    Of several copies the first under the given order stays, then the greatest
    values of the remaining columns, so the result does not depend on the run.
    """
    master = _flat(records, fixed.SHIPMENT_MASTER, ["transaction_id"], master_order)
    packages = _packages(records)
    details = _flat(packages, fixed.SHIPMENT_DETAILS, ["package_id"], detail_order)
    return master, details


def flatten_pallets(
    records: DataFrame,
    master_order: Sequence[Column] | None = None,
    detail_order: Sequence[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One row per pallet and one row per package on a pallet."""
    master = _flat(records, fixed.PALLET_MASTER, ["pallet_id"], master_order)
    packages = _packages(records)
    keys = ["pallet_id", "package_id"]
    details = _flat(packages, fixed.PALLET_DETAILS, keys, detail_order)
    return master, details
