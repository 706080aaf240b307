"""Values that results depend on: column names, labels, patterns and input schemas.

Everything in this module is a fixed value. Nothing here is computed.
"""

from __future__ import annotations

# File selection patterns and the date tokens inside file names.
CATALOG_FILES = "*product_masterdata.csv"
MISSING_PRODUCT_FILES = "missing_products_*.csv"
DEPOT_FILES = "supplier_a_depot_masterdata_*.csv"
NAME_STAMP = r"(\d{8}_\d{6})"
NAME_DATE = r"(\d{8})"
NAME_DATE_FORMAT = "yyyyMMdd"

# Product catalogue columns and their conformed names.
CATALOG_COLUMNS = [
    "product_id",
    "product_desc",
    "category_level_1",
    "category_level_2",
    "category_level_3",
    "category_level_4",
    "category_level_5",
    "gender",
    "target_user",
    "age_range",
]
CATALOG_NAMES = {
    "product_id": "ext_product_code",
    "product_desc": "ext_product_desc",
    "category_level_1": "ext_product_category1",
    "category_level_2": "ext_product_category2",
    "category_level_3": "ext_product_category3",
    "category_level_4": "ext_product_category4",
    "category_level_5": "ext_product_category5",
}

# Supplier file columns.
MISSING_PRODUCT_COLUMNS = ["id_deposito", "minsan"]
DEPOT_COLUMNS = ["cod_ministeriale", "id_deposito_principale"]
DEPOT_NAMES = {
    "cod_ministeriale": "codice_ministeriale",
    "id_deposito_principale": "id_deposito",
}

# Sales-line staging columns and their conformed names.
SALES_LINE_NAMES = {
    "src_branch": "branch_code",
    "src_hist_id": "history_prog_id",
    "src_order_id": "order_prog_id",
    "src_cust_id": "customer_code",
    "src_delivery_id": "delivery_note_id",
    "src_line_id": "order_line_id",
    "is_fulfilled": "is_fulfilled",
    "src_prod_id": "product_code",
    "src_prod_desc": "product_description",
    "uom": "unit_of_measure",
    "qty_requested": "requested_quantity",
    "qty_ordered": "ordered_quantity",
    "qty_ordered_cev": "ordered_quantity_cev",
    "qty_delivered": "delivered_quantity",
    "qty_delivered_cev": "delivered_quantity_cev",
    "selling_price": "selling_price",
    "retail_price": "public_retail_price",
    "vat_rate": "vat_rate",
    "discount_pct_line": "line_discount_pct",
    "discount_pct_cond1": "cond_discount_pct_1",
    "discount_pct_cond2": "cond_discount_pct_2",
    "discount_pct_cust": "client_discount_pct",
    "discount_pct_cust1": "client_discount_pct_1",
    "discount_pct_cust2": "client_discount_pct_2",
    "discount_pct_prod": "product_discount_pct",
    "product_type": "product_type",
    "warehouse_id": "warehouse_code",
    "product_status": "product_status_code",
    "qty_reversed": "reversed_quantity",
    "qty_reversed_cev": "reversed_quantity_cev",
    "container_ref": "container_reference",
    "record_timestamp": "record_timestamp",
}
ACTIVE_KEYS = [
    "src_branch",
    "src_cust_id",
    "src_order_id",
    "src_delivery_id",
    "src_line_id",
    "src_prod_id",
]
HISTORY_KEYS = [
    "src_branch",
    "src_cust_id",
    "src_hist_id",
    "src_order_id",
    "src_delivery_id",
    "src_line_id",
    "src_prod_id",
]

# Keys and thresholds of the shortage intervals.
SHORTAGE_KEYS = ["supplier_id", "facility_id", "product_code"]
SHORTAGE_GAP_HOURS = 13
SHORTAGE_LOOKBACK_DAYS = 7

# The days a late record may arrive after its date.
RELOAD_DAYS = 7

# Sales mart keys, channels in label order, and passed-through columns.
ORDER_KEYS = [
    "branch_code",
    "history_prog_id",
    "order_prog_id",
    "customer_code",
    "delivery_note_id",
]
CHANNEL_LABELS = {"b2b": "B2B", "push": "Push", "retail": "Retail", "other": "Other"}
CHANNEL_TOTALS = [
    "delivered_qty_push",
    "ordered_qty_push",
    "delivered_qty_retail",
    "ordered_qty_retail",
    "delivered_qty_b2b",
    "ordered_qty_b2b",
    "delivered_qty_other",
    "ordered_qty_other",
]
MART_PASS_THROUGH = [
    "branch_code",
    "history_prog_id",
    "order_prog_id",
    "customer_code",
    "delivery_note_id",
    "order_line_id",
    "order_type",
    "product_code",
    "product_description",
    "unit_of_measure",
    "product_type",
    "is_bulky_item",
    "container_count",
    "is_refrigerated",
    "shipping_line",
    "shipping_address",
    "container_reference",
    "order_date",
    "delivery_note_date",
    "delivery_date",
    "fulfillment_closed_timestamp",
    "is_fulfillment_generated",
    "is_fulfilled",
    "is_order_consolidated",
    "delivery_note_number",
    "requested_quantity",
    "ordered_quantity",
    "ordered_quantity_cev",
    "delivered_quantity",
    "delivered_quantity_cev",
    "reversed_quantity",
    "reversed_quantity_cev",
    "selling_price",
    "public_retail_price",
    "vat_rate",
    "line_discount_pct",
    "cond_discount_pct_1",
    "cond_discount_pct_2",
    "client_discount_pct",
    "client_discount_pct_1",
    "client_discount_pct_2",
    "product_discount_pct",
    "lines_to_fulfill",
    "lines_ordered",
    "record_timestamp",
]
MONTH_NAMES = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]

# Nested record schemas of the shipment and pallet feeds.
SHIPMENT_RECORD = """
    header struct<
        transactionId string, documentDate string, carrierName string,
        destinationName string, city string, district string,
        deliveryStatus string, expectedPackages bigint, receivedPackages bigint>,
    packages array<struct<
        packageId string, billingCode string, isRfidActive boolean,
        carrierOutcome string, deliveryTimestamp string>>
"""
PALLET_RECORD = """
    palletId string, palletCode string, status string, targetDate string,
    carrierName string, packagesCount bigint, createdBy string, createdAt string,
    packages array<struct<
        packageId string, transactionId string, packageNumber bigint,
        operatorId string, sortingLine string, gridPosition string,
        scannedAt string, hasAmbiguousMatch boolean>>
"""

# Where each flat column sits in the nested records.
SHIPMENT_MASTER = {
    "transaction_id": "header.transactionId",
    "document_date": "header.documentDate",
    "carrier_name": "header.carrierName",
    "destination_name": "header.destinationName",
    "city": "header.city",
    "district": "header.district",
    "delivery_status": "header.deliveryStatus",
    "expected_packages": "header.expectedPackages",
    "received_packages": "header.receivedPackages",
}
SHIPMENT_DETAILS = {
    "transaction_id": "header.transactionId",
    "package_id": "package.packageId",
    "billing_code": "package.billingCode",
    "is_rfid_active": "package.isRfidActive",
    "carrier_outcome": "package.carrierOutcome",
    "delivery_timestamp": "package.deliveryTimestamp",
}
PALLET_MASTER = {
    "pallet_id": "palletId",
    "pallet_code": "palletCode",
    "pallet_status": "status",
    "target_date": "targetDate",
    "carrier_name": "carrierName",
    "packages_count": "packagesCount",
    "created_by": "createdBy",
    "created_at": "createdAt",
}
PALLET_DETAILS = {
    "pallet_id": "palletId",
    "package_id": "package.packageId",
    "transaction_id_ref": "package.transactionId",
    "package_number": "package.packageNumber",
    "operator_id": "package.operatorId",
    "sorting_line": "package.sortingLine",
    "grid_position": "package.gridPosition",
    "scanned_at": "package.scannedAt",
    "has_ambiguous_match": "package.hasAmbiguousMatch",
}
