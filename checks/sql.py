"""DuckDB SQL for the named queries, written against the given tables.

The SQL takes the plain route: whole-key windows and EXISTS tests, without the
slicing and pre-aggregation of the Spark operators.
"""

from __future__ import annotations

from tiermart.functions import fixed

ORACLES: dict[str, str] = {}


def _with(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


def _columns(names) -> str:
    return ", ".join(names)


# Catalogue and supplier files

_CATALOG = """catalog AS (
    SELECT CAST(p_partkey AS VARCHAR) AS ext_product_code,
           p_name AS ext_product_desc,
           p_type AS ext_product_category1,
           p_brand AS ext_product_category2,
           string_split(p_name, ' ')[1] AS ext_product_category3,
           string_split(p_name, ' ')[2] AS ext_product_category4,
           CAST(NULL AS VARCHAR) AS ext_product_category5,
           CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           'adult' AS target_user,
           CAST(p_size AS VARCHAR) AS age_range,
           CASE WHEN p_partkey % 10 <> 0
                THEN DATE '2024-01-01' + CAST(p_partkey % 60 AS INTEGER) END AS file_date
    FROM part)"""

ORACLES["q01_catalog_rename"] = _with(
    _CATALOG,
    select="""SELECT * EXCLUDE (file_date),
        coalesce(strftime(file_date, '%Y%m%d_'), '') || 'product_masterdata.csv' AS filename
        FROM catalog""",
)
ORACLES["q03_file_record_date"] = _with(
    _CATALOG,
    select="""SELECT * EXCLUDE (file_date), CAST(file_date AS TIMESTAMP) AS record_date
        FROM catalog""",
)

_FILES = """files AS (
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y%m%d_%H%M%S') END
               AS file_datetime,
           CASE WHEN event_type = 'error' THEN 'no+stamp here.csv'
                ELSE 'missing products_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' END
               AS filename
    FROM events)"""

ORACLES["q02_file_metadata"] = _with(_FILES, select="SELECT * FROM files")
ORACLES["q32_file_ledger"] = _with(
    _FILES,
    select="""SELECT filename FROM files
        EXCEPT
        SELECT filename FROM files
        WHERE left(file_datetime, 8) BETWEEN '20240101' AND '20240114'""",
)
ORACLES["q04_missing_products"] = """
    SELECT 'D' || user_id AS id_deposito,
           lpad(CAST(event_id AS VARCHAR), 9, '0') AS minsan,
           'missing_products_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS filename,
           TIMESTAMP '2024-02-01 06:00:00' AS record_timestamp
    FROM events"""

ORACLES["q35_file_deliveries"] = """
    SELECT 'D' || user_id AS id_deposito,
           lpad(CAST(event_id AS VARCHAR), 9, '0') AS minsan,
           CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'missing_products_1' ELSE 'missing_products_2' END AS delivery,
           CAST(CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS INTEGER) AS load_run,
           TIMESTAMP '2024-02-01 06:00:00' AS record_timestamp
    FROM events"""

ORACLES["q36_catalog_files"] = _with(
    _CATALOG,
    select="""SELECT * EXCLUDE (file_date) REPLACE ('adult, "plain"' AS target_user),
        TIMESTAMP '2024-01-05' AS record_date
        FROM catalog""",
)
ORACLES["q37_depot_files"] = """
    SELECT 'M' || s_suppkey AS codice_ministeriale, 'D' || s_nationkey AS id_deposito,
           TIMESTAMP '2024-02-01 06:00:00' AS record_timestamp
    FROM supplier"""

# Nested records

ORACLES["q38_drifting_records"] = """
    SELECT event_id,
           CASE WHEN event_type <> 'error' THEN event_id END AS id,
           CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN user_id % 7 END AS seen_n,
           CASE WHEN event_type = 'view' THEN 'p' || (user_id % 3)
                WHEN event_type NOT IN ('click', 'purchase', 'error') THEN 's' END AS seen_page,
           CASE WHEN event_type = 'click' THEN user_id END AS size_bigint,
           CASE WHEN event_type = 'purchase' THEN 'tall' END AS size_object_h_string,
           CASE WHEN event_type = 'purchase' THEN user_id % 10 END AS size_object_w_bigint,
           CASE WHEN event_type = 'view' THEN user_id || 'px' END AS size_string,
           CASE WHEN event_type = 'error' THEN '{"id": ' || event_id || ', "si' END AS unreadable
    FROM events"""
ORACLES["q39_observed_types"] = """
    SELECT event_id,
           CASE WHEN event_type NOT IN ('error', 'purchase') THEN CAST(k AS BIGINT) END AS k_bigint,
           CASE WHEN event_type = 'purchase' THEN CAST(k || '.25' AS DOUBLE) END AS k_decimal,
           CASE WHEN event_type = 'error' THEN 'n' || k END AS k_string
    FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)"""

_PACKAGES = """packages AS (
    SELECT l_orderkey || '-' || l_linenumber AS package_id,
           CAST(l_orderkey AS VARCHAR) AS order_text,
           lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS part_text,
           lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS supplier_text,
           strftime(l_shipdate, '%Y-%m-%d') AS ship_text, lineitem.*
    FROM lineitem)"""

_SHIPMENTS_MASTER = """
    SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
           strftime(CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 1 DAY
                         ELSE o_orderdate END, '%Y-%m-%d') AS document_date,
           'C' || (o_custkey % 7) AS carrier_name,
           'cust ' || o_custkey AS destination_name,
           o_orderpriority AS city,
           CAST(NULL AS VARCHAR) AS district,
           CASE WHEN o_orderkey % 10 = 0 THEN 'R' ELSE o_orderstatus END AS delivery_status,
           o_custkey % 5 AS expected_packages,
           o_custkey % 3 AS received_packages
    FROM orders"""

ORACLES["q05_shipments_master"] = _SHIPMENTS_MASTER
ORACLES["q31_staging_reload"] = (
    f"SELECT * FROM ({_SHIPMENTS_MASTER}) WHERE delivery_status = 'F'"
)
ORACLES["q06_shipments_details"] = _with(
    _PACKAGES,
    select="""SELECT order_text AS transaction_id, package_id,
               part_text || '/' || supplier_text AS billing_code,
               l_linestatus = 'F' AS is_rfid_active,
               l_returnflag AS carrier_outcome, ship_text AS delivery_timestamp
        FROM packages
        QUALIFY 1 = row_number() OVER (
            PARTITION BY package_id
            ORDER BY billing_code DESC, is_rfid_active DESC, carrier_outcome DESC,
                     delivery_timestamp DESC)""",
)
ORACLES["q07_pallets_master"] = """
    SELECT CAST(l_suppkey AS VARCHAR) AS pallet_id, 'PAL' || l_suppkey AS pallet_code,
           max_by(l_linestatus, strftime(l_shipdate, '%Y%m%d') || l_linestatus) AS pallet_status,
           strftime(max(l_shipdate), '%Y-%m-%d') AS target_date,
           'C' || (l_suppkey % 7) AS carrier_name, l_suppkey % 11 AS packages_count,
           'dock' AS created_by, CAST(NULL AS VARCHAR) AS created_at
    FROM lineitem GROUP BY l_suppkey"""
ORACLES["q08_pallets_details"] = _with(
    _PACKAGES,
    select="""SELECT CAST(l_suppkey AS VARCHAR) AS pallet_id, package_id,
               order_text AS transaction_id_ref, CAST(l_linenumber AS BIGINT) AS package_number,
               part_text AS operator_id, l_returnflag AS sorting_line,
               l_linestatus AS grid_position, ship_text AS scanned_at,
               l_discount > 0.05 AS has_ambiguous_match
        FROM packages
        QUALIFY 1 = row_number() OVER (
            PARTITION BY l_suppkey, package_id
            ORDER BY scanned_at DESC, operator_id DESC, sorting_line DESC,
                     grid_position DESC, has_ambiguous_match DESC)""",
)
ORACLES["q09_rolling_window"] = """
    SELECT event_id, unnest([event_type, 'again']) AS event_type,
           strftime(ts, '%H:%M:%S') AS seen_at
    FROM events
    WHERE event_type <> 'signup'
      AND ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31'"""

# Telemetry

_LOADED = """loaded AS (
    SELECT max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS max_timestamp
    FROM events WHERE ts < TIMESTAMP '2024-01-20')"""

ORACLES["q10_watermark"] = _with(_LOADED, select="SELECT max_timestamp FROM loaded")
ORACLES["q11_incremental_delta"] = _with(
    _LOADED,
    select="""SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS "date",
               strftime(ts, '%H:%M:%S') AS "time", event_type
        FROM events, loaded
        WHERE strftime(ts, '%Y-%m-%d %H:%M:%S') > max_timestamp""",
)
ORACLES["q12_time_normalise"] = """
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS "date",
           strftime(ts, '%H:%M:%S') AS "time", event_type,
           date_trunc('second', ts) AS event_ts
    FROM events"""
ORACLES["q40_marked_loads"] = """
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS "date",
           strftime(ts, '%H:%M:%S') AS "time", event_type,
           CAST(CASE WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 17 <> 0 THEN 1 ELSE 2 END AS INTEGER) AS load_run
    FROM events"""
ORACLES["s01_delta_stream"] = """
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS "date",
           strftime(ts, '%H:%M:%S') AS "time"
    FROM events"""
ORACLES["s02_late_reload_stream"] = """
    SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS "date" FROM events"""
ORACLES["s04_first_copies"] = ORACLES["s02_late_reload_stream"]

# Sales lines

_FEED = """feed AS (
    SELECT 'B' || (o_custkey % 10) AS branch_code,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS history_prog_id,
           'O' || l_orderkey AS order_prog_id,
           CAST(o_custkey AS VARCHAR) AS customer_code,
           'D' || l_orderkey AS delivery_note_id,
           l_linenumber AS order_line_id,
           l_linestatus = 'F' AS is_fulfilled,
           'P' || (l_partkey % 5) AS product_code,
           'item ' || (l_partkey % 5) AS product_description,
           'PZ' AS unit_of_measure,
           l_quantity AS requested_quantity,
           l_quantity AS ordered_quantity,
           l_quantity * 2 AS ordered_quantity_cev,
           CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE CAST(0 AS DOUBLE) END
               AS delivered_quantity,
           CASE WHEN l_linestatus = 'F' THEN l_quantity * 2 ELSE CAST(0 AS DOUBLE) END
               AS delivered_quantity_cev,
           l_extendedprice AS selling_price,
           o_totalprice AS public_retail_price,
           l_tax AS vat_rate,
           l_discount AS line_discount_pct,
           CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN l_discount END
               AS cond_discount_pct_1,
           CAST(0 AS DOUBLE) AS cond_discount_pct_2,
           l_tax AS client_discount_pct,
           CAST(0 AS DOUBLE) AS client_discount_pct_1,
           CAST(0 AS DOUBLE) AS client_discount_pct_2,
           l_discount AS product_discount_pct,
           l_returnflag AS product_type,
           'W' || (l_suppkey % 10) AS warehouse_code,
           l_linestatus AS product_status_code,
           CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE CAST(0 AS DOUBLE) END
               AS reversed_quantity,
           CASE WHEN l_returnflag = 'R' THEN l_quantity * 2 ELSE CAST(0 AS DOUBLE) END
               AS reversed_quantity_cev,
           CASE l_suppkey % 3 WHEN 1 THEN 'box' || l_suppkey
                              WHEN 2 THEN 'Box' || l_suppkey END AS container_reference,
           l_shipdate AS record_timestamp,
           l_partkey, l_suppkey
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""

# Keys are written out here, so that a wrong one in the plans shows.
_ACTIVE_KEYS = (
    "branch_code, customer_code, order_prog_id, delivery_note_id, order_line_id, product_code"
)
_HISTORY_KEYS = (
    "branch_code, customer_code, history_prog_id, order_prog_id, delivery_note_id, order_line_id, product_code"
)


def _newest_lines(name: str, keys: str, condition: str = "TRUE") -> str:
    return f"""{name} AS (
        SELECT * EXCLUDE (l_partkey, l_suppkey) FROM feed WHERE {condition}
        QUALIFY 1 = row_number() OVER (
            PARTITION BY {keys}
            ORDER BY record_timestamp DESC NULLS FIRST, l_partkey DESC, l_suppkey DESC))"""


_ACTIVE = _newest_lines("active", _ACTIVE_KEYS)
_HISTORY = _newest_lines("history", _HISTORY_KEYS, "history_prog_id = 1")
_PRIOR = _newest_lines("prior", _HISTORY_KEYS, "record_timestamp < TIMESTAMP '1998-01-01'")
_SWAPPED = """swapped AS (
    SELECT * FROM prior WHERE history_prog_id <> 0
    UNION ALL SELECT * FROM active)"""


def _unseen(target: str) -> str:
    same = " AND ".join(
        f"t.{key} = h.{key}" for key in _HISTORY_KEYS.split(", ")
    )
    return f"""unseen AS (
        SELECT * FROM history h
        WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {same}))"""


_ALL_LINES = (_FEED, _ACTIVE, _HISTORY, _PRIOR, _SWAPPED)

ORACLES["q13_active_dedup"] = _with(_FEED, _ACTIVE, select="SELECT * FROM active")
ORACLES["q14_history_dedup"] = _with(_FEED, _HISTORY, select="SELECT * FROM history")
ORACLES["q15_active_swap"] = _with(
    _FEED, _ACTIVE, _PRIOR, _SWAPPED, select="SELECT * FROM swapped"
)
ORACLES["q16_history_append"] = _with(
    _FEED,
    _HISTORY,
    _PRIOR,
    _unseen("prior"),
    select="SELECT * FROM prior UNION ALL SELECT * FROM unseen",
)
ORACLES["q17_upsert"] = _with(
    *_ALL_LINES,
    _unseen("swapped"),
    select="SELECT * FROM swapped UNION ALL SELECT * FROM unseen",
)
ORACLES["q33_audit_counts"] = _with(
    *_ALL_LINES,
    _unseen("swapped"),
    select="""SELECT 'active_deleted' AS step, count(*) AS n_rows
        FROM prior WHERE history_prog_id = 0
        UNION ALL SELECT 'active_inserted', count(*) FROM active
        UNION ALL SELECT 'history_inserted', count(*) FROM unseen
        UNION ALL SELECT 'active_with_history_id', count(*)
        FROM active WHERE history_prog_id <> 0""",
)

# The second run adds the active lines that have a history id once more, and nothing else.
ORACLES["q41_stored_upsert"] = _with(
    *_ALL_LINES,
    _unseen("swapped"),
    select="""SELECT * FROM swapped UNION ALL SELECT * FROM unseen
        UNION ALL SELECT * FROM active WHERE history_prog_id <> 0""",
)

# Shortage intervals

_KEYS = "supplier_id, facility_id, product_code"


def _periods(prefix: str, condition: str = "TRUE") -> tuple[str, str, str]:
    return (
        f"""{prefix}_gaps AS (
            SELECT {_KEYS}, snapshot_timestamp,
                   lag(snapshot_timestamp) OVER w AS previous_timestamp,
                   CASE WHEN snapshot_timestamp - previous_timestamp <= INTERVAL 13 HOUR
                        THEN 0 ELSE 1 END AS is_new_period_start
            FROM (SELECT user_id % 10 AS supplier_id, 'F' || (user_id % 3) AS facility_id,
                         CAST(user_id AS VARCHAR) AS product_code, ts AS snapshot_timestamp
                  FROM events WHERE {condition})
            WINDOW w AS (PARTITION BY {_KEYS} ORDER BY snapshot_timestamp))""",
        f"""{prefix}_ids AS (
            SELECT *, CAST(sum(is_new_period_start) OVER (
                PARTITION BY {_KEYS} ORDER BY snapshot_timestamp
                ROWS UNBOUNDED PRECEDING) AS BIGINT) AS period_group_id
            FROM {prefix}_gaps)""",
        f"""{prefix} AS (
            SELECT {_KEYS}, min(snapshot_timestamp) AS start_date,
                   max(snapshot_timestamp) AS end_date
            FROM {prefix}_ids GROUP BY {_KEYS}, period_group_id)""",
    )


_SEEN = _periods("seen")
_PAST = _periods("past", "ts < TIMESTAMP '2024-01-25'")
_NEWS = _periods("news", "ts >= TIMESTAMP '2024-01-24'")
_BASELINE = f"""baseline AS (
    SELECT {_KEYS}, max_by(start_date, end_date) AS start_date, max(end_date) AS end_date
    FROM past WHERE end_date >= TIMESTAMP '2024-01-24' GROUP BY {_KEYS})"""
_EXTENDED = f"""extended AS (
    SELECT {_KEYS}, b.start_date AS history_start_date, n.end_date AS new_end_date
    FROM (SELECT {_KEYS}, min(start_date) AS start_date,
                 min_by(end_date, start_date) AS end_date
          FROM news GROUP BY {_KEYS}) n
    JOIN baseline b USING ({_KEYS})
    WHERE b.end_date + INTERVAL 13 HOUR >= n.start_date AND b.start_date <= n.end_date)"""
_ADDED = f"""added AS (
    SELECT n.* FROM news n
    ANTI JOIN extended e ON (n.supplier_id, n.facility_id, n.product_code, n.end_date)
        = (e.supplier_id, e.facility_id, e.product_code, e.new_end_date)
    WHERE NOT EXISTS (
        SELECT 1 FROM past p
        WHERE p.supplier_id = n.supplier_id AND p.facility_id = n.facility_id
          AND p.product_code = n.product_code
          AND n.start_date BETWEEN p.start_date AND p.end_date
          AND n.end_date <= p.end_date))"""
_MERGED = (*_PAST, *_NEWS, _BASELINE, _EXTENDED, _ADDED)

ORACLES["q18_gap_flags"] = _with(*_SEEN, select="SELECT * FROM seen_gaps")
ORACLES["q19_island_ids"] = _with(
    *_SEEN, select="SELECT * EXCLUDE (previous_timestamp) FROM seen_ids"
)
ORACLES["q20_islands"] = _with(*_SEEN, select="SELECT * FROM seen")
ORACLES["s03_shortage_stream"] = ORACLES["q20_islands"]
ORACLES["q21_open_baseline"] = _with(*_PAST, _BASELINE, select="SELECT * FROM baseline")
ORACLES["q22_extensions"] = _with(
    *_PAST, *_NEWS, _BASELINE, _EXTENDED, select="SELECT * FROM extended"
)
ORACLES["q23_inserts"] = _with(*_MERGED, select="SELECT * FROM added")
ORACLES["q24_consolidated"] = _with(
    *_MERGED,
    select=f"""SELECT {_KEYS}, p.start_date,
               coalesce(e.new_end_date, p.end_date) AS end_date
        FROM past p LEFT JOIN (
            SELECT {_KEYS}, history_start_date AS start_date, new_end_date FROM extended) e
            USING ({_KEYS}, start_date)
        UNION ALL SELECT * FROM added""",
)

ORACLES["s05_shortage_runs"] = ORACLES["q24_consolidated"]
ORACLES["q42_overlaps"] = _with(
    *_PAST,
    *_NEWS,
    select=f"""SELECT {_KEYS}, n.start_date, n.end_date,
               p.start_date AS other_start_date, p.end_date AS other_end_date
        FROM news n JOIN past p USING ({_KEYS})
        WHERE n.start_date <= p.end_date + INTERVAL 13 HOUR
          AND p.start_date <= n.end_date + INTERVAL 13 HOUR""",
)

# Sales mart

_ORDER_KEYS = """'B' || (o_custkey % 10) AS branch_code,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS history_prog_id,
    'O' || o_orderkey AS order_prog_id, CAST(o_custkey AS VARCHAR) AS customer_code,
    'D' || o_orderkey AS delivery_note_id"""
_TOTAL_NAMES = (
    "delivered_qty_push, ordered_qty_push, delivered_qty_retail, ordered_qty_retail, "
    "delivered_qty_b2b, ordered_qty_b2b, delivered_qty_other, ordered_qty_other"
)
_KEY_NAMES = "branch_code, history_prog_id, order_prog_id, customer_code, delivery_note_id"

# Which lines count for a channel.
_MEMBERS = {
    "push": "l_returnflag = 'A'",
    "retail": "l_returnflag = 'N' AND l_linestatus = 'O'",
    "b2b": "l_returnflag = 'R'",
    "other": "l_returnflag = 'N' AND l_linestatus = 'F'",
}
_SUMS = ", ".join(
    f"""sum(l_quantity) FILTER ({member} AND l_linestatus = 'F') AS delivered_qty_{channel},
        sum(l_quantity) FILTER ({member}) AS ordered_qty_{channel}"""
    for channel, member in _MEMBERS.items()
)
_TOTALS = f"""totals AS (
    SELECT {_KEY_NAMES}, {_SUMS}
    FROM (SELECT {_ORDER_KEYS}, lineitem.*
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    GROUP BY ALL)"""

_SOLD = ", ".join(
    f"CASE WHEN ordered_qty_{key} > 0 THEN '{label}' END"
    for key, label in fixed.CHANNEL_LABELS.items()
)
_LABEL = f"""CASE list_count([{_SOLD}])
    WHEN 0 THEN order_channel
    WHEN 1 THEN coalesce({_SOLD})
    ELSE 'Mixed (' || concat_ws(', ', {_SOLD}) || ')'
    END"""

_NOTE_DATE = "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate + INTERVAL 3 DAY END"
_NOTHING = "CAST(NULL AS DOUBLE)"
_MART_ORDERS = f"""mart_orders AS (
    SELECT {_ORDER_KEYS},
           o_orderkey % 7 AS order_line_id, o_orderstatus AS order_type,
           'P' || (o_orderkey % 100) AS product_code,
           'item ' || (o_orderkey % 100) AS product_description,
           'PZ' AS unit_of_measure, 'T' AS product_type,
           o_orderkey % 2 = 0 AS is_bulky_item, o_custkey % 4 AS container_count,
           o_orderkey % 5 = 0 AS is_refrigerated, 'L' || (o_custkey % 3) AS shipping_line,
           CASE WHEN o_orderkey % 11 <> 0 THEN 'dock ' || o_custkey END AS shipping_address,
           CASE o_orderkey % 3 WHEN 1 THEN 'box' || o_orderkey
                               WHEN 2 THEN 'Box' || o_orderkey END AS container_reference,
           o_orderdate AS order_date, {_NOTE_DATE} AS delivery_note_date,
           {_NOTE_DATE} AS delivery_date,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS fulfillment_closed_timestamp,
           o_orderstatus = 'F' AS is_fulfillment_generated,
           o_orderstatus = 'F' AS is_fulfilled,
           o_orderkey % 4 = 0 AS is_order_consolidated,
           'N' || o_orderkey AS delivery_note_number,
           o_totalprice AS requested_quantity, o_totalprice AS ordered_quantity,
           o_totalprice AS ordered_quantity_cev,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE CAST(0 AS DOUBLE) END
               AS delivered_quantity,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS delivered_quantity_cev,
           CAST(0 AS DOUBLE) AS reversed_quantity, CAST(0 AS DOUBLE) AS reversed_quantity_cev,
           o_totalprice AS selling_price, o_totalprice AS public_retail_price,
           CAST(0.22 AS DOUBLE) AS vat_rate,
           {_NOTHING} AS line_discount_pct, {_NOTHING} AS cond_discount_pct_1,
           {_NOTHING} AS cond_discount_pct_2, CAST(0.5 AS DOUBLE) AS client_discount_pct,
           {_NOTHING} AS client_discount_pct_1, {_NOTHING} AS client_discount_pct_2,
           {_NOTHING} AS product_discount_pct,
           o_custkey % 6 AS lines_to_fulfill, o_custkey % 8 AS lines_ordered,
           o_orderdate AS record_timestamp, o_orderpriority AS order_channel
    FROM orders)"""
_JOINED = f"""joined AS (
    SELECT * FROM mart_orders LEFT JOIN totals USING ({_KEY_NAMES}))"""

_ORDER_PREFIX = (
    "branch_code || '_' || customer_code || '_' || history_prog_id || '_' || order_prog_id"
)
_SURROGATES = f"""
    {_ORDER_PREFIX} || '_' || order_line_id || '_' || product_code
        AS fulfillment_surrogate_key,
    {_ORDER_PREFIX} || '_' || delivery_note_id AS customer_order_surrogate_key,
    {_ORDER_PREFIX} || '_' || container_reference
        || if(regexp_matches(container_reference, '[A-Z]'), '_upp', '_low')
        AS container_order_surrogate_key,
    customer_code || '_' || shipping_address AS shipping_destination_surrogate_key"""
_CALENDAR = """
    CAST(year(delivery_note_date) AS INTEGER) AS delivery_note_year,
    CAST(month(delivery_note_date) AS INTEGER) AS delivery_note_month,
    monthname(delivery_note_date) AS delivery_note_month_name"""

ORACLES["q25_channel_totals"] = _with(_TOTALS, select="SELECT * FROM totals")
ORACLES["q26_channel_join"] = _with(
    _TOTALS,
    _MART_ORDERS,
    _JOINED,
    select=f"""SELECT {_KEY_NAMES}, order_channel, {_TOTAL_NAMES}
        FROM joined""",
)
ORACLES["q27_order_channel"] = _with(
    _TOTALS,
    _MART_ORDERS,
    _JOINED,
    select=f"SELECT order_prog_id, {_LABEL} AS order_channel FROM joined",
)
ORACLES["q28_surrogate_keys"] = _with(
    _MART_ORDERS, select=f"SELECT order_prog_id, {_SURROGATES} FROM mart_orders"
)
ORACLES["q29_calendar"] = _with(
    _MART_ORDERS,
    select=f"SELECT order_prog_id, delivery_note_date, {_CALENDAR} FROM mart_orders",
)
ORACLES["q30_sales_extended"] = _with(
    _TOTALS,
    _MART_ORDERS,
    _JOINED,
    select=f"""SELECT {_SURROGATES}, {_columns(fixed.MART_PASS_THROUGH)},
               {_TOTAL_NAMES}, {_LABEL} AS order_channel, {_CALENDAR},
               CASE WHEN delivered_quantity > 0 THEN 1 ELSE 0 END AS is_delivered_flag
        FROM joined WHERE order_date >= TIMESTAMP '2000-07-31'""",
)

ORACLES["q43_refreshed_mart"] = ORACLES["q30_sales_extended"]

# Mixed types

ORACLES["q34_split_choice"] = """
    SELECT event_id,
           CASE WHEN event_type <> 'error'
                THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k_long,
           CASE WHEN event_type = 'error' THEN 'n/a' END AS k_string
    FROM events"""
