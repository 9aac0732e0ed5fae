"""The registered queries once more, as SQL over the same tables."""

from __future__ import annotations

from workloads import inputs as I
from workloads import queries as Q
from workloads.hash_sql import hash_int, hash_text

LOAD = f"TIMESTAMP '{I.LOAD_TIME}'"
RUN = f"TIMESTAMP '{I.RUN_TIME}'"
RUN_COLUMNS = (
    f"'MRI' AS _source_system, {RUN} AS _processing_timestamp, CAST({RUN} AS DATE) AS _processing_date"
)

# --- change feed of users -------------------------------------------------------------------------

FEED = f"""
SELECT user_id, event_id, value,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
                       ELSE 'update_postimage' END AS _change_type,
       CAST(date_diff('day', DATE '{I.FIRST_EVENT_DAY}', CAST(ts AS DATE)) AS BIGINT) AS _commit_version,
       ts AS _commit_timestamp
FROM events"""

FEED_WITH_PREIMAGES = f"""
SELECT * FROM ({FEED})
UNION ALL
SELECT user_id, event_id, value - 1, 'update_preimage', _commit_version, _commit_timestamp
FROM ({FEED}) WHERE _change_type = 'update_postimage'"""


def normalized(feed: str) -> str:
    return f"""
SELECT user_id, event_id, value,
       CASE _change_type WHEN 'update_postimage' THEN 'update' ELSE _change_type END AS _raw_change_type,
       _commit_version AS _raw_commit_version, _commit_timestamp AS _raw_commit_timestamp
FROM ({feed}) WHERE _change_type <> 'update_preimage'"""


def snapshot(version: int) -> str:
    return f"""
SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY _commit_version DESC, _commit_timestamp DESC, event_id DESC, _change_type <> 'delete' DESC) AS rn
  FROM ({FEED}) WHERE _commit_version <= {version})
WHERE rn = 1 AND _change_type <> 'delete'"""


HISTORY = f"""
SELECT _commit_version AS version, max(_commit_timestamp) AS "timestamp"
FROM ({FEED}) GROUP BY _commit_version"""

RAW_ALL = f"SELECT {RUN_COLUMNS}, * FROM ({normalized(FEED)})"

RAW_INITIAL = f"""
SELECT {RUN_COLUMNS}, user_id, event_id, value, 'insert' AS _raw_change_type,
       CAST({I.FEED_ENABLED_AT - 1} AS BIGINT) AS _raw_commit_version,
       (SELECT "timestamp" FROM ({HISTORY}) WHERE version = {I.FEED_ENABLED_AT - 1}) AS _raw_commit_timestamp
FROM ({snapshot(I.FEED_ENABLED_AT - 1)})"""

RAW_INCREMENT = f"SELECT * FROM ({RAW_ALL}) WHERE _raw_commit_version >= {I.FEED_ENABLED_AT}"

_FIRST_ON, _OFF, _ON_AGAIN = (version for version, _ in I.SWITCHES)
FEED_STATE = f"""
SELECT start_version, end_version, (SELECT count(*) FROM ({HISTORY})
            WHERE version BETWEEN start_version AND coalesce(end_version, version)) AS commits,
       (SELECT max(version) FROM ({HISTORY})) AS latest, true AS enabled, CAST({_FIRST_ON} AS BIGINT) AS first_enabled
FROM (VALUES (CAST({_FIRST_ON} AS BIGINT), CAST({_OFF - 1} AS BIGINT)), ({_ON_AGAIN}, NULL)) AS t(start_version, end_version)"""

# What two snapshots of users differ in, as changes of the later one's commit.
RESTART = f"""
SELECT {RUN_COLUMNS}, coalesce(b.user_id, a.user_id) AS user_id,
       CASE WHEN b.user_id IS NULL THEN a.event_id ELSE b.event_id END AS event_id,
       CASE WHEN b.user_id IS NULL THEN a.value ELSE b.value END AS value,
       CASE WHEN b.user_id IS NULL THEN 'delete' WHEN a.user_id IS NULL THEN 'insert' ELSE 'update' END
         AS _raw_change_type,
       CAST({_ON_AGAIN - 1} AS BIGINT) AS _raw_commit_version,
       (SELECT "timestamp" FROM ({HISTORY}) WHERE version = {_ON_AGAIN - 1}) AS _raw_commit_timestamp
FROM ({snapshot(_OFF - 1)}) a FULL JOIN ({snapshot(_ON_AGAIN - 1)}) b ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.event_id IS DISTINCT FROM b.event_id
   OR a.value IS DISTINCT FROM b.value"""
INGEST_ACROSS_GAP = f"""
SELECT * FROM ({RAW_INITIAL})
UNION ALL BY NAME SELECT * FROM ({RAW_INCREMENT})
WHERE _raw_commit_version NOT BETWEEN {_OFF} AND {_ON_AGAIN - 1}
UNION ALL BY NAME SELECT * FROM ({RESTART})"""

LOAD_LOG = f"""
SELECT CAST(0 AS BIGINT) AS load, true AS of_this_feed, 'MRI' AS source_system, 'initial' AS kind,
       CAST({I.FEED_ENABLED_AT - 1} AS BIGINT) AS start_version, CAST({I.FEED_ENABLED_AT - 1} AS BIGINT) AS end_version,
       (SELECT count(*) FROM ({RAW_INITIAL})) AS row_count
UNION ALL
SELECT 1, true, 'MRI', 'incremental', {I.FEED_ENABLED_AT}, (SELECT max(version) FROM ({HISTORY})),
       (SELECT count(*) FROM ({RAW_INCREMENT}))"""

CHANGES = f"SELECT user_id || '|MRI' AS business_key, * FROM ({normalized(FEED)})"
TIED = f"SELECT * REPLACE (date_trunc('day', _commit_timestamp) AS _commit_timestamp) FROM ({FEED})"
TIED_CHANGES = f"SELECT user_id || '|MRI' AS business_key, * FROM ({normalized(TIED)})"


TWO_SOURCES = f"""
SELECT user_id || '|' || _source_system AS business_key, *
FROM (SELECT *, CASE WHEN value >= 100 THEN 'OAH' ELSE 'MRI' END AS _source_system FROM ({normalized(FEED)}))"""
RAW_EVOLVED = f"""
SELECT *, CASE WHEN _raw_commit_version <= {Q.SNAPSHOT_VERSION} THEN NULL
               WHEN value >= 100 THEN 'high' ELSE 'low' END AS grade
FROM ({RAW_ALL})"""


def scd1(changes: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _raw_commit_timestamp DESC,
      _raw_commit_version DESC, event_id DESC, _raw_change_type <> 'delete' DESC) AS rn
  FROM ({changes}))
WHERE rn = 1 AND _raw_change_type <> 'delete'"""


def scd2(changes: str, keys: str = "user_id") -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, _raw_commit_timestamp AS "__START_AT",
         lead(_raw_commit_timestamp) OVER (PARTITION BY {keys} ORDER BY _raw_commit_timestamp) AS "__END_AT"
  FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys}, _raw_commit_timestamp
        ORDER BY _raw_commit_version DESC, event_id DESC, _raw_change_type <> 'delete' DESC) AS rn
    FROM ({changes}))
  WHERE rn = 1)
WHERE _raw_change_type <> 'delete'"""


OVERWRITTEN = f"""
SELECT c_custkey, c_acctbal + more AS c_acctbal, _raw_change_type, _raw_commit_version, _raw_commit_timestamp
FROM customer, (VALUES ('insert', CAST(0 AS BIGINT), 0, {LOAD}), ('delete', 1, 0, {RUN}), ('insert', 1, 1, {RUN}))
     AS c(_raw_change_type, _raw_commit_version, more, _raw_commit_timestamp)"""
OVERWRITTEN_LAST = f"SELECT * FROM ({OVERWRITTEN}) WHERE _raw_commit_version = 1 AND _raw_change_type = 'insert'"
OVERWRITTEN_SCD2 = f"""
SELECT *, _raw_commit_timestamp AS "__START_AT",
       CASE WHEN _raw_commit_version = 0 THEN {RUN} END AS "__END_AT"
FROM ({OVERWRITTEN}) WHERE _raw_change_type = 'insert'"""

SKEWED = f"""
SELECT * REPLACE (CASE event_id % 3 WHEN 0 THEN 1 WHEN 2 THEN user_id END AS user_id) FROM ({FEED})"""
SKEWED_CHANGES = f"SELECT concat_ws('|', user_id, 'MRI') AS business_key, * FROM ({normalized(SKEWED)})"
SKEWED_VIEW = f"""
SELECT business_key, user_id, event_id, value, _raw_change_type, _raw_commit_timestamp, _raw_commit_version,
       NOT bool_or("__END_AT" IS NULL) OVER (PARTITION BY user_id) AS is_deleted,
       "__END_AT" IS NULL AS is_current, "__START_AT" AS _row_valid_from
FROM ({scd2(SKEWED_CHANGES)})"""


def valid_to(end: str) -> str:
    return f"strftime(coalesce({end}, TIMESTAMP '9999-12-31 23:59:59'), '%Y-%m-%d %H:%M:%S') AS _row_valid_to"


SCD2_VIEW = f"""
SELECT business_key, user_id, event_id, value, _raw_change_type, _raw_commit_timestamp, _raw_commit_version,
       NOT bool_or("__END_AT" IS NULL) OVER (PARTITION BY user_id) AS is_deleted,
       "__END_AT" IS NULL AS is_current, "__START_AT" AS _row_valid_from, {valid_to('"__END_AT"')}
FROM ({scd2(CHANGES)})"""

GOLD_SCD2 = f"""
SELECT business_key, user_id, value, user_key,
       CASE WHEN "__START_AT" = min("__START_AT") OVER w THEN TIMESTAMP '1900-01-01 00:00:00'
            ELSE "__START_AT" END AS _row_valid_from,
       {valid_to('"__END_AT"')},
       "__END_AT" IS NULL AS is_current,
       "__END_AT" IS NOT NULL AND NOT bool_or("__END_AT" IS NULL) OVER w
         AND "__START_AT" = max(CASE WHEN "__END_AT" IS NOT NULL THEN "__START_AT" END) OVER w AS is_deleted
FROM ({hash_text(scd2(CHANGES), "business_key", "user_key")})
WINDOW w AS (PARTITION BY business_key)"""

VERSION_WINDOWS = f"""
SELECT user_id, processed, latest,
       CASE WHEN busy THEN start END AS start_version, CASE WHEN busy THEN latest END AS end_version,
       CASE WHEN busy THEN greatest(latest - start + 1, 0) ELSE 0 END AS versions
FROM (
  SELECT *, CASE WHEN processed >= {I.FEED_ENABLED_AT} THEN processed + 1
                 ELSE CAST({I.FEED_ENABLED_AT} AS BIGINT) END AS start,
         processed IS NULL OR latest > processed AS busy
  FROM (
    SELECT user_id, max(_commit_version) FILTER (WHERE _commit_version <= {Q.SNAPSHOT_VERSION}) AS processed,
           max(_commit_version) AS latest
    FROM ({FEED}) GROUP BY user_id))"""

# --- business tables ------------------------------------------------------------------------------

META = f"""'insert' AS _raw_change_type, {LOAD} AS _raw_commit_timestamp,
       CAST(0 AS BIGINT) AS _raw_commit_version, {RUN} AS _silver_timestamp"""

PARTSUPP = """
SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, CAST(sum(l_quantity) AS INTEGER) AS ps_availqty,
       min(l_extendedprice) AS ps_supplycost
FROM lineitem GROUP BY l_partkey, l_suppkey"""

SILVER = {
    "customer": f"""
SELECT c_custkey || '|MRI' AS business_key, CAST(c_custkey AS BIGINT) AS c_custkey, c_name,
       'x-' || c_custkey AS c_address, c_nationkey, 'x-' || c_custkey AS c_phone, c_acctbal, c_mktsegment,
       'x-' || c_custkey AS c_comment, {META}
FROM customer""",
    "nation": f"""
SELECT n_nationkey || '|MRI' AS business_key, n_nationkey, n_name, n_regionkey,
       'x-' || n_nationkey AS n_comment, {META}
FROM nation""",
    "region": f"""
SELECT r_regionkey || '|MRI' AS business_key, r_regionkey, r_name, 'x-' || r_regionkey AS r_comment, {META}
FROM region""",
    "part": f"""
SELECT p_partkey || '|MRI' AS business_key, CAST(p_partkey AS BIGINT) AS p_partkey, p_name,
       'x-' || p_partkey AS p_mfgr, p_brand, p_type, p_size, 'x-' || p_partkey AS p_container,
       CAST(p_retailprice AS DECIMAL(15,2)) AS p_retailprice, 'x-' || p_partkey AS p_comment, {META}
FROM part""",
    "order": f"""
SELECT o_orderkey || '|OAH' AS business_key, CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CAST(o_custkey AS BIGINT) AS o_custkey, substr(o_orderstatus, 1, 1) AS o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, 'x-' || o_orderkey AS o_clerk,
       CAST(0 AS INTEGER) AS o_shippriority, 'x-' || o_orderkey AS o_comment, {META}
FROM orders""",
    "supplier": f"""
SELECT s_suppkey || '|OAH' AS business_key, CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name,
       'x-' || s_suppkey AS s_address, s_nationkey, 'x-' || s_suppkey AS s_phone, s_acctbal,
       'x-' || s_suppkey AS s_comment, {META}
FROM supplier""",
    "partsupp": f"""
SELECT ps_partkey || '|' || ps_suppkey || '|OAH' AS business_key, CAST(ps_partkey AS BIGINT) AS ps_partkey,
       CAST(ps_suppkey AS BIGINT) AS ps_suppkey, ps_availqty, ps_supplycost,
       'x-' || ps_partkey AS ps_comment, {META}
FROM ({PARTSUPP})""",
    "customer_narrow": f"""
SELECT c_custkey || '|MRI' AS business_key, CAST(c_custkey AS BIGINT) AS c_custkey, c_name, {META}
FROM customer""",
}

# --- star schema ----------------------------------------------------------------------------------

LOCATED = f"({SILVER['nation']}) n LEFT JOIN ({SILVER['region']}) r ON n.n_regionkey = r.r_regionkey"



def customers(customer: str, nation: str) -> str:
    return f"""
SELECT c_custkey AS customer_key, c_name AS customer_name, c_address AS customer_address,
       c_phone AS customer_phone, c_acctbal AS customer_account_balance,
       c_mktsegment AS customer_market_segment, c_comment AS customer_comment, n_name AS nation_name,
       r_name AS region_name, n_nationkey AS nation_key, r_regionkey AS region_key,
       concat_ws('-', c_custkey, n_nationkey, r_regionkey) AS _key
FROM ({customer}) c LEFT JOIN ({nation}) n ON c.c_nationkey = n.n_nationkey
LEFT JOIN ({SILVER['region']}) r ON n.n_regionkey = r.r_regionkey"""


def dim_customer(customer: str = SILVER["customer"], nation: str = SILVER["nation"]) -> str:
    return f"""
SELECT * EXCLUDE (_key) FROM ({hash_text(customers(customer, nation), "_key", "customer_surrogate_key")})
UNION ALL BY NAME
SELECT -1 AS customer_surrogate_key, -1 AS customer_key, 'Unknown' AS customer_name,
       'Unknown' AS customer_address, 'Unknown' AS customer_phone,
       CAST(0 AS DOUBLE) AS customer_account_balance, 'Unknown' AS customer_market_segment,
       'Unknown' AS customer_comment, 'Unknown' AS nation_name, 'Unknown' AS region_name,
       -1 AS nation_key, -1 AS region_key"""


DIM_CUSTOMER = dim_customer()
DIM_CUSTOMER_UNLOCATED = dim_customer(
    f"SELECT * REPLACE (nullif(c_nationkey, 3) AS c_nationkey) FROM ({SILVER['customer']})",
    f"SELECT * REPLACE (nullif(n_regionkey, 2) AS n_regionkey) FROM ({SILVER['nation']})",
)

NATIONS = f"""
SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key, r_name AS region_name,
       n_comment AS nation_comment
FROM {LOCATED}"""

DIM_NATION = f"""
SELECT * FROM ({hash_int(NATIONS, "nation_key", "nation_surrogate_key")})
UNION ALL BY NAME
SELECT -1 AS nation_surrogate_key, -1 AS nation_key, 'Unknown' AS nation_name, -1 AS region_key,
       'Unknown' AS region_name, 'Unknown' AS nation_comment"""

REGIONS = f"""
SELECT r_regionkey AS region_key, r_name AS region_name, r_comment AS region_comment
FROM ({SILVER['region']})"""

DIM_REGION = f"""
SELECT * FROM ({hash_int(REGIONS, "region_key", "region_surrogate_key")})
UNION ALL BY NAME
SELECT -1 AS region_surrogate_key, -1 AS region_key, 'Unknown' AS region_name, 'Unknown' AS region_comment"""

SUPPLIERS = f"""
SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_address AS supplier_address,
       s_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key, r_name AS region_name,
       s_phone AS supplier_phone, s_acctbal AS supplier_account_balance, s_comment AS supplier_comment
FROM ({SILVER['supplier']}) s LEFT JOIN ({SILVER['nation']}) n ON s.s_nationkey = n.n_nationkey
LEFT JOIN ({SILVER['region']}) r ON n.n_regionkey = r.r_regionkey"""

DIM_SUPPLIER = f"""
SELECT * FROM ({hash_int(SUPPLIERS, "supplier_key", "supplier_surrogate_key")})
UNION ALL BY NAME
SELECT -1 AS supplier_surrogate_key, -1 AS supplier_key, 'Unknown' AS supplier_name,
       'Unknown' AS supplier_address, -1 AS nation_key, 'Unknown' AS nation_name, -1 AS region_key,
       'Unknown' AS region_name, 'Unknown' AS supplier_phone, CAST(0 AS DOUBLE) AS supplier_account_balance,
       'Unknown' AS supplier_comment"""

PARTS = f"""
SELECT p_partkey AS part_key, p_name AS part_name, p_mfgr AS part_manufacturer, p_brand AS part_brand,
       p_type AS part_type, p_size AS part_size, p_container AS part_container,
       p_retailprice AS part_retail_price, p_comment AS part_comment
FROM ({SILVER['part']})"""

DIM_PART = f"""
SELECT * FROM ({hash_int(PARTS, "part_key", "part_surrogate_key")})
UNION ALL BY NAME
SELECT -1 AS part_surrogate_key, -1 AS part_key, 'Unknown' AS part_name, 'Unknown' AS part_manufacturer,
       'Unknown' AS part_brand, 'Unknown' AS part_type, 0 AS part_size, 'Unknown' AS part_container,
       CAST(0 AS DECIMAL(15,2)) AS part_retail_price, 'Unknown' AS part_comment"""

PART_SUPPLIERS = f"""
SELECT ps_partkey AS part_key, ps_suppkey AS supplier_key, ps_availqty AS available_quantity,
       CAST(ps_supplycost AS DECIMAL(15,2)) AS supply_cost, ps_comment AS comment,
       concat_ws('-', ps_partkey, ps_suppkey) AS _key
FROM ({SILVER['partsupp']})"""

DIM_PART_SUPPLIER = f"""
SELECT * EXCLUDE (_key) FROM ({hash_text(PART_SUPPLIERS, "_key", "part_supplier_key")})
UNION ALL BY NAME
SELECT -1 AS part_supplier_key, -1 AS part_key, -1 AS supplier_key, 0 AS available_quantity,
       CAST(0 AS DECIMAL(15,2)) AS supply_cost, 'Unknown' AS comment"""

DIM_DATE = """
WITH days AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS DATE)
         AS full_date),
calendar AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, strftime(full_date, '%A') AS day_name,
         CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
         CAST(month(full_date) AS INTEGER) AS month_number, strftime(full_date, '%B') AS month_name,
         CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
         dayofweek(full_date) IN (0, 6) AS is_weekend, false AS is_holiday,
         CAST(year(full_date) AS INTEGER) AS fiscal_year, CAST(quarter(full_date) AS INTEGER) AS fiscal_quarter,
         CAST(month(full_date) AS INTEGER) AS fiscal_period
  FROM days
  UNION ALL
  SELECT -1, DATE '1900-01-01', 0, 'Unknown', 0, 0, 0, 0, 'Unknown', 0, 1900, false, false, 1900, 0, 0),
placed AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS orders_placed
  FROM orders GROUP BY 1)
SELECT calendar.*, coalesce(orders_placed, 0) AS orders_placed
FROM calendar LEFT JOIN placed ON calendar.date_key = placed.date_key"""


def fact_order(orders: str, dimension: str) -> str:
    return f"""
SELECT o_orderkey AS order_key, coalesce(customer_surrogate_key, -1) AS customer_surrogate_key,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key, o_orderstatus AS order_status,
       o_orderpriority AS order_priority, o_clerk AS clerk_name, o_shippriority AS ship_priority,
       CAST(o_totalprice AS DECIMAL(15,2)) AS total_price, o_comment AS order_comment,
       o_orderdate AS order_date, _raw_commit_timestamp AS created_at, _raw_commit_timestamp AS updated_at
FROM ({orders}) o LEFT JOIN ({dimension}) c ON o.o_custkey = c.customer_key"""


FACT_ORDER = fact_order(SILVER["order"], DIM_CUSTOMER)
FACT_ORDER_GAPS = fact_order(
    f"""SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate)
FROM ({SILVER['order']})""",
    f"SELECT * FROM ({DIM_CUSTOMER}) WHERE customer_account_balance >= 0",
)

FACT_ORDER_LINES = f"""
SELECT f.*, CAST(coalesce(q, 0) AS DECIMAL(15,2)) AS total_quantity,
       CAST(coalesce(d, 0) AS DECIMAL(15,2)) AS total_discount,
       CAST(coalesce(t, 0) AS DECIMAL(15,2)) AS total_tax,
       CAST(coalesce(p, 0) AS DECIMAL(15,2)) AS total_extended_price,
       coalesce(n, 0) AS line_item_count
FROM ({FACT_ORDER}) f LEFT JOIN (
  SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(15,2))) AS q, sum(CAST(l_discount AS DECIMAL(15,2))) AS d,
         sum(CAST(l_tax AS DECIMAL(15,2))) AS t, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS p,
         count(*) AS n
  FROM lineitem GROUP BY l_orderkey) l ON f.order_key = l.l_orderkey"""

# --- feeds and layers -----------------------------------------------------------------------------

SOURCE_COUNTS = {
    "h_customer": "SELECT count(*) AS n FROM customer",
    "h_nation": "SELECT count(*) AS n FROM nation",
    "h_region": "SELECT count(*) AS n FROM region",
    "h_part": "SELECT count(*) AS n FROM part",
    "h_order": "SELECT count(*) AS n FROM orders",
    "h_supplier": "SELECT count(*) AS n FROM supplier",
    "h_partsupp": f"SELECT count(*) AS n FROM ({PARTSUPP})",
}
SYSTEM_OF = {table: s["source_system"] for s in Q.SYSTEMS for table in s["tables"]}


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


FEED_CONFIGS = union_all(
    [
        f"SELECT '{table}' AS table_name, '{SYSTEM_OF[table]}' AS source_system, "
        f"'/lake/sources/{table}' AS source_table_path, "
        f"'/lake/raw/{SYSTEM_OF[table].lower()}/{table}' AS target_table_path, "
        f"n AS source_rows FROM ({count})"
        for table, count in SOURCE_COUNTS.items()
    ]
)

INGEST_ALL_FEEDS = union_all(
    [
        f"SELECT '{table}' AS table_name, '{SYSTEM_OF[table]}' AS _source_system, "
        f"'{kind}' AS _raw_change_type, CAST({version} AS BIGINT) AS _raw_commit_version, n AS row_count "
        f"FROM ({count})"
        for table, count in SOURCE_COUNTS.items()
        for kind, version in (("insert", 0), ("update", 2))
    ]
)


INGEST_WITH_BAD_FEED = union_all(
    [
        f"SELECT '{table}' AS table_name, {str(table == Q.BAD_FEED).lower()} AS failed, "
        f"{0 if table == Q.BAD_FEED else 'n'} AS row_count FROM ({count})"
        for table, count in SOURCE_COUNTS.items()
    ]
)


def _layer(layer: str, name: str, rows: str, table: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, {rows} AS row_count FROM ({SOURCE_COUNTS[table]})"
    )


PIPELINE = union_all(
    [_layer(layer, table, "2 * n", table) for layer in ("raw", "bronze") for table in SOURCE_COUNTS]
    + [_layer("silver", t[2:], "n" if t == "h_order" else "2 * n", t) for t in SOURCE_COUNTS]
    + [
        _layer("silver", "customer_narrow", "2 * n", "h_customer"),
        _layer("gold", "dim_customer", "n + 1", "h_customer"),
        _layer("gold", "dim_nation", "n + 1", "h_nation"),
        _layer("gold", "dim_region", "n + 1", "h_region"),
        _layer("gold", "dim_part", "n + 1", "h_part"),
        _layer("gold", "dim_supplier", "n + 1", "h_supplier"),
        _layer("gold", "dim_part_supplier", "n + 1", "h_partsupp"),
        _layer("gold", "fact_order", "n", "h_order"),
        "SELECT 'gold', 'dim_date', date_diff('day', DATE '2000-01-01', DATE '2030-12-31') + 2",
    ]
)

_NEVER = ("h_supplier", "h_order")
PIPELINE_EMPTY = union_all(
    [_layer(layer, table, "0" if table in _NEVER else "n", table) for layer in ("raw", "bronze") for table in SOURCE_COUNTS]
    + [_layer("silver", t[2:], "0" if t in _NEVER else "n", t) for t in SOURCE_COUNTS]
    + [
        _layer("silver", "customer_narrow", "n", "h_customer"),
        _layer("gold", "dim_customer", "n + 1", "h_customer"),
        _layer("gold", "dim_nation", "n + 1", "h_nation"),
        _layer("gold", "dim_region", "n + 1", "h_region"),
        _layer("gold", "dim_part", "n + 1", "h_part"),
        _layer("gold", "dim_supplier", "1", "h_supplier"),
        _layer("gold", "dim_part_supplier", "n + 1", "h_partsupp"),
        _layer("gold", "fact_order", "0", "h_order"),
        "SELECT 'gold', 'dim_date', date_diff('day', DATE '2000-01-01', DATE '2030-12-31') + 2",
    ]
)

FIRST, TOUCHED = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-03'"
PIPELINE_FACT = f"SELECT * REPLACE ({FIRST} AS created_at, {TOUCHED} AS updated_at) FROM ({FACT_ORDER})"
PIPELINE_CUSTOMERS = f"""
SELECT c.* REPLACE (kind AS _raw_change_type, began AS _raw_commit_timestamp, version AS _raw_commit_version),
       began AS "__START_AT", ended AS "__END_AT"
FROM ({SILVER['customer']}) c, (VALUES ('insert', CAST(0 AS BIGINT), {FIRST}, {TOUCHED}), ('update', 2, {TOUCHED}, NULL))
     AS v(kind, version, began, ended)"""
STREAM_LOG = union_all(
    [
        f"SELECT '{table}' AS stream, 2 * n AS row_count, CAST(2 AS BIGINT) AS high_version FROM ({count})"
        for table, count in SOURCE_COUNTS.items()
    ]
)

BUSINESS_KEYS = """
SELECT l_orderkey, l_linenumber, concat_ws('|', l_partkey, l_suppkey, 'OAH') AS business_key,
       concat_ws('-', l_orderkey, l_linenumber) AS line_key,
       concat_ws('/', nullif(l_returnflag, 'N'), l_linestatus) AS flag_key
FROM lineitem"""

SNAPSHOT_TAGGED = f"""
SELECT {RUN_COLUMNS}, 'insert' AS _change_type, {LOAD} AS _commit_timestamp,
       CAST({Q.SNAPSHOT_VERSION} AS BIGINT) AS _commit_version, *
FROM ({snapshot(Q.SNAPSHOT_VERSION)})"""

ORACLE: dict[str, str] = {
    "cdf_range": f"SELECT * FROM ({FEED_WITH_PREIMAGES}) "
    f"WHERE _commit_version BETWEEN {Q.WINDOW_START} AND {Q.WINDOW_END}",
    "cdf_normalized": normalized(FEED_WITH_PREIMAGES),
    "snapshot_as_of": snapshot(Q.SNAPSHOT_VERSION),
    "snapshot_from_checkpoint": snapshot(Q.SNAPSHOT_VERSION),
    "snapshot_tagged": SNAPSHOT_TAGGED,
    "run_metadata": RAW_ALL,
    "business_keys": BUSINESS_KEYS,
    "feed_versions": f"SELECT max(version) AS version FROM ({HISTORY})",
    "commit_timestamps": f'SELECT max("timestamp") AS "timestamp" FROM ({HISTORY}) '
    f"WHERE version = {Q.SNAPSHOT_VERSION}",
    "feed_start_version": f'SELECT version, "timestamp" FROM ({HISTORY}) '
    f"WHERE version = {I.FEED_ENABLED_AT} ORDER BY version LIMIT 1",
    "high_water_mark": f"SELECT max(_commit_version) AS version FROM ({FEED}) "
    f"WHERE _commit_version <= {Q.SNAPSHOT_VERSION}",
    "version_windows": VERSION_WINDOWS,
    "raw_history": RAW_ALL,
    "raw_history_evolved": RAW_EVOLVED,
    "initial_load": RAW_INITIAL,
    "incremental_load": RAW_INCREMENT,
    "ingest_two_runs": f"SELECT * FROM ({RAW_INITIAL}) UNION ALL BY NAME SELECT * FROM ({RAW_INCREMENT})",
    "ingest_after_broken_load": f"SELECT * FROM ({RAW_INITIAL}) UNION ALL BY NAME SELECT * FROM ({RAW_INCREMENT})",
    "ingest_across_gap": INGEST_ACROSS_GAP,
    "load_log": LOAD_LOG,
    "feed_state": FEED_STATE,
    "ingest_all_feeds": INGEST_ALL_FEEDS,
    "ingest_with_bad_feed": INGEST_WITH_BAD_FEED,
    "feed_configs": FEED_CONFIGS,
    "bronze_stream": RAW_ALL,
    "bronze_evolved": RAW_EVOLVED,
    "bronze_lineage": f"SELECT event_id, true AS has_path, true AS has_time FROM ({normalized(FEED)})",
    **{f"silver_{name}": sql for name, sql in SILVER.items()},
    "silver_stream": SILVER["order"],
    "scd1_latest": scd1(CHANGES),
    "snapshot_overwritten": f"SELECT c_custkey, c_acctbal FROM ({OVERWRITTEN_LAST})",
    "scd1_overwritten": OVERWRITTEN_LAST,
    "scd2_overwritten": OVERWRITTEN_SCD2,
    "scd2_skewed": scd2(SKEWED_CHANGES),
    "scd2_view_skewed": SKEWED_VIEW,
    "scd2_history": scd2(CHANGES),
    "scd2_history_tied": scd2(TIED_CHANGES),
    "scd2_two_sources": scd2(TWO_SOURCES, "user_id, _source_system"),
    "scd2_view": SCD2_VIEW,
    "gold_scd2_dim": GOLD_SCD2,
    "scd1_stream": scd1(CHANGES),
    "scd2_stream": scd2(CHANGES),
    "dim_customer": DIM_CUSTOMER,
    "dim_customer_unlocated": DIM_CUSTOMER_UNLOCATED,
    "dim_nation": DIM_NATION,
    "dim_region": DIM_REGION,
    "dim_supplier": DIM_SUPPLIER,
    "dim_part": DIM_PART,
    "dim_part_supplier": DIM_PART_SUPPLIER,
    "dim_date": DIM_DATE,
    "fact_order": FACT_ORDER,
    "fact_order_gaps": FACT_ORDER_GAPS,
    "fact_order_lines": FACT_ORDER_LINES,
    "fact_order_stream": FACT_ORDER,
    "pipeline_end_to_end": PIPELINE,
    "pipeline_fact_order": PIPELINE_FACT,
    "pipeline_customer_versions": PIPELINE_CUSTOMERS,
    "stream_log": STREAM_LOG,
    "pipeline_empty_source": PIPELINE_EMPTY,
}
