"""DuckDB SQL over the flat driver tables that each registered query must equal.

The SQL never goes through documents: it states the expected result of
build -> parse -> dedup -> merge directly from ``orders``, ``lineitem``,
``part``, ``customer``, ``nation``, ``region`` and ``events``.
"""

from __future__ import annotations

TIER = ("CASE WHEN c.c_acctbal < 0 THEN 'IN_DEBT' WHEN c.c_acctbal < 3000 THEN 'LOW' "
        "WHEN c.c_acctbal < 7000 THEN 'MIDDLE' ELSE 'HIGH' END")


def promote(x: str) -> str:
    return f"CASE {x} WHEN 'IN_DEBT' THEN 'LOW' WHEN 'LOW' THEN 'MIDDLE' WHEN 'MIDDLE' THEN 'HIGH' ELSE {x} END"


def file_name(prefix: str) -> str:
    return (f"'{prefix}orders_' || strftime(o.o_orderdate, '%Y%m') || '_' || "
            f"printf('%05d', o.o_orderkey // 100000) || '.json'")


DOCS = f"""docs AS (
  SELECT o.o_orderkey,
         CAST(o.o_custkey AS DECIMAL(38,0)) AS customer_id,
         {TIER} AS tier1,
         c.c_mktsegment AS segment,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(o.o_orderkey AS DECIMAL(38,0)) AS order_id,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,0)) AS payment_amount,
         'EUR' AS payment_currency,
         o.o_orderpriority AS payment_method,
         r.r_name AS shipping_city,
         n.n_name AS shipping_country,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'EXPRESS'
              WHEN o.o_orderpriority = '5-LOW' THEN 'FREIGHT' ELSE 'STANDARD' END AS shipping_delivery_type,
         o.o_orderstatus AS status1,
         {file_name('b1/')} AS file1,
         {file_name('b2/')} AS file2,
         coalesce(o.o_orderstatus = 'O', false) AS resent
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

CUR = f"""cur AS (
  SELECT d.*,
         CASE WHEN resent THEN 'F' ELSE status1 END AS status,
         CASE WHEN resent THEN {promote('tier1')} ELSE tier1 END AS loyalty_tier,
         CASE WHEN resent THEN file2 ELSE file1 END AS file_name
  FROM docs d
)"""

LINES = """lines AS (
  SELECT l.l_orderkey, l.l_linestatus,
         CAST(l.l_partkey AS DECIMAL(38,0)) AS product_id,
         p.p_type AS category,
         CAST(l.l_quantity AS DECIMAL(38,0)) AS quantity,
         CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,0)) AS unit_price,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price_cents
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""

# items of the state after both batches: every line of an order not re-sent,
# only fulfilled lines of a re-sent order
ITEMS2 = """items2 AS (
  SELECT c.order_id, c.order_date, li.product_id, li.category, li.quantity, li.unit_price, li.unit_price_cents,
         c.file_name
  FROM cur c JOIN lines li ON li.l_orderkey = c.o_orderkey
  WHERE NOT c.resent OR li.l_linestatus = 'F'
)"""

ORDER_COLS = ("customer_id, loyalty_tier, segment, order_date, order_id, payment_amount, payment_currency, "
              "payment_method, shipping_city, shipping_country, shipping_delivery_type, status, file_name")
FACT_ORDER_COLS = ("order_id, customer_id, order_date, payment_amount, payment_currency, payment_method, "
                   "shipping_city, shipping_country, shipping_delivery_type, status")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["parse_orders"] = _with(DOCS) + """
SELECT file1 AS file_name,
       row_number() OVER (PARTITION BY file1 ORDER BY o_orderkey) AS row_number,
       customer_id, tier1 AS loyalty_tier, segment, order_date, order_id, payment_amount, payment_currency,
       payment_method, shipping_city, shipping_country, shipping_delivery_type, status1 AS status
FROM docs"""

ORACLE["latest_event_per_user"] = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1"""

ORACLE["latest_order_version"] = _with(DOCS, CUR) + """
SELECT order_id, status, loyalty_tier, file_name FROM cur"""

ORACLE["explode_items"] = _with(DOCS, LINES) + """
SELECT d.order_id, d.order_date, li.product_id, li.category, li.quantity, li.unit_price, d.file1 AS file_name
FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey"""

ORACLE["explode_items_outer"] = _with(DOCS, LINES) + """
SELECT d.order_id, d.order_date, li.product_id, li.category, li.quantity, li.unit_price, d.file1 AS file_name
FROM docs d LEFT JOIN lines li ON li.l_orderkey = d.o_orderkey"""

ORACLE["stg_orders_upsert"] = _with(DOCS, CUR) + f"SELECT {ORDER_COLS} FROM cur"

ORACLE["stg_items_replace"] = _with(DOCS, CUR, LINES, ITEMS2) + """
SELECT order_id, order_date, product_id, category, quantity, unit_price, file_name FROM items2"""

ORACLE["item_delete_count"] = _with(DOCS, LINES) + """
SELECT CAST(count(*) AS BIGINT) AS deleted_rows
FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey WHERE d.resent"""

ORACLE["surviving_items_anti"] = _with(DOCS, LINES) + """
SELECT d.order_id, d.order_date, li.product_id, li.category, li.quantity, li.unit_price, d.file1 AS file_name
FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey
WHERE d.order_id NOT IN (SELECT order_id FROM docs WHERE resent)"""

ORACLE["affected_keys"] = _with(DOCS) + "SELECT DISTINCT order_id FROM docs WHERE resent"

ORACLE["dim_customer_scd1"] = _with(DOCS, CUR) + """
SELECT DISTINCT customer_id, segment, loyalty_tier FROM (
  SELECT customer_id, segment, loyalty_tier,
         row_number() OVER (PARTITION BY customer_id ORDER BY resent DESC) AS rn
  FROM cur WHERE customer_id IS NOT NULL
) WHERE rn = 1"""

ORACLE["dim_product_scd1"] = _with(DOCS, LINES) + """
SELECT DISTINCT li.product_id, li.category
FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey WHERE li.product_id IS NOT NULL"""

ORACLE["fact_orders"] = _with(DOCS, CUR) + f"SELECT {FACT_ORDER_COLS} FROM cur"

ORACLE["fact_order_items"] = _with(DOCS, CUR, LINES, ITEMS2) + """
SELECT order_id, product_id, order_date, quantity, unit_price, quantity * unit_price AS extended_amount
FROM items2"""

ORACLE["fact_order_items_cents"] = _with(DOCS, CUR, LINES, ITEMS2) + """
SELECT order_id, product_id, order_date, quantity, unit_price_cents AS unit_price,
       CAST(quantity * unit_price_cents AS DECIMAL(38,2)) AS extended_amount
FROM items2"""

ORACLE["net_changes_orders"] = _with(DOCS) + f"""
SELECT order_id, status1 AS status, tier1 AS loyalty_tier, file1 AS file_name,
       'DELETE' AS _action, TRUE AS _is_update FROM docs WHERE resent
UNION ALL
SELECT order_id, 'F' AS status, {promote('tier1')} AS loyalty_tier, file2 AS file_name,
       'INSERT' AS _action, TRUE AS _is_update FROM docs WHERE resent"""

ORACLE["net_changes_items"] = _with(DOCS, LINES) + """
SELECT d.order_id, d.order_date, li.product_id, li.category, li.quantity, li.unit_price, 'DELETE' AS _action
FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey
WHERE d.resent AND li.l_linestatus IS DISTINCT FROM 'F'"""

ORACLE["merge_row_counts"] = _with(DOCS, LINES) + """
SELECT 'inserted_rows' AS metric, CAST(0 AS BIGINT) AS value
UNION ALL SELECT 'updated_rows', CAST(count(*) AS BIGINT) FROM docs WHERE resent
UNION ALL SELECT 'merged_rows', CAST(count(*) AS BIGINT) FROM docs WHERE resent
UNION ALL SELECT 'deleted_item_rows', CAST(count(*) AS BIGINT)
  FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey WHERE d.resent
UNION ALL SELECT 'inserted_item_rows', CAST(count(*) AS BIGINT)
  FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey WHERE d.resent AND li.l_linestatus = 'F'"""

ORACLE["max_file_name"] = _with(DOCS) + """
SELECT CAST(count(DISTINCT file1) AS BIGINT) AS file_count, max(file1) AS max_file_name,
       CAST(count(*) AS BIGINT) AS doc_count FROM docs"""

EVENTS_LANDING = """land AS (
  SELECT 'events_' || strftime(ts, '%Y%m%d') AS file_name, ts AS load_ts FROM events
), recent AS (
  SELECT * FROM land WHERE load_ts >= (SELECT max(load_ts) FROM land) - INTERVAL 48 HOUR
)"""

ORACLE["load_history_48h"] = _with(EVENTS_LANDING) + """
SELECT file_name, CAST(count(*) AS BIGINT) AS rows_loaded, min(load_ts) AS first_load_ts,
       max(load_ts) AS last_load_ts
FROM recent GROUP BY file_name"""

ORACLE["load_usage_hourly"] = _with(EVENTS_LANDING) + """
SELECT date_trunc('hour', load_ts) AS hour_start, CAST(count(DISTINCT file_name) AS BIGINT) AS files_loaded,
       CAST(count(*) AS BIGINT) AS rows_loaded
FROM recent GROUP BY 1"""

ORACLE["run_history"] = """
SELECT event_id, ts, user_id, event_type FROM events WHERE event_type ILIKE 'PUR%' ORDER BY ts DESC"""

ORACLE["star_revenue"] = _with(DOCS, CUR, LINES, ITEMS2) + """
, dimc AS (
  SELECT customer_id, loyalty_tier FROM (
    SELECT customer_id, loyalty_tier, row_number() OVER (PARTITION BY customer_id ORDER BY resent DESC) AS rn
    FROM cur WHERE customer_id IS NOT NULL) WHERE rn = 1
), per_order AS (
  SELECT order_id, category, sum(quantity * unit_price) AS rev, count(*) AS n FROM items2 GROUP BY 1, 2
)
SELECT c.shipping_country, p.category, dc.loyalty_tier,
       CAST(sum(p.rev) AS DECIMAL(38,0)) AS revenue, CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(p.n) AS BIGINT) AS items
FROM per_order p JOIN cur c ON c.order_id = p.order_id
LEFT JOIN dimc dc ON dc.customer_id = c.customer_id
GROUP BY 1, 2, 3"""

# ---------------------------------------------------------------- stored state

ORACLE["incremental_equals_batch"] = ORACLE["fact_order_items"]
ORACLE["rejects_permissive"] = """
SELECT 'staged' AS outcome, CAST(count(*) FILTER (WHERE o_orderpriority IS DISTINCT FROM '5-LOW') AS BIGINT) AS row_count
FROM orders
UNION ALL
SELECT 'value does not cast', CAST(count(*) AS BIGINT) FROM orders WHERE o_orderpriority = '5-LOW'"""
ORACLE["store_change_feed"] = ORACLE["net_changes_orders"]
ORACLE["store_item_changes"] = ORACLE["net_changes_items"]
ORACLE["reset_and_replay"] = ORACLE["fact_orders"]
ORACLE["compacted_read"] = ORACLE["stg_items_replace"]
ORACLE["stream_pipeline"] = ORACLE["fact_order_items"]

STATS = """stats AS (
  SELECT
    (SELECT count(*) FROM docs) AS n_orders,
    (SELECT count(*) FROM docs WHERE resent) AS n_resent,
    (SELECT count(*) FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey) AS n_lines,
    (SELECT count(*) FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey WHERE d.resent) AS n_del,
    (SELECT count(*) FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey
      WHERE d.resent AND li.l_linestatus = 'F') AS n_ins,
    (SELECT count(DISTINCT customer_id) FROM docs) AS n_cust,
    (SELECT count(DISTINCT customer_id) FROM docs WHERE resent) AS n_cust2,
    (SELECT count(DISTINCT li.product_id) FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey) AS n_prod,
    (SELECT count(DISTINCT li.product_id) FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey
      WHERE d.resent AND li.l_linestatus = 'F') AS n_prod2,
    (SELECT max(file1) FROM docs) AS f1,
    (SELECT max(file2) FROM docs WHERE resent) AS f2
)"""

_STEPS = [  # (batch, procedure, step, count expression, file)
    (0, "SP_RAW_TO_STG_ORDERS", "STREAM_READ_CREATE_TMP", "n_orders", "f1"),
    (0, "SP_RAW_TO_STG_ORDERS", "MERGE_STG_ORDERS", "n_orders", "f1"),
    (0, "SP_RAW_TO_STG_ORDERS", "DELETE_STG_ORDER_ITEMS", "0", "f1"),
    (0, "SP_RAW_TO_STG_ORDERS", "INSERT_STG_ORDER_ITEMS", "n_lines", "f1"),
    (0, "SP_STG_TO_CURATED", "STREAM_READ_ORDERS", "n_orders", "f1"),
    (0, "SP_STG_TO_CURATED", "STREAM_READ_ORDER_ITEMS", "n_lines", "f1"),
    (0, "SP_STG_TO_CURATED", "MERGE_DIM_CUSTOMER", "n_cust", "f1"),
    (0, "SP_STG_TO_CURATED", "MERGE_DIM_PRODUCT", "n_prod", "f1"),
    (0, "SP_STG_TO_CURATED", "MERGE_FACT_ORDERS", "n_orders", "f1"),
    (0, "SP_STG_TO_CURATED", "DELETE_FACT_ORDER_ITEMS", "0", "f1"),
    (0, "SP_STG_TO_CURATED", "INSERT_FACT_ORDER_ITEMS", "n_lines", "f1"),
    (1, "SP_RAW_TO_STG_ORDERS", "STREAM_READ_CREATE_TMP", "n_resent", "f2"),
    (1, "SP_RAW_TO_STG_ORDERS", "MERGE_STG_ORDERS", "n_resent", "f2"),
    (1, "SP_RAW_TO_STG_ORDERS", "DELETE_STG_ORDER_ITEMS", "n_del", "f2"),
    (1, "SP_RAW_TO_STG_ORDERS", "INSERT_STG_ORDER_ITEMS", "n_ins", "f2"),
    (1, "SP_STG_TO_CURATED", "STREAM_READ_ORDERS", "2 * n_resent", "f2"),
    (1, "SP_STG_TO_CURATED", "STREAM_READ_ORDER_ITEMS", "n_del + n_ins", "f2"),
    (1, "SP_STG_TO_CURATED", "MERGE_DIM_CUSTOMER", "n_cust2", "f2"),
    (1, "SP_STG_TO_CURATED", "MERGE_DIM_PRODUCT", "n_prod2", "f2"),
    (1, "SP_STG_TO_CURATED", "MERGE_FACT_ORDERS", "n_resent", "f2"),
    (1, "SP_STG_TO_CURATED", "DELETE_FACT_ORDER_ITEMS", "n_del", "f2"),
    (1, "SP_STG_TO_CURATED", "INSERT_FACT_ORDER_ITEMS", "n_ins", "f2"),
]

ORACLE["audit_steps"] = _with(DOCS, LINES, STATS) + "\nUNION ALL\n".join(
    f"SELECT CAST({b} AS BIGINT) AS batch_id, '{p}' AS procedure_name, '{s}' AS stage_step, "
    f"CAST({e} AS BIGINT) AS affected_rows, 'SUCCESS' AS status, {f} AS file_name FROM stats"
    for b, p, s, e, f in _STEPS)


def _summary(b: str, n: str, d: str, i: str, c: str, p: str, o: str) -> str:
    return (f"SELECT CAST({b} AS BIGINT) AS batch_id, CAST({n} AS BIGINT) AS stream_rows, "
            f"CAST({n} AS BIGINT) AS merged_rows, CAST({d} AS BIGINT) AS deleted_rows, "
            f"CAST({i} AS BIGINT) AS inserted_rows, "
            f"'latest=' || {n} || ', merged=' || {n} || ', deleted=' || {d} || ', inserted=' || {i} AS stage1_result, "
            f"'dim_customer=' || {c} || ', dim_product=' || {p} || ', fact_orders=' || {o} || "
            f"', items_deleted=' || {d} || ', items_inserted=' || {i} AS stage2_result FROM stats")


ORACLE["batch_summary"] = _with(DOCS, LINES, STATS) + _summary(
    "0", "n_orders", "0", "n_lines", "n_cust", "n_prod", "n_orders") + "\nUNION ALL\n" + _summary(
    "1", "n_resent", "n_del", "n_ins", "n_cust2", "n_prod2", "n_resent")

ORACLE["layer_counts"] = _with(DOCS, CUR, LINES, ITEMS2, STATS) + """
SELECT 'RAW' AS layer, 'raw_orders_json' AS object_name, CAST(n_orders + n_resent AS BIGINT) AS row_count FROM stats
UNION ALL SELECT 'STREAM', 'RAW_ORDERS_STREAM', CAST(0 AS BIGINT)
UNION ALL SELECT 'STAGED', 'stg_orders', CAST(n_orders AS BIGINT) FROM stats
UNION ALL SELECT 'STREAM', 'STG_ORDERS_STREAM', CAST(0 AS BIGINT)
UNION ALL SELECT 'STAGED', 'stg_order_items', CAST(count(*) AS BIGINT) FROM items2
UNION ALL SELECT 'STREAM', 'STG_ORDER_ITEMS_STREAM', CAST(0 AS BIGINT)
UNION ALL SELECT 'CURATED', 'dim_customer', CAST(n_cust AS BIGINT) FROM stats
UNION ALL SELECT 'CURATED', 'dim_product', CAST(n_prod AS BIGINT) FROM stats
UNION ALL SELECT 'CURATED', 'fact_orders', CAST(n_orders AS BIGINT) FROM stats
UNION ALL SELECT 'CURATED', 'fact_order_items', CAST(count(*) AS BIGINT) FROM items2"""

ORACLE["layer_counts_pending"] = _with(DOCS, LINES, STATS) + """
SELECT 'STREAM' AS layer, 'RAW_ORDERS_STREAM' AS object_name, CAST(n_resent AS BIGINT) AS row_count FROM stats
UNION ALL SELECT 'STREAM', 'STG_ORDERS_STREAM', CAST(0 AS BIGINT)
UNION ALL SELECT 'STREAM', 'STG_ORDER_ITEMS_STREAM', CAST(0 AS BIGINT)"""

ORACLE["failed_batch_audit"] = _with(DOCS, LINES, STATS) + "\nUNION ALL\n".join(
    [f"SELECT CAST(0 AS BIGINT) AS batch_id, '{s}' AS stage_step, 'SUCCESS' AS status, CAST({e} AS BIGINT) AS affected_rows FROM stats"
     for b, p, s, e, f in _STEPS if b == 0]
    + ["SELECT CAST(1 AS BIGINT), 'STREAM_READ_CREATE_TMP', 'SUCCESS', CAST(n_resent AS BIGINT) FROM stats",
       "SELECT CAST(1 AS BIGINT), 'MERGE_STG_ORDERS', 'FAILED', CAST(NULL AS BIGINT)"])

ORACLE["run_history_runs"] = _with(DOCS, LINES, STATS) + """
SELECT CAST(0 AS BIGINT) AS batch_id, 'batch:0' AS query_id, CAST(11 AS BIGINT) AS steps_done, CAST(n_orders AS BIGINT) AS stream_rows,
       CAST(0 AS BIGINT) AS rejected_rows, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS failed_step FROM stats
UNION ALL
SELECT CAST(1 AS BIGINT), 'batch:1', CAST(11 AS BIGINT), CAST(n_resent AS BIGINT), CAST(0 AS BIGINT), 'SUCCESS', NULL FROM stats"""

ORACLE["batch_then_stream"] = ORACLE["fact_order_items"]

MIXED = """mixed AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'lines' WHEN 'F' THEN 'twice' ELSE 'array' END AS kind,
         'orders_' || strftime(o_orderdate, '%Y%m') || '_' || printf('%05d', o_orderkey // 100000) || '.json' AS file
  FROM orders
)"""

ORACLE["multi_document_rejects"] = _with(MIXED) + """
SELECT kind, 'loaded' AS outcome, CAST(count(*) AS BIGINT) AS row_count FROM mixed WHERE kind <> 'twice' GROUP BY kind
UNION ALL
SELECT kind, 'malformed JSON', CAST(count(DISTINCT file) AS BIGINT) FROM mixed WHERE kind = 'twice' GROUP BY kind"""

ORACLE["load_history_rejects"] = _with(MIXED) + """
SELECT kind || '/' || file AS file_name, CAST(CASE WHEN kind = 'twice' THEN 0 ELSE count(*) END AS BIGINT) AS rows_loaded,
       CAST(CASE WHEN kind = 'twice' THEN 1 ELSE 0 END AS BIGINT) AS rows_rejected,
       CASE WHEN kind = 'twice' THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status
FROM mixed GROUP BY kind, file"""

ORACLE["json_lines_load"] = _with(DOCS) + """
SELECT customer_id, tier1 AS loyalty_tier, segment, order_date, order_id, payment_amount, payment_currency, payment_method,
       shipping_city, shipping_country, shipping_delivery_type, status1 AS status, CAST(NULL AS VARCHAR) AS reject_reason
FROM docs"""

ORACLE["nested_landing"] = _with(MIXED) + """
SELECT 'n/' || file AS file_name, CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS last_row FROM mixed GROUP BY file"""

ORACLE["file_listing"] = _with(DOCS) + "SELECT DISTINCT file1 AS file_name, TRUE AS has_rows FROM docs"

# a low-priority order always has items that are no array; an urgent one only has a bad quantity if it has a line
BAD_ITEMS = """bad AS (
  SELECT o_orderkey, (o_orderpriority IS NOT DISTINCT FROM '5-LOW')
         OR (o_orderpriority IS NOT DISTINCT FROM '1-URGENT'
             AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_quantity IS NOT NULL)) AS is_bad
  FROM orders
)"""
ORACLE["rejects_items"] = _with(BAD_ITEMS) + """
SELECT 'staged orders' AS outcome, CAST(count(*) FILTER (WHERE NOT is_bad) AS BIGINT) AS row_count FROM bad
UNION ALL
SELECT 'staged items', CAST(count(*) AS BIGINT) FROM lineitem JOIN bad ON o_orderkey = l_orderkey WHERE NOT is_bad
UNION ALL
SELECT 'value does not cast', CAST(count(*) FILTER (WHERE is_bad) AS BIGINT) FROM bad"""

G1, G2 = file_name("g1/"), file_name("g2/")
GROWING = f"""g AS (
  SELECT d.*, {G1} AS gfile1, {G2} AS gfile2, coalesce(d.status1 <> 'O', true) AS in1, coalesce(d.status1 IN ('P', 'O'), false) AS in2
  FROM docs d JOIN orders o ON o.o_orderkey = d.o_orderkey
), gi1 AS (
  SELECT g.order_id, g.order_date, li.product_id, li.category, li.quantity, li.unit_price
  FROM g JOIN lines li ON li.l_orderkey = g.o_orderkey WHERE g.in1 AND li.l_linestatus = 'F'
), gi2 AS (
  SELECT g.order_id, g.order_date, li.product_id, li.category, li.quantity, li.unit_price
  FROM g JOIN lines li ON li.l_orderkey = g.o_orderkey
  WHERE (g.in2 AND li.l_linestatus IS DISTINCT FROM 'F') OR (NOT g.in2 AND li.l_linestatus = 'F')
)"""
ORACLE["growing_merge_counts"] = _with(DOCS, LINES, GROWING) + """
SELECT CAST(count(*) FILTER (WHERE in2 AND NOT in1) AS BIGINT) AS inserted_rows, CAST(count(*) FILTER (WHERE in2 AND in1) AS BIGINT) AS updated_rows,
       CAST(count(*) FILTER (WHERE in2) AS BIGINT) AS merged_rows FROM g"""
ORACLE["growing_order_changes"] = _with(DOCS, LINES, GROWING) + """
SELECT order_id, status1 AS status, gfile1 AS file_name, 'DELETE' AS _action, TRUE AS _is_update FROM g WHERE in1 AND in2
UNION ALL
SELECT order_id, status1, gfile2, 'INSERT', in1 FROM g WHERE in2"""
ORACLE["growing_item_changes"] = _with(DOCS, LINES, GROWING) + """
SELECT *, 'DELETE' AS _action FROM (SELECT * FROM gi1 EXCEPT ALL SELECT * FROM gi2)
UNION ALL
SELECT *, 'INSERT' AS _action FROM (SELECT * FROM gi2 EXCEPT ALL SELECT * FROM gi1)"""
ORACLE["distinct_customers"] = _with(DOCS) + "SELECT DISTINCT customer_id, tier1 AS loyalty_tier, segment FROM docs"
ORACLE["landing_times"] = """
SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS order_id, CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS ordered_at FROM orders"""

# orders in files of 100,000 keys, numbered in key order
ORACLE["split_array_load"] = ORACLE["json_lines_rows"] = """
SELECT printf('keys_%05d.json', o_orderkey // 100000) AS file_name,
       row_number() OVER (PARTITION BY o_orderkey // 100000 ORDER BY o_orderkey) AS row_number,
       CAST(o_orderkey AS DECIMAL(38,0)) AS order_id,
       (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS item_count, CAST(NULL AS VARCHAR) AS reject_reason
FROM orders"""

ORACLE["change_stream_two_readers"] = _with(DOCS, LINES, GROWING, """images AS (
  SELECT 'orders' AS images, 0 AS batch_id, order_id, NULL::DECIMAL(38,0) AS product_id, NULL::DECIMAL(38,0) AS quantity, status1 AS status,
         'INSERT' AS action, FALSE AS is_update FROM g WHERE in1
  UNION ALL SELECT 'orders', 1, order_id, NULL, NULL, status1, 'DELETE', TRUE FROM g WHERE in1 AND in2
  UNION ALL SELECT 'orders', 1, order_id, NULL, NULL, status1, 'INSERT', in1 FROM g WHERE in2
  UNION ALL SELECT 'items', 0, order_id, product_id, quantity, NULL, 'INSERT', NULL FROM gi1
  UNION ALL SELECT 'items', 1, order_id, product_id, quantity, NULL, 'DELETE', NULL FROM gi1 JOIN g USING (order_id) WHERE in1 AND in2
  UNION ALL SELECT 'items', 1, order_id, product_id, quantity, NULL, 'INSERT', NULL FROM gi2 JOIN g USING (order_id) WHERE in2
)""") + """
SELECT reader, images, CAST(batch_id AS BIGINT) AS batch_id, order_id, product_id, quantity, status, action, is_update
FROM images, (VALUES ('often'), ('once')) AS r(reader)"""
ORACLE["replay_landing"] = ORACLE["fact_order_items"]
ORACLE["load_progress_counts"] = _with(MIXED) + """
SELECT CAST(rows AS BIGINT) AS landed, CAST(bad AS BIGINT) AS rejected, CAST(rows AS BIGINT) AS landing_rows, CAST(bad AS BIGINT) AS landing_rejects
FROM (SELECT count(*) FILTER (WHERE kind <> 'twice') + count(DISTINCT file) FILTER (WHERE kind = 'twice') AS rows,
             count(DISTINCT file) FILTER (WHERE kind = 'twice') AS bad FROM mixed)"""

ORACLE["insert_by_name"] = ORACLE["explode_items"]
ORACLE["insert_positional"] = _with(DOCS, LINES) + """
SELECT d.order_id, d.order_date, li.product_id, li.category, li.unit_price AS quantity, li.quantity AS unit_price, d.file1 AS file_name
FROM docs d JOIN lines li ON li.l_orderkey = d.o_orderkey"""
ORACLE["tied_order_versions"] = "SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS order_id, 'T' AS status FROM orders"
ORACLE["tied_items"] = _with(LINES) + """
SELECT CAST(l_orderkey AS DECIMAL(38,0)) AS order_id, product_id, quantity FROM lines
WHERE l_linestatus = 'F' AND l_orderkey IN (SELECT o_orderkey FROM orders)"""
# the latest document: greatest file name, then greatest place in it
ORACLE["tied_dim_customer"] = _with(DOCS) + f"""
SELECT customer_id, CASE WHEN late THEN tier1 ELSE {promote('tier1')} END AS loyalty_tier
FROM (SELECT d.*, d.o_orderkey % 2 = 0 AS late,
             row_number() OVER (PARTITION BY customer_id ORDER BY d.o_orderkey % 2, file1 DESC, d.o_orderkey DESC) AS rn
      FROM docs d WHERE customer_id IS NOT NULL)
WHERE rn = 1"""
ORACLE["clock_columns"] = """
SELECT o_orderstatus, CAST(1 AS BIGINT) AS clocks, CAST(1 AS BIGINT) AS second_clocks, TRUE AS whole_seconds, TRUE AS same_time
FROM orders GROUP BY o_orderstatus"""
