"""Test inputs: the raw tables of the warehouse, derived from the given tables by SQL that Spark and DuckDB both run.

`{orders}` and the like stand for the given tables. RAW holds the raw tables, EARLIER what a previous load held of them: other values and
fewer rows, so that merging the raw tables into it updates, inserts and keeps.
"""

from __future__ import annotations

from datetime import date, datetime

AS_OF = date(2001, 12, 1)
NOW = datetime(2001, 12, 1)
EARLIER_NOW = datetime(2001, 11, 1)

TABLES = ["supplier", "customer", "part", "orders", "lineitem", "events"]

RAW = {
    "companies": """
SELECT s_suppkey AS company_id, concat('30-', lpad(CAST(s_suppkey AS STRING), 8, '0'), '-9') AS cuit,
  s_name AS company_name, (s_suppkey % 3 = 0) AS is_supplier FROM {supplier}""",
    "end_customers": """
SELECT c_custkey AS customer_id, concat('DOC-', CAST(c_custkey AS STRING)) AS document_number, c_name AS full_name,
  CAST(make_date(1950 + CAST(c_custkey % 50 AS INT), 1 + CAST(c_custkey % 12 AS INT), 1 + CAST(c_custkey % 28 AS INT)) AS DATE) AS date_of_birth FROM {customer}""",
    "products": """
SELECT p_partkey AS product_id, p_partkey % 10 AS supplier_id, p_name AS product_name,
  CAST(p_retailprice AS DECIMAL(12,2)) AS default_price FROM {part}""",
    "orders": """
SELECT o_orderkey AS order_id, o_custkey % 10 AS company_id, o_custkey AS customer_id, o_orderdate AS order_timestamp FROM {orders}""",
    "order_items": """
SELECT (((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey) * 10 + rn - 1 AS order_item_id, l_orderkey AS order_id,
  l_partkey AS product_id,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -CAST(l_quantity AS INT)
       WHEN l_linenumber = 6 AND l_quantity = 13 THEN NULL ELSE CAST(l_quantity AS INT) END AS quantity,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                                   ORDER BY l_quantity, l_extendedprice, l_shipdate) AS rn FROM {lineitem}) t""",
    "weblogs": """
SELECT event_id AS log_id,
  CASE WHEN event_id % 97 = 0 THEN 'bad_ip_address' WHEN event_id % 101 = 0 THEN NULL
       ELSE concat('192.168.', CAST(user_id % 7 AS STRING), '.', CAST((user_id * 3 + event_id % 4) % 255 AS STRING)) END AS client_ip,
  CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN concat('guest', CAST(user_id AS STRING))
       WHEN 'view' THEN CASE WHEN event_id % 41 = 0 THEN 'custodian' ELSE concat('cust', CAST(user_id AS STRING)) END
       ELSE concat('cust', CAST(user_id AS STRING)) END AS username,
  ts AS request_time,
  CASE event_id % 5 WHEN 0 THEN 'Mozilla/5.0 (Windows NT 10.0)' WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU OS 14_0)'
       WHEN 2 THEN 'Mozilla/5.0 (iPad)' WHEN 3 THEN 'Mozilla/5.0 (iPad; CPU OS 14_0) MOBILE/15E148' ELSE NULL END AS user_agent FROM {events}""",
    "leads_csv": """
SELECT concat('L', CAST(c_custkey AS STRING)) AS lead_id, c_name AS full_name,
  CASE WHEN c_custkey % 10 = 0 THEN 'invalid_email' WHEN c_custkey % 37 = 0 THEN NULL ELSE concat('lead', CAST(c_custkey AS STRING), '@example.com') END AS email,
  CASE WHEN c_custkey % 23 = 0 THEN '   ' WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS company_name,
  CASE WHEN c_custkey % 31 = 0 THEN 'n/a' ELSE CAST(CAST(floor(c_acctbal / 100) AS INT) AS STRING) END AS lead_score,
  CASE WHEN c_custkey % 43 = 0 THEN 'not-a-date' ELSE concat('2001-', lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0'), ' 08:30:00') END AS acquired_at FROM {customer}""",
    "weblog_lines": """
SELECT 'access.log' AS source_file, event_id + 1 AS source_line_number,
  CASE WHEN event_id % 53 = 0 THEN concat('garbage line ', CAST(event_id AS STRING))
  ELSE concat('192.168.', CAST(user_id % 7 AS STRING), '.', CAST((user_id * 3 + event_id % 4) % 255 AS STRING), ' - ',
   CASE event_type WHEN 'signup' THEN '-' ELSE concat('cust', CAST(user_id AS STRING)) END, ' [',
   CASE WHEN event_id % 59 = 0 THEN 'bad time' ELSE concat(lpad(CAST(day(ts) AS STRING), 2, '0'), '/Jan/2024:', lpad(CAST(hour(ts) AS STRING), 2, '0'), ':', lpad(CAST(minute(ts) AS STRING), 2, '0'), ':00 +0200') END,
   '] "GET /p/', CAST(event_id % 20 AS STRING), ' HTTP/1.1" 200 ', CAST(event_id AS STRING), ' "-" "',
   CASE WHEN event_id % 5 = 4 THEN '-' ELSE 'Mozilla/5.0 (iPad)' END, '"') END AS raw_line FROM {events}""",
}

EARLIER = {
    "companies": """
SELECT company_id, cuit, 'old ' || company_name AS company_name, is_supplier FROM {src_companies} WHERE is_supplier""",
    "end_customers": """
SELECT customer_id, concat('OLD-', document_number) AS document_number, full_name, DATE '1900-01-01' AS date_of_birth
FROM {src_end_customers} WHERE date_of_birth < DATE '1985-01-01'""",
    "products": """
SELECT product_id, supplier_id + 100 AS supplier_id, 'old ' || product_name AS product_name, default_price
FROM {src_products} WHERE supplier_id < 7""",
    "orders": """
SELECT order_id, company_id, customer_id, order_timestamp FROM {src_orders} WHERE order_timestamp < TIMESTAMP_NTZ '2000-12-01 00:00:00'""",
    "order_items": """
SELECT order_item_id, order_id, product_id, quantity,
  CAST(CASE WHEN order_item_id % 50 < 10 THEN unit_price + 1 ELSE unit_price END AS DECIMAL(12,2)) AS unit_price FROM {src_order_items}""",
    "weblogs": """
SELECT log_id, client_ip, username, request_time, user_agent FROM {src_weblogs} WHERE request_time < TIMESTAMP_NTZ '2024-01-15 00:00:00'""",
    "leads_csv": """
SELECT lead_id, full_name, email, 'old ' || company_name AS company_name, '77' AS lead_score, acquired_at
FROM {src_leads_csv} WHERE acquired_at < '2001-07'""",
    "weblog_lines": """
SELECT source_file, source_line_number, raw_line FROM {src_weblog_lines} WHERE source_line_number <= 700 OR raw_line LIKE 'garbage%'""",
}

# Histories of many loads: every customer is a load, every order one of its batches, every order line a job of that batch and a change of
# one layer's state. The order of a batch's events is made total by the line's key.
HISTORY = {
    "batch_events": """
SELECT o_orderkey * 2 AS seq, o_orderkey AS batch_id, concat('load_', CAST(o_custkey AS STRING)) AS pipeline_name, 'RUNNING' AS status,
  o_orderdate AS event_time, CAST(NULL AS STRING) AS error_message FROM {orders}
UNION ALL
SELECT o_orderkey * 2 + 1, o_orderkey, concat('load_', CAST(o_custkey AS STRING)),
  CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' ELSE 'RUNNING' END, o_orderdate + INTERVAL '1' HOUR,
  CASE WHEN o_orderstatus = 'F' THEN concat(repeat('failed ', 40), o_orderpriority) END FROM {orders}""",
    "job_events": """
SELECT order_item_id * 2 AS seq, order_item_id AS job_run_id, order_id AS batch_id, concat('job_', CAST(product_id AS STRING)) AS job_name,
  'RUNNING' AS status, TIMESTAMP_NTZ '2001-01-01 00:00:00' AS event_time, CAST(NULL AS STRING) AS error_message FROM {src_order_items}
UNION ALL
SELECT order_item_id * 2 + 1, order_item_id, order_id, concat('job_', CAST(product_id AS STRING)),
  CASE WHEN quantity < 0 THEN 'FAILED' WHEN quantity IS NULL THEN 'RUNNING' ELSE 'SUCCESS' END, TIMESTAMP_NTZ '2001-01-01 00:10:00',
  CASE WHEN quantity < 0 THEN concat('quantity ', CAST(quantity AS STRING)) END FROM {src_order_items}""",
    "layer_events": """
SELECT i.order_item_id AS seq, concat('load_', CAST(o.customer_id AS STRING)) AS pipeline_name,
  CASE i.product_id % 3 WHEN 0 THEN 'bronze_ingestion_layer' WHEN 1 THEN 'silver_cleansing_layer' ELSE 'gold_star_schema_layer' END AS layer_name,
  CASE WHEN i.quantity > 25 THEN o.order_timestamp END AS last_watermark, i.order_id AS batch_id,
  CASE WHEN i.quantity < 0 THEN 'FAILED' WHEN i.quantity IS NULL OR i.quantity > 45 THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
  o.order_timestamp AS event_time
FROM {src_order_items} i JOIN {src_orders} o ON i.order_id = o.order_id""",
}

# The same rows where a line's key exceeds a long, as it does from 9.2 million orders on.
WIDE_RAW = {
    "order_items": RAW["order_items"].replace(
        "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey)", "CAST((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS DECIMAL(20,0))"
    )
}

# The same events where twice a line's key exceeds a long, as it does from 4.6 million orders on.
WIDE_HISTORY = {"job_events": HISTORY["job_events"].replace("order_item_id * 2", "CAST(order_item_id AS DECIMAL(20,0)) * 2")}
