"""The same results in plain SQL, for checking. Each entry of STEPS is one named step; a query uses the steps it names, and those they name."""

from __future__ import annotations

import re

from strata.plans import fixtures

_PLAIN = {t: t for t in fixtures.TABLES} | {f"src_{t}": f"src_{t}" for t in fixtures.RAW}


def _plain(sql: str) -> str:
    return sql.format(**_PLAIN).replace("TIMESTAMP_NTZ", "TIMESTAMP").strip()


STEPS: dict[str, str] = {f"src_{n}": _plain(t) for n, t in fixtures.RAW.items()}
STEPS |= {f"old_{n}": _plain(t) for n, t in fixtures.EARLIER.items()}
STEPS |= {f"log_{n}": _plain(t) for n, t in fixtures.HISTORY.items()}

# The address hash, as worked out in FIXTURES.md, section 4.
STEPS |= {
    "ips": "SELECT DISTINCT client_ip AS s FROM src_weblogs WHERE client_ip IS NOT NULL",
    "ks": """SELECT s, length(s) AS n,
  list_transform(range(0, length(s) // 4), lambda i: ascii(s[4*i+1]) + 256::HUGEINT * ascii(s[4*i+2]) + 65536::HUGEINT * ascii(s[4*i+3]) + 16777216::HUGEINT * ascii(s[4*i+4]))
  || list_transform(range(4 * (length(s) // 4), length(s)), lambda i: ascii(s[i+1])::HUGEINT) AS k FROM ips""",
    "m1": "SELECT s, n, list_transform(k, lambda x: (x * 3432918353) % 4294967296) AS k FROM ks",
    "m2": """SELECT s, n, list_transform(k, lambda x: (((x * 32768) % 4294967296 + x // 131072) * 461845907) % 4294967296) AS k FROM m1""",
    "h0": """SELECT s, n, list_reduce(list_prepend(42::HUGEINT, k), lambda h, x:
  (((xor(h, x) * 8192) % 4294967296 + xor(h, x) // 524288) * 5 + 3864292196) % 4294967296) AS h FROM m2""",
    "h1": "SELECT s, xor(h, n::HUGEINT) AS h FROM h0",
    "h2": "SELECT s, (xor(h, h // 65536) * 2246822507) % 4294967296 AS h FROM h1",
    "h3": "SELECT s, (xor(h, h // 8192) * 3266489909) % 4294967296 AS h FROM h2",
    "h4": "SELECT s, xor(h, h // 65536) AS h FROM h3",
    "ip_hash": "SELECT s AS client_ip, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS BIGINT) AS h FROM h4",
}

_PLACE = """['United States', 'India', 'Germany', 'Brazil', 'Japan', 'UK'][abs(coalesce(h, 42)) % 6 + 1] AS country,
  ['New York', 'Mumbai', 'Berlin', 'São Paulo', 'Tokyo', 'London'][abs(coalesce(h, 42)) % 6 + 1] AS city"""

_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"


def _lines(items: str, orders: str) -> str:
    return f"""SELECT i.order_item_id AS source_order_item_id, o.order_id AS source_order_id, o.company_id AS source_company_id,
  o.customer_id AS source_customer_id, i.product_id AS source_product_id, o.order_timestamp, i.quantity, i.unit_price,
  CAST(i.quantity * i.unit_price AS DECIMAL(18,2)) AS total_amount
FROM {items} i JOIN {orders} o ON i.order_id = o.order_id"""


def _web(weblogs: str) -> str:
    return f"""SELECT w.log_id AS source_log_id, w.client_ip, w.username, w.request_time, w.user_agent,
  CASE WHEN w.username LIKE 'cust%' THEN TRY_CAST(regexp_extract(w.username, 'cust([0-9]+)', 1) AS INTEGER) END AS mapped_customer_id,
  CASE WHEN w.user_agent ILIKE '%mobile%' THEN 'Mobile' WHEN w.user_agent ILIKE '%ipad%' THEN 'Tablet' ELSE 'Desktop' END AS device_type,
  {_PLACE}
FROM {weblogs} w LEFT JOIN ip_hash ON w.client_ip = ip_hash.client_ip"""


def _leads(leads: str) -> str:
    return f"""SELECT lead_id, full_name, email, company_name, TRY_CAST(lead_score AS INTEGER) AS lead_score,
  TRY_CAST(acquired_at AS TIMESTAMP) AS acquired_at FROM {leads}"""


STEPS |= {
    "lines": _lines("src_order_items", "src_orders"),
    "good_lines": "SELECT * FROM lines WHERE quantity >= 0 AND unit_price >= 0",
    "bad_lines": "SELECT * FROM lines WHERE quantity < 0 OR unit_price < 0",
    "web": _web("src_weblogs"),
    "good_web": "SELECT * FROM web WHERE client_ip <> 'bad_ip_address'",
    "bad_web": "SELECT * FROM web WHERE client_ip = 'bad_ip_address'",
    "leads": _leads("src_leads_csv"),
    "good_leads": "SELECT * FROM leads WHERE lead_score >= 0 AND email LIKE '%@%' AND company_name IS NOT NULL AND trim(company_name) <> ''",
    "bad_leads": "SELECT * FROM leads WHERE lead_score < 0 OR email NOT LIKE '%@%' OR company_name IS NULL OR trim(company_name) = ''",
    "customers": """SELECT customer_id AS source_customer_id, document_number, full_name, date_of_birth,
  date_sub('year', date_of_birth, DATE '2001-12-01') AS age FROM src_end_customers""",
    # Reject records.
    "rejects": """
SELECT 'B2B Sales' AS source_name, 'Negative Value' AS error_reason,
  concat('{"source_order_item_id":', source_order_item_id, ',"source_order_id":', source_order_id, ',"source_company_id":',
    source_company_id, ',"source_customer_id":', source_customer_id, ',"source_product_id":', source_product_id, ',"order_timestamp":"',
    strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S.%g'), '"', CASE WHEN quantity IS NOT NULL THEN concat(',"quantity":', quantity) END,
    CASE WHEN unit_price IS NOT NULL THEN concat(',"unit_price":', unit_price) END,
    CASE WHEN total_amount IS NOT NULL THEN concat(',"total_amount":', total_amount) END, ',"batch_id":1}') AS raw_record FROM bad_lines
UNION ALL
SELECT 'Weblogs', 'Invalid IP', concat('{"source_log_id":', source_log_id, ',"client_ip":"', client_ip, '"',
    CASE WHEN username IS NOT NULL THEN concat(',"username":"', username, '"') END, ',"request_time":"',
    strftime(request_time, '%Y-%m-%dT%H:%M:%S.%g'), '"',
    CASE WHEN user_agent IS NOT NULL THEN concat(',"user_agent":"', user_agent, '"') END, ',"batch_id":1',
    CASE WHEN mapped_customer_id IS NOT NULL THEN concat(',"mapped_customer_id":', mapped_customer_id) END,
    ',"device_type":"', device_type, '","country":"', country, '","city":"', city, '"}') FROM bad_web
UNION ALL
SELECT 'Marketing Leads', 'Invalid Email/Score/Company', concat('{"lead_id":"', lead_id, '","full_name":"', full_name, '"',
    CASE WHEN email IS NOT NULL THEN concat(',"email":"', email, '"') END,
    CASE WHEN company_name IS NOT NULL THEN concat(',"company_name":"', company_name, '"') END, ',"batch_id":1',
    CASE WHEN lead_score IS NOT NULL THEN concat(',"lead_score":', lead_score) END,
    CASE WHEN acquired_at IS NOT NULL THEN concat(',"acquired_at":"', strftime(acquired_at, '%Y-%m-%dT%H:%M:%S.%g'), '"') END, '}')
  FROM bad_leads""",
    # Star schema after one load of the raw tables.
    "d_company": """SELECT row_number() OVER (ORDER BY company_id) AS company_key, company_id AS source_company_id, cuit, company_name,
  is_supplier FROM src_companies""",
    "d_customer": """SELECT row_number() OVER (ORDER BY source_customer_id) AS customer_key, * FROM customers""",
    "d_product": """SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id AS source_product_id,
  supplier_id AS source_supplier_id, product_name, default_price FROM src_products""",
    "d_device": "SELECT row_number() OVER (ORDER BY device_type) AS device_key, device_type FROM (SELECT DISTINCT device_type FROM good_web) d",
    "d_geo": """SELECT row_number() OVER (ORDER BY client_ip) AS geo_key, client_ip AS ip_address, country, city
FROM (SELECT DISTINCT client_ip, country, city FROM good_web WHERE client_ip IS NOT NULL) g""",
    "d_date": f"""SELECT {_KEY.format('d')} AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS "year",
  CAST(quarter(d) AS INTEGER) AS "quarter", CAST(month(d) AS INTEGER) AS "month", monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS "day"
FROM (SELECT unnest(generate_series(DATE '1999-12-01', DATE '2002-12-01', INTERVAL '1' DAY)) AS d) days""",
    "sales_rows": f"""SELECT l.source_order_item_id, l.source_order_id, {_KEY.format('l.order_timestamp')} AS date_key, c.company_key,
  u.customer_key, p.product_key, l.quantity, l.unit_price, l.total_amount
FROM good_lines l JOIN d_company c ON l.source_company_id = c.source_company_id
JOIN d_customer u ON l.source_customer_id = u.source_customer_id JOIN d_product p ON l.source_product_id = p.source_product_id""",
    "web_rows": f"""SELECT w.source_log_id, {_KEY.format('w.request_time')} AS date_key, g.geo_key, d.device_key, u.customer_key,
  w.request_time FROM good_web w JOIN d_geo g ON w.client_ip = g.ip_address JOIN d_device d ON w.device_type = d.device_type
LEFT JOIN d_customer u ON w.mapped_customer_id = u.source_customer_id""",
    "lead_rows": f"""SELECT lead_id AS source_lead_id, {_KEY.format('acquired_at')} AS date_key, company_name, lead_score FROM good_leads""",
    # What the earlier load left.
    "old_customers": """SELECT customer_id AS source_customer_id, document_number, full_name, date_of_birth,
  date_sub('year', date_of_birth, DATE '2001-12-01') AS age FROM old_end_customers""",
    "old_good_lines": f"SELECT * FROM ({_lines('old_order_items', 'old_orders')}) l WHERE quantity >= 0 AND unit_price >= 0",
    "old_good_web": f"SELECT * FROM ({_web('old_weblogs')}) w WHERE client_ip <> 'bad_ip_address'",
    "old_lead_rows": f"""SELECT lead_id AS source_lead_id, {_KEY.format('acquired_at')} AS date_key, company_name, lead_score
FROM ({_leads('old_leads_csv')}) l WHERE lead_score >= 0 AND email LIKE '%@%' AND trim(company_name) <> ''""",
    "old_sales_rows": """SELECT r.* REPLACE (o.quantity AS quantity, o.unit_price AS unit_price, o.total_amount AS total_amount)
FROM sales_rows r JOIN old_good_lines o ON r.source_order_item_id = o.source_order_item_id""",
    "d_geo_old": """SELECT row_number() OVER (ORDER BY client_ip) AS geo_key, client_ip AS ip_address, 'Nowhere' AS country, city
FROM (SELECT DISTINCT client_ip, city FROM old_good_web) g""",
    # Reports.
    "customer_country": """SELECT customer_key, country, count(*) AS logins FROM web_rows JOIN d_geo USING (geo_key)
GROUP BY customer_key, country""",
    "country_logins": "SELECT country, CAST(sum(logins) AS BIGINT) AS logins FROM customer_country GROUP BY country",
    "best_country": "SELECT country, logins FROM country_logins ORDER BY logins DESC, country LIMIT 1",
    "home_country": """SELECT customer_key, country FROM (SELECT customer_key, country,
  row_number() OVER (PARTITION BY customer_key ORDER BY logins DESC, country) AS n FROM customer_country WHERE customer_key IS NOT NULL) r
WHERE n = 1""",
    "product_country": """SELECT s.source_order_item_id, p.product_name, h.country, s.quantity, s.total_amount FROM sales_rows s
JOIN d_product p ON s.product_key = p.product_key JOIN home_country h ON s.customer_key = h.customer_key""",
    "device_logins": "SELECT device_type, count(*) AS total_logins FROM web_rows JOIN d_device USING (device_key) GROUP BY device_type",
    "product_sums": """SELECT country, product_name, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  CAST(sum(total_amount) AS DECIMAL(14,2)) AS total_revenue FROM product_country GROUP BY country, product_name""",
    "best_products": """SELECT CAST(row_number() OVER (ORDER BY total_units_sold DESC NULLS FIRST, product_name DESC NULLS FIRST) AS INTEGER) AS rank_no,
  country, product_name, total_units_sold, total_revenue FROM product_sums WHERE country IN (SELECT country FROM best_country)""",
    "best_devices": """SELECT CAST(row_number() OVER (ORDER BY total_logins DESC, device_type DESC) AS INTEGER) AS rank_no, device_type, total_logins
FROM device_logins ORDER BY rank_no LIMIT 5""",
    "dated": "SELECT s.*, d.full_date, d.year, d.month, d.month_name FROM sales_rows s JOIN d_date d ON s.date_key = d.date_key",
    "months": """SELECT CAST(date_trunc('month', full_date) AS DATE) AS month_start, year, month, month_name,
  count(DISTINCT source_order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
  CAST(sum(total_amount) AS DECIMAL(14,2)) AS monthly_revenue FROM dated WHERE full_date >= DATE '2000-12-01' GROUP BY ALL""",
    # Load history.
    "layer_now": """SELECT pipeline_name, layer_name,
  arg_max(last_watermark, seq) FILTER (WHERE last_watermark IS NOT NULL) AS last_watermark, arg_max(batch_id, seq) AS last_batch_id,
  arg_max(status, seq) AS status, arg_max(event_time, seq) AS updated_at
FROM (SELECT seq, pipeline_name, layer_name, last_watermark, batch_id, status, event_time FROM log_layer_events
  UNION ALL SELECT DISTINCT -1, pipeline_name, layer, CAST(NULL AS TIMESTAMP), 0, 'PENDING', CAST(NULL AS TIMESTAMP) FROM log_layer_events,
    (VALUES ('bronze_ingestion_layer'), ('silver_cleansing_layer'), ('gold_star_schema_layer')) l(layer)) e
GROUP BY pipeline_name, layer_name""",
    "batch_now": """SELECT batch_id, pipeline_name, status, started_at, CASE WHEN status <> 'RUNNING' THEN event_time END AS finished_at,
  CASE WHEN status = 'FAILED' THEN substring(error_message, 1, 255) END AS error_message
FROM (SELECT *, min(event_time) OVER (PARTITION BY batch_id) AS started_at, row_number() OVER (PARTITION BY batch_id ORDER BY seq DESC) AS n
  FROM log_batch_events) e WHERE n = 1""",
}

_NAME = re.compile("|".join(rf"\b{name}\b" for name in sorted(STEPS, key=len, reverse=True)))


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in _NAME.findall(sql):
        if name not in found and STEPS[name] is not sql:
            _needed(STEPS[name], found)
            found[name] = None


def query(sql: str) -> str:
    """`sql` after the steps it needs, in order."""
    found: dict[str, None] = {}
    _needed(sql, found)
    if not found:
        return sql
    steps = ",\n".join(f"{name} AS (\n{STEPS[name]}\n)" for name in found)
    return f"WITH {steps}\n{sql}"
