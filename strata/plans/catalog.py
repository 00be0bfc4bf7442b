"""Every operator as a query over the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from strata import fixed, schemas
from strata.functions import city, country, date_key, device_type, mapped_customer
from strata.operators import conform, merge, numbering, quality, spans, star
from strata.plans import audit, load, oracle, reports
from strata.plans.fixtures import AS_OF, NOW
from strata.plans.inputs import LINES_PER_FILE, Inputs, inputs
from strata.session import materialize, scratch_path
from strata.sources import files, jdbc, tables
from strata.streaming import weblogs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    """Register a query that takes `Inputs`, and its SQL."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle.query(sql)
        return build

    return register


# --- Sources and sinks -------------------------------------------------------------------------------------------------------------


@_query("S3_csv_leads", "SELECT * FROM src_leads_csv")
def _(i: Inputs):
    """Some files with the columns in another order and case, and one column more."""
    path = scratch_path(i.spark, "leads")
    number = F.expr("CAST(substring(lead_id, 2) AS BIGINT)")
    leads, exact = i.raw("leads_csv"), {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    leads.filter(number % 2 == 0).write.options(**exact).csv(f"{path}/as_is")
    turned = [F.col(c).alias(c.upper()) for c in reversed(leads.columns)]
    leads.filter(number % 2 == 1).select(F.lit("x").alias("note"), *turned).write.options(**exact).csv(f"{path}/turned")
    return files.read_leads(i.spark, path)


PARSED = """SELECT raw_line, source_line_number,
  CASE WHEN ok THEN regexp_extract(raw_line, '^([^ ]+) - ', 1) END AS client_ip,
  CASE WHEN ok THEN nullif(regexp_extract(raw_line, ' - ([^ ]+) \\[', 1), '-') END AS username,
  CASE WHEN ok AND raw_line NOT LIKE '%[bad time]%' THEN
    strptime(regexp_extract(raw_line, '\\[([^ ]+) ', 1), '%d/%b/%Y:%H:%M:%S') - INTERVAL '2' HOUR END AS request_time,
  CASE WHEN ok THEN nullif(regexp_extract(raw_line, '"-" "(.*)"$', 1), '-') END AS user_agent
FROM (SELECT *, raw_line NOT LIKE 'garbage%' AS ok FROM src_weblog_lines) l"""


@_query("S4_weblog_parse", f"SELECT raw_line, client_ip, username, request_time, user_agent FROM ({PARSED}) p")
def _(i: Inputs):
    return files.parse_weblogs(i.raw("weblog_lines").select("raw_line"))


def _file_number(path: str):
    return F.regexp_extract(path, r"chunk=(\d+)", 1).cast("bigint")


FILE_LINES = f"""SELECT raw_line, (source_line_number - 1) // {LINES_PER_FILE["weblog_lines"]} AS file_no,
  row_number() OVER (PARTITION BY (source_line_number - 1) // {LINES_PER_FILE["weblog_lines"]} ORDER BY source_line_number) AS line_no"""


@_query("S5_line_numbers", f"{FILE_LINES} FROM src_weblog_lines")
def _(i: Inputs):
    lines = numbering.with_line_numbers(files.read_lines(i.spark, i.log_dir))
    return lines.select("raw_line", _file_number("source_file").alias("file_no"), F.col("source_line_number").alias("line_no"))


@_query("S6_full_refresh", "SELECT *, CAST(2 AS BIGINT) AS batch_id FROM src_order_items")
def _(i: Inputs):
    path = scratch_path(i.spark, "full")
    files.write_full(i.bronze("order_items", 1), path, "batch_id")
    files.write_full(i.bronze("order_items", 2), path, "batch_id")
    return i.spark.read.schema(schemas.BRONZE["order_items"]).parquet(path)


@_query("S7_overwrite", "SELECT product_id AS source_product_id, supplier_id AS source_supplier_id, product_name, default_price, CAST(2 AS BIGINT) AS batch_id FROM src_products")
def _(i: Inputs):
    path = scratch_path(i.spark, "silver")
    files.write_full(conform.products(i.bronze_earlier("products")), path)
    files.write_full(conform.products(i.bronze("products", 2)), path)
    return i.spark.read.schema(schemas.SILVER["products"]).parquet(path)


@_query(
    "S8_dlq_append",
    """SELECT b.batch_id, r.source_name, r.error_reason, count(*) AS records
FROM rejects r JOIN (VALUES (CAST(1 AS BIGINT)), (CAST(3 AS BIGINT))) b(batch_id) ON r.source_name = 'Weblogs' OR b.batch_id = 1 GROUP BY ALL""",
)
def _(i: Inputs):
    path = scratch_path(i.spark, "quarantine")
    bad_web = quality.split(i.web(2), quality.weblog_rule())[1]
    later = {n: quality.quarantine(bad_web, fixed.WEBLOG_SOURCE, fixed.WEBLOG_REASON, n) for n in (2, 3)}
    none = later[2].filter(F.lit(False))
    for rejects, batch_id in [(i.rejects(), 1), (later[2], 2), (later[3], 3), (i.rejects(), 1), (none, 2)]:
        files.append_quarantine(rejects, path, batch_id)
    kept = files.read_quarantine(i.spark, path)
    return kept.groupBy("batch_id", "source_name", "error_reason").agg(F.count("*").alias("records"))


@_query("S10_schema_probe", "SELECT *, CAST(3 AS BIGINT) AS batch_id FROM src_orders")
def _(i: Inputs):
    """The raw orders brought to the schema of a table that is already there."""
    path = scratch_path(i.spark, "probed")
    files.write_full(i.bronze_earlier("orders"), path)
    unordered = i.bronze("orders", 3).select(*[F.col(c).cast("string").alias(c.upper()) for c in reversed(schemas.BRONZE["orders"].names)])
    return conform.align_schema(unordered, files.table_schema(i.spark, path))


@_query("S2_quantile_ranges", "SELECT order_id, order_item_id, product_id, quantity, unit_price FROM src_order_items")
def _(i: Inputs):
    """Order items read by ranges of a key of two columns, as a database would be; every row comes once. They are written first, so
    that a range reads rows, and not each of them makes the whole table again."""
    items = materialize(i.raw("order_items"), "order_items")
    ranges = jdbc.key_ranges(items, ["order_id", "order_item_id"], 16)
    parts = [items.filter(F.expr(r)) for r in ranges]
    return reduce(DataFrame.unionByName, parts).select("order_id", "order_item_id", "product_id", "quantity", "unit_price")


@_query(
    "S11_report_read",
    """SELECT * FROM (SELECT 'devices' AS report, rank_no AS position, device_type AS label, total_logins AS amount FROM best_devices)
UNION ALL (SELECT 'products', rank_no, product_name, total_units_sold FROM best_products ORDER BY rank_no LIMIT 5)
UNION ALL (SELECT * FROM (SELECT 'months', CAST(row_number() OVER (ORDER BY month_start DESC) AS INTEGER) AS p, month_name, total_items_sold FROM months) ORDER BY p LIMIT 5)""",
)
def _(i: Inputs):
    devices = reports.report_top(_top_devices(i), ["rank_no"])
    products = reports.report_top(_top_products(i), ["rank_no"])
    months = reports.report_top(_months(i), [F.desc("month_start")])
    # At most five rows, so one window is enough to number them.
    months = months.withColumn("rank_no", F.row_number().over(Window.orderBy(F.desc("month_start"))))

    def rows(df, report, label, amount):
        return df.select(
            F.lit(report).alias("report"), F.col("rank_no").alias("position"), F.col(label).alias("label"), F.col(amount).alias("amount")
        )

    parts = [
        rows(devices, "devices", "device_type", "total_logins"),
        rows(products, "products", "product_name", "total_units_sold"),
        rows(months, "months", "month_name", "total_items_sold"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _streamed_log(i: Inputs) -> DataFrame:
    """The log arrives in two parts; the stream runs after each, and once more without news."""
    source, target, checkpoint = (scratch_path(i.spark, label) for label in ("arriving", "weblogs", "stream"))
    i.write_log(source, first_file_only=True)
    weblogs.stream_weblogs(i.spark, source, target, checkpoint, NOW)
    i.write_log(source)
    for _ in range(2):
        weblogs.stream_weblogs(i.spark, source, target, checkpoint, NOW)
    return tables.read_table(i.spark, target, schemas.WEBLOG_ROWS)


@_query(
    "S12_log_ids",
    f"""SELECT raw_line, row_number() OVER (ORDER BY (source_line_number - 1) // {LINES_PER_FILE["weblog_lines"]} > 0,
  CAST((source_line_number - 1) // {LINES_PER_FILE["weblog_lines"]} AS VARCHAR), source_line_number) AS log_id,
  client_ip, username, request_time, user_agent, CAST(5 AS BIGINT) AS batch_id FROM ({PARSED}) p""",
)
def _(i: Inputs):
    """Loaded log lines as the source of the weblogs table: ids in the order of arrival, then of file and line."""
    rows = conform.stamp_batch(_streamed_log(i), 5)
    return conform.align_schema(rows, schemas.BRONZE["weblogs"]).join(
        rows.select("log_id", "raw_line"), "log_id"
    ).select("raw_line", "log_id", "client_ip", "username", "request_time", "user_agent", "batch_id")


@_query(
    "S12_weblog_incremental",
    f"""{FILE_LINES}, client_ip, username, request_time, user_agent FROM ({PARSED}) p""",
)
def _(i: Inputs):
    loaded = _streamed_log(i)
    return loaded.select(
        "raw_line", _file_number("source_file").alias("file_no"), F.col("source_line_number").alias("line_no"),
        "client_ip", "username", "request_time", "user_agent",
    )


# --- Projections and filters -------------------------------------------------------------------------------------------------------


@_query("P1_stamp_batch", "SELECT *, CAST(7 AS BIGINT) AS batch_id FROM src_orders")
def _(i: Inputs):
    return conform.stamp_batch(i.raw("orders"), 7)


@_query(
    "P2_lineage_cols",
    f"""SELECT *, 'manual_upload' AS source_file,
  row_number() OVER (PARTITION BY CAST(substring(lead_id, 2) AS BIGINT) // {LINES_PER_FILE["leads_csv"]} ORDER BY CAST(substring(lead_id, 2) AS BIGINT)) AS source_line_number,
  md5(concat_ws('||', lead_id, full_name, email, company_name, lead_score, acquired_at)) AS row_hash,
  TIMESTAMP '2001-12-01 00:00:00' AS ingested_at, false AS is_processed FROM src_leads_csv""",
)
def _(i: Inputs):
    return conform.add_lineage(files.read_leads(i.spark, i.leads_dir), NOW)


@_query(
    "P3_align_schema",
    """SELECT order_item_id AS source_order_item_id, order_id AS source_order_id, product_id AS source_product_id,
  CAST(quantity AS BIGINT) AS "QUANTITY", CAST(1 AS INTEGER) AS batch_id FROM src_order_items""",
)
def _(i: Inputs):
    target = StructType(
        [
            StructField("source_order_item_id", LongType()),
            StructField("source_order_id", LongType()),
            StructField("source_product_id", LongType()),
            StructField("QUANTITY", LongType()),
            StructField("batch_id", IntegerType()),
            StructField("no_such_thing", LongType()),
        ]
    )
    return conform.align_schema(i.bronze("order_items"), target, "alias")


@_query("P4_resolve_column", "SELECT order_id, company_id, customer_id FROM src_orders")
def _(i: Inputs):
    drifted = i.raw("orders").withColumnsRenamed({"order_id": "Source_Order_ID", "company_id": "COMPANY_ID"})
    names = ["order_id", "company_id", "customer_id"]
    return drifted.select(*[F.col(conform.resolve_column(drifted, [f"source_{n}", n])).alias(n) for n in names])


@_query("P5_conform_companies", "SELECT company_id AS source_company_id, cuit, company_name, is_supplier, CAST(1 AS BIGINT) AS batch_id FROM src_companies")
def _(i: Inputs):
    return conform.companies(i.bronze("companies"))


@_query("P6_conform_customers", "SELECT *, CAST(1 AS BIGINT) AS batch_id FROM customers")
def _(i: Inputs):
    return conform.customers(i.bronze("end_customers"), AS_OF)


@_query("P7_conform_products", "SELECT product_id AS source_product_id, supplier_id AS source_supplier_id, product_name, default_price, CAST(1 AS BIGINT) AS batch_id FROM src_products")
def _(i: Inputs):
    return conform.products(i.bronze("products"))


@_query("P8_line_amount", "SELECT order_item_id, CAST(quantity * unit_price AS DECIMAL(18,2)) AS total_amount FROM src_order_items")
def _(i: Inputs):
    amount = conform.line_amount(F.col("quantity"), F.col("unit_price"))
    return i.raw("order_items").select("order_item_id", amount.alias("total_amount"))


@_query("P9_customer_from_user", "SELECT source_log_id, username, mapped_customer_id FROM web")
def _(i: Inputs):
    return i.raw("weblogs").select(
        F.col("log_id").alias("source_log_id"), "username", mapped_customer(F.col("username")).alias("mapped_customer_id")
    )


@_query("P10_device_type", "SELECT source_log_id, user_agent, device_type FROM web")
def _(i: Inputs):
    return i.raw("weblogs").select(
        F.col("log_id").alias("source_log_id"), "user_agent", device_type(F.col("user_agent")).alias("device_type")
    )


@_query("P11_geo_from_ip", "SELECT source_log_id, client_ip, country, city FROM web")
def _(i: Inputs):
    ip = F.col("client_ip")
    return i.raw("weblogs").select(
        F.col("log_id").alias("source_log_id"), "client_ip", country(ip).alias("country"), city(ip).alias("city")
    )


@_query("P12_lead_types", "SELECT *, CAST(1 AS BIGINT) AS batch_id FROM leads")
def _(i: Inputs):
    return i.leads()


@_query("P13_batch_filter", "SELECT *, CAST(2 AS BIGINT) AS batch_id FROM src_orders")
def _(i: Inputs):
    path = scratch_path(i.spark, "batches")
    both = i.bronze_earlier("orders").unionByName(i.bronze("orders", 2))
    files.write_full(both, path, "batch_id")
    return conform.for_batch(i.spark.read.schema(schemas.BRONZE["orders"]).parquet(path), 2)


MARKED = [datetime(1996, 1, 1), datetime(1999, 6, 30, 12)]


@_query(
    "P13_beyond_mark",
    """SELECT 'orders' AS "table", order_id AS id, CAST(2 AS BIGINT) AS batch_id, TIMESTAMP '1999-06-30 12:00:00' AS mark FROM src_orders
WHERE order_timestamp > TIMESTAMP '1996-01-01' AND order_timestamp <= TIMESTAMP '1999-06-30 12:00:00'
UNION ALL SELECT 'order_items', order_item_id, 2, TIMESTAMP '1999-06-30 12:00:00' FROM src_order_items JOIN src_orders USING (order_id)
WHERE order_timestamp > TIMESTAMP '1996-01-01' AND order_timestamp <= TIMESTAMP '1999-06-30 12:00:00'""",
)
def _(i: Inputs):
    """The second of two loads with marks: orders after the mark that the first has committed, and their items."""
    w = load.Warehouse(i.spark, scratch_path(i.spark, "marked"))
    sources = {t: partial(i.raw, t) for t in ("orders", "order_items")}
    for batch_id, until in enumerate(MARKED, 1):
        after = w.committed_mark("marked")
        copy = partial(load.load_bronze, w, sources, batch_id, until, "exact", load.BY_TIME, after, tuple(sources))
        load.run_layer(w, "marked", batch_id, fixed.BRONZE, copy, until)
    mark = F.lit(str(w.committed_mark("marked"))).cast("timestamp_ntz").alias("mark")
    taken = [("orders", "order_id"), ("order_items", "order_item_id")]
    return reduce(
        DataFrame.unionByName,
        [w.bronze(t, 2).select(F.lit(t).alias("table"), F.col(key).alias("id"), "batch_id", mark) for t, key in taken],
    )


@_query("P14_date_key", "SELECT order_id, CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS date_key FROM src_orders")
def _(i: Inputs):
    return i.raw("orders").select("order_id", date_key(F.col("order_timestamp")).alias("date_key"))


@_query("P15_rolling_year", "SELECT order_id, CAST(order_timestamp AS DATE) AS full_date FROM src_orders WHERE CAST(order_timestamp AS DATE) >= DATE '2000-12-01'")
def _(i: Inputs):
    dated = i.raw("orders").select("order_id", F.col("order_timestamp").cast("date").alias("full_date"))
    return conform.since(dated, "full_date", AS_OF, 12)


# --- Quality -----------------------------------------------------------------------------------------------------------------------


def _verdicts(good: str, bad: str, every: str, key: str) -> str:
    return f"""SELECT a.{key}, CASE WHEN b.{key} IS NOT NULL THEN 'bad' WHEN g.{key} IS NOT NULL THEN 'good' ELSE 'undecided' END AS verdict
FROM {every} a LEFT JOIN {good} g ON a.{key} = g.{key} LEFT JOIN {bad} b ON a.{key} = b.{key}"""


@_query("Q1_sales_rule", _verdicts("good_lines", "bad_lines", "lines", "source_order_item_id"))
def _(i: Inputs):
    return quality.with_verdict(i.lines(), quality.sales_rule()).select("source_order_item_id", "verdict")


@_query("Q2_weblog_rule", _verdicts("good_web", "bad_web", "web", "source_log_id"))
def _(i: Inputs):
    return quality.with_verdict(i.web(), quality.weblog_rule()).select("source_log_id", "verdict")


@_query("Q3_lead_rule", _verdicts("good_leads", "bad_leads", "leads", "lead_id"))
def _(i: Inputs):
    return quality.with_verdict(i.leads(), quality.lead_rule()).select("lead_id", "verdict")


@_query(
    "Q4_quarantine_rows",
    "SELECT CAST(1 AS BIGINT) AS batch_id, 'daily_load' AS job_name, source_name, error_reason, raw_record FROM rejects WHERE source_name = 'B2B Sales'",
)
def _(i: Inputs):
    bad = quality.split(i.lines(), quality.sales_rule())[1]
    return quality.quarantine(bad, fixed.SALES_SOURCE, fixed.SALES_REASON, 1)


@_query(
    "Q4_quarantine_fields",
    """SELECT source_name, CAST(json_extract_string(raw_record, '$.source_order_item_id') AS BIGINT) AS source_order_item_id,
  CAST(json_extract_string(raw_record, '$.quantity') AS INTEGER) AS quantity, CAST(json_extract_string(raw_record, '$.unit_price') AS DECIMAL(12,2)) AS unit_price,
  CAST(json_extract_string(raw_record, '$.source_log_id') AS BIGINT) AS source_log_id, json_extract_string(raw_record, '$.client_ip') AS client_ip,
  json_extract_string(raw_record, '$.lead_id') AS lead_id, CAST(json_extract_string(raw_record, '$.lead_score') AS INTEGER) AS lead_score,
  json_extract_string(raw_record, '$.email') AS email FROM rejects
UNION ALL SELECT 'torn', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
)
def _(i: Inputs):
    """Fields of the rejected rows of all three sources, out of written records, and of a record whose text is cut off."""
    path = scratch_path(i.spark, "quarantine")
    torn = i.spark.range(1).select(
        F.lit(1).cast("bigint").alias("batch_id"), F.lit("daily_load").alias("job_name"), F.lit("torn").alias("source_name"),
        F.lit("").alias("error_reason"), F.lit('{"source_order_item_id":1,"quan').alias("raw_record"),
    )
    files.append_quarantine(i.rejects().unionByName(torn), path, 1)
    fields = StructType.fromDDL(
        "source_order_item_id long, quantity int, unit_price decimal(12,2), source_log_id long, client_ip string, lead_id string, lead_score int, email string"
    )
    found = quality.rejected_fields(files.read_quarantine(i.spark, path, parsed=True), fields)
    return found.select("source_name", *fields.names)


@_query(
    "Q6_reject_values",
    """SELECT source_name, json_extract_string(raw_record, '$.quantity') AS quantity, count(*) AS rejected FROM rejects GROUP BY ALL""",
)
def _(i: Inputs):
    """Rejected rows by the value of a field that only one source has."""
    return quality.reject_reasons(i.rejects().withColumn("record", F.try_parse_json("raw_record")), "quantity")


UNION_SQL = "SELECT CAST(1 AS BIGINT) AS batch_id, 'daily_load' AS job_name, source_name, error_reason, raw_record FROM rejects"


@_query("Q5_quarantine_union", UNION_SQL)
def _(i: Inputs):
    return i.rejects()


@_query("U1_union", "SELECT source_name, count(*) AS records, CAST(sum(length(raw_record)) AS BIGINT) AS characters FROM rejects GROUP BY source_name")
def _(i: Inputs):
    return i.rejects().groupBy("source_name").agg(F.count("*").alias("records"), F.sum(F.length("raw_record")).alias("characters"))


@_query("Q6_reject_counts", "SELECT source_name, count(*) AS rejected FROM rejects GROUP BY ROLLUP (source_name)")
def _(i: Inputs):
    return quality.reject_counts(i.rejects())


@_query(
    "Q7_undecided_rows",
    """SELECT 'sales' AS source, CAST(source_order_item_id AS VARCHAR) AS id FROM lines WHERE (quantity < 0 OR unit_price < 0) IS NOT TRUE AND (quantity >= 0 AND unit_price >= 0) IS NOT TRUE
UNION ALL SELECT 'weblogs', CAST(source_log_id AS VARCHAR) FROM web WHERE client_ip IS NULL
UNION ALL SELECT 'leads', lead_id FROM leads WHERE lead_id NOT IN (SELECT lead_id FROM good_leads) AND lead_id NOT IN (SELECT lead_id FROM bad_leads)""",
)
def _(i: Inputs):
    sets = [
        ("sales", i.lines(), quality.sales_rule(), "source_order_item_id"),
        ("weblogs", i.web(), quality.weblog_rule(), "source_log_id"),
        ("leads", i.leads(), quality.lead_rule(), "lead_id"),
    ]
    parts = [
        quality.split(df, rule)[2].select(F.lit(name).alias("source"), F.col(key).cast("string").alias("id"))
        for name, df, rule, key in sets
    ]
    return reduce(DataFrame.unionByName, parts)


# --- Joins -------------------------------------------------------------------------------------------------------------------------


@_query("J1_sales_lines", "SELECT *, CAST(1 AS BIGINT) AS batch_id FROM lines")
def _(i: Inputs):
    return i.lines()


@_query("J2_fact_sales_lookup", "SELECT *, CAST(1 AS BIGINT) AS etl_batch_id FROM sales_rows")
def _(i: Inputs):
    return star.fact_sales_lookup(i.good_lines(), i.gold("dim_company"), i.gold("dim_customer"), i.gold("dim_product"))


@_query("J3_fact_web_lookup", "SELECT *, CAST(1 AS BIGINT) AS etl_batch_id FROM web_rows")
def _(i: Inputs):
    return star.fact_web_lookup(i.good_web(), i.gold("dim_geo"), i.gold("dim_device"), i.gold("dim_customer"))


@_query("J4_web_device", "SELECT source_log_id, date_key, device_type FROM web_rows JOIN d_device USING (device_key)")
def _(i: Inputs):
    joined = reports.web_device(i.gold("fact_web_activity"), i.gold("dim_device"))
    return joined.select("source_log_id", "date_key", "device_type")


@_query("J5_web_geo", "SELECT source_log_id, customer_key, ip_address, country, city FROM web_rows JOIN d_geo USING (geo_key)")
def _(i: Inputs):
    joined = reports.web_geo(i.gold("fact_web_activity"), i.gold("dim_geo"))
    return joined.select("source_log_id", "customer_key", "ip_address", "country", "city")


@_query("J6_sales_product_country", "SELECT * FROM product_country")
def _(i: Inputs):
    joined = reports.sales_product_country(i.gold("fact_sales"), i.gold("dim_product"), reports.held_customers(_home_country(i)))
    return joined.select("source_order_item_id", "product_name", "country", "quantity", "total_amount")


@_query("J7_top_country_cross", "SELECT h.customer_key, h.country FROM home_country h CROSS JOIN best_country b WHERE h.country = b.country")
def _(i: Inputs):
    return reports.in_top_country(_home_country(i), _best_country(i))


@_query("J8_sales_date", "SELECT source_order_item_id, date_key, full_date, year, month, month_name FROM dated")
def _(i: Inputs):
    joined = reports.sales_date(i.gold("fact_sales"), i.gold("dim_date"))
    return joined.select("source_order_item_id", "date_key", "full_date", "year", "month", "month_name")


@_query("J9_not_yet_present", "SELECT order_id, customer_id FROM src_orders o WHERE NOT EXISTS (SELECT 1 FROM old_orders p WHERE p.order_id = o.order_id)")
def _(i: Inputs):
    return merge.not_yet_present(i.raw("orders").select("order_id", "customer_id"), i.earlier("orders"), ["order_id"])


def _by_month(i: Inputs, fact: DataFrame, key: str) -> DataFrame:
    """A fact as the load keeps it: split by month, its files in order of the key."""
    path = scratch_path(i.spark, "by_month")
    tables.publish(i.spark, path, fact, NOW, tables.month_part(), key=[key])
    return tables.read_table(i.spark, path, fact.schema)


@_query(
    "J9_not_yet_present_in_spans",
    "SELECT source_order_item_id, date_key FROM sales_rows WHERE source_order_item_id NOT IN (SELECT source_order_item_id FROM old_sales_rows)",
)
def _(i: Inputs):
    """Sales that an earlier fact lacks, looked up among those of its rows that can have a key of theirs."""
    held = _by_month(i, i.earlier_gold("fact_sales"), "source_order_item_id")
    sales = i.gold("fact_sales").select("source_order_item_id", "date_key")
    return merge.not_yet_present(sales, spans.narrowed(held, sales, "source_order_item_id"), ["source_order_item_id"])


# --- Aggregates, ranks, order ------------------------------------------------------------------------------------------------------


def _country_counts(i: Inputs) -> DataFrame:
    return reports.customer_country_logins(i.gold("fact_web_activity"), i.gold("dim_geo"))


def _best_country(i: Inputs) -> DataFrame:
    return reports.top_country(reports.logins_by_country(i.gold("fact_web_activity"), i.gold("dim_geo")))


def _home_country(i: Inputs) -> DataFrame:
    return reports.primary_country(reports.logins_by_customer_country(_country_counts(i)))


def _product_sums(i: Inputs) -> DataFrame:
    return reports.units_revenue(i.gold("fact_sales"), i.gold("dim_product"), reports.held_customers(_home_country(i)))


@_query("A1_logins_by_device", "SELECT * FROM device_logins")
def _(i: Inputs):
    return reports.logins_by_device(i.gold("fact_web_activity"), i.gold("dim_device"))


@_query("A2_logins_by_country", "SELECT * FROM country_logins")
def _(i: Inputs):
    return reports.logins_by_country(i.gold("fact_web_activity"), i.gold("dim_geo"))


@_query("A3_logins_by_customer_country", "SELECT * FROM customer_country WHERE customer_key IS NOT NULL")
def _(i: Inputs):
    return reports.logins_by_customer_country(_country_counts(i))


@_query("A4_units_revenue", "SELECT * FROM product_sums")
def _(i: Inputs):
    return _product_sums(i)


@_query("A5_monthly_sales", """SELECT CAST(date_trunc('month', full_date) AS DATE) AS month_start, year, month, month_name,
  count(DISTINCT source_order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
  CAST(sum(total_amount) AS DECIMAL(14,2)) AS monthly_revenue FROM dated GROUP BY ALL""")
def _(i: Inputs):
    return reports.by_month(reports.sales_date(i.gold("fact_sales"), i.gold("dim_date")))


@_query("A6_distinct_devices", "SELECT DISTINCT device_type FROM good_web")
def _(i: Inputs):
    return star.distinct_devices(i.good_web())


@_query("A7_distinct_geo", "SELECT DISTINCT client_ip, country, city FROM good_web WHERE client_ip IS NOT NULL")
def _(i: Inputs):
    return star.distinct_geo(i.good_web())


@_query("W1_rank_aggregate", """SELECT CAST(row_number() OVER (ORDER BY total_units_sold DESC NULLS FIRST, product_name DESC NULLS FIRST) AS INTEGER) AS rank_no,
  product_name, total_units_sold FROM (SELECT p.product_name, CAST(sum(s.quantity) AS BIGINT) AS total_units_sold
  FROM sales_rows s JOIN d_product p ON s.product_key = p.product_key GROUP BY p.product_name) x""")
def _(i: Inputs):
    sold = i.gold("fact_sales").groupBy("product_key").agg(F.sum("quantity").alias("units"))
    named = sold.join(i.gold("dim_product"), "product_key").groupBy("product_name").agg(F.sum("units").alias("total_units_sold"))
    return reports.rank_all(named, "total_units_sold", "product_name")


@_query("W2_first_per_key", "SELECT * FROM home_country")
def _(i: Inputs):
    return _home_country(i)


@_query("O1_top_one", "SELECT * FROM best_country")
def _(i: Inputs):
    return _best_country(i)


@_query("O2_top_five", "SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY n DESC, city DESC) AS INTEGER) AS rank_no, city, n AS logins FROM (SELECT city, count(*) AS n FROM web_rows JOIN d_geo USING (geo_key) GROUP BY city) c) r WHERE rank_no <= 5")
def _(i: Inputs):
    by_key = i.gold("fact_web_activity").groupBy("geo_key").agg(F.count("*").alias("n"))
    by_city = by_key.join(i.gold("dim_geo"), "geo_key").groupBy("city").agg(F.sum("n").alias("logins"))
    return reports.rank_top(by_city, "logins", "city", 5)


@_query("O3_month_order", "SELECT * FROM months ORDER BY month_start DESC")
def _(i: Inputs):
    days = conform.since(i.gold("dim_date"), "full_date", AS_OF, 12)
    return reports.month_order(reports.by_month(reports.sales_date(i.gold("fact_sales"), days)))


# --- Merges ------------------------------------------------------------------------------------------------------------------------


def _merge_sql(columns: dict[str, str], old: str, new: str, key: str) -> str:
    """Full outer join of an old and a new relation; `columns` says from where each column comes: new, old first, or the key."""
    pick = {
        "key": "coalesce(o.{c}, n.{c})",
        "new": "CASE WHEN n.{k} IS NOT NULL THEN n.{c} ELSE o.{c} END",
        "old": "CASE WHEN o.{k} IS NOT NULL THEN o.{c} ELSE n.{c} END",
    }
    chosen = ",\n  ".join(f"{pick[how].format(c=c, k=key)} AS {c}" for c, how in columns.items())
    return f"SELECT {chosen}\nFROM {old} o FULL JOIN {new} n ON o.{key} = n.{key}"


def _keyed(old: str, new: str, key: str, key_col: str) -> tuple[str, str]:
    """(old, new) relations with surrogate keys: old ones dense, new ones continuing after them."""
    o = f"(SELECT row_number() OVER (ORDER BY {key}) AS {key_col}, * FROM ({old}) a)"
    n = f"""(SELECT (SELECT count(*) FROM ({old}) b) + row_number() OVER (ORDER BY {key}) AS {key_col}, * FROM ({new}) c
  WHERE {key} NOT IN (SELECT {key} FROM ({old}) d)
  UNION ALL SELECT NULL, * FROM ({new}) e WHERE {key} IN (SELECT {key} FROM ({old}) f))"""
    return o, n


@_query(
    "M1_upsert",
    _merge_sql(
        {"order_item_id": "key", "order_id": "old", "product_id": "old", "quantity": "new", "unit_price": "old"},
        "(SELECT * FROM old_order_items WHERE order_id IN (SELECT order_id FROM old_orders))", "src_order_items", "order_item_id",
    ),
)
def _(i: Inputs):
    known = i.earlier("order_items").join(i.earlier("orders").select("order_id"), "order_id", "left_semi")
    return merge.upsert(known.select(*i.raw("order_items").columns), i.raw("order_items"), ["order_item_id"], ["quantity"])


M2_OLD, M2_NEW = _keyed(
    "SELECT order_id, customer_id FROM old_orders", "SELECT order_id, customer_id FROM src_orders", "order_id", "order_key"
)


@_query(
    "M2_surrogate_keys",
    f"SELECT n.order_id, n.customer_id, coalesce(o.order_key, n.order_key) AS order_key FROM {M2_NEW} n LEFT JOIN {M2_OLD} o ON n.order_id = o.order_id",
)
def _(i: Inputs):
    held = numbering.number_rows(i.earlier("orders").select("order_id", "customer_id"), [F.col("order_id")], "order_key")
    return merge.assign_keys(held, i.raw("orders").select("order_id", "customer_id"), "order_id", "order_key")


@_query(
    "M3_dim_company",
    _merge_sql(
        {"source_company_id": "key", "company_key": "old", "cuit": "new", "company_name": "new", "is_supplier": "new"},
        *_keyed(
            "SELECT company_id AS source_company_id, cuit, company_name, is_supplier FROM old_companies",
            "SELECT company_id AS source_company_id, cuit, company_name, is_supplier FROM src_companies",
            "source_company_id", "company_key",
        ),
        "source_company_id",
    ),
)
def _(i: Inputs):
    return star.dim_company(i.earlier_gold("dim_company"), conform.companies(i.bronze("companies", 2)))


@_query(
    "M4_dim_customer",
    _merge_sql(
        {"source_customer_id": "key", "customer_key": "old", "document_number": "new", "full_name": "new", "date_of_birth": "old", "age": "new"},
        *_keyed("SELECT * FROM old_customers", "SELECT * FROM customers", "source_customer_id", "customer_key"), "source_customer_id",
    ),
)
def _(i: Inputs):
    return star.dim_customer(i.earlier_gold("dim_customer"), conform.customers(i.bronze("end_customers", 2), AS_OF))


PRODUCT = "SELECT product_id AS source_product_id, supplier_id AS source_supplier_id, product_name, default_price FROM"


@_query(
    "M5_dim_product",
    _merge_sql(
        {"source_product_id": "key", "product_key": "old", "source_supplier_id": "old", "product_name": "new", "default_price": "new"},
        *_keyed(f"{PRODUCT} old_products", f"{PRODUCT} src_products", "source_product_id", "product_key"), "source_product_id",
    ),
)
def _(i: Inputs):
    return star.dim_product(i.earlier_gold("dim_product"), conform.products(i.bronze("products", 2)))


@_query(
    "M6_dim_device",
    _merge_sql(
        {"device_type": "key", "device_key": "old"},
        *_keyed(
            "SELECT DISTINCT device_type FROM old_good_web WHERE device_type <> 'Desktop'", "SELECT DISTINCT device_type FROM good_web",
            "device_type", "device_key",
        ),
        "device_type",
    ),
)
def _(i: Inputs):
    return star.dim_device(i.earlier_gold("dim_device"), i.good_web(2))


@_query(
    "M7_dim_geo",
    _merge_sql(
        {"ip_address": "key", "geo_key": "old", "country": "new", "city": "new"},
        *_keyed("SELECT ip_address, country, city FROM d_geo_old", "SELECT ip_address, country, city FROM d_geo", "ip_address", "geo_key"),
        "ip_address",
    ),
)
def _(i: Inputs):
    return star.dim_geo(i.earlier_gold("dim_geo"), i.good_web(2))


ORDER_DAYS = """SELECT DISTINCT CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS date_key, CAST(order_timestamp AS DATE) AS full_date,
  CAST(1 AS INTEGER) AS "year", CAST(2 AS INTEGER) AS "quarter", CAST(3 AS INTEGER) AS "month", 'held' AS month_name, CAST(4 AS INTEGER) AS "day"
FROM src_orders"""


@_query("M8_dim_date", f"SELECT * FROM ({ORDER_DAYS}) o UNION ALL SELECT * FROM d_date WHERE date_key NOT IN (SELECT date_key FROM ({ORDER_DAYS}) p)")
def _(i: Inputs):
    day = F.col("full_date")
    held = i.raw("orders").select(F.col("order_timestamp").cast("date").alias("full_date")).distinct().select(
        date_key(day).alias("date_key"), "full_date", F.lit(1).alias("year"), F.lit(2).alias("quarter"), F.lit(3).alias("month"),
        F.lit("held").alias("month_name"), F.lit(4).alias("day"),
    )
    return star.dim_date(held, AS_OF)


@_query(
    "M9_fact_sales",
    """SELECT r.source_order_item_id, r.source_order_id, r.date_key, r.company_key, r.customer_key, r.product_key, r.quantity,
  coalesce(o.unit_price, r.unit_price) AS unit_price, r.total_amount, CAST(2 AS BIGINT) AS etl_batch_id, TIMESTAMP '2001-12-01 00:00:00' AS updated_at
FROM sales_rows r LEFT JOIN old_sales_rows o ON r.source_order_item_id = o.source_order_item_id""",
)
def _(i: Inputs):
    return star.fact_sales(
        i.earlier_gold("fact_sales"), i.good_lines(2), i.gold("dim_company"), i.gold("dim_customer"), i.gold("dim_product"), NOW
    )


@_query(
    "M10_fact_web_activity",
    """SELECT r.*, CASE WHEN o.source_log_id IS NOT NULL THEN CAST(0 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS etl_batch_id
FROM web_rows r LEFT JOIN old_good_web o ON r.source_log_id = o.source_log_id""",
)
def _(i: Inputs):
    """Every log row comes a second time, an hour later: the first one counts."""
    web = i.good_web(2)
    repeated = web.withColumn("request_time", F.col("request_time") + F.expr("INTERVAL '1' HOUR")).unionByName(web)
    return star.fact_web_activity(
        i.earlier_gold("fact_web_activity"), repeated, i.gold("dim_geo"), i.gold("dim_device"), i.gold("dim_customer")
    )


@_query(
    "M11_fact_marketing_lead",
    """SELECT coalesce(n.source_lead_id, o.source_lead_id) AS source_lead_id,
  CASE WHEN n.source_lead_id IS NOT NULL THEN n.date_key ELSE o.date_key END AS date_key,
  CASE WHEN n.source_lead_id IS NOT NULL THEN n.company_name ELSE o.company_name END AS company_name,
  CASE WHEN n.source_lead_id IS NOT NULL THEN n.lead_score ELSE o.lead_score END AS lead_score,
  CASE WHEN n.source_lead_id IS NOT NULL THEN CAST(2 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS etl_batch_id
FROM lead_rows n FULL JOIN old_lead_rows o ON n.source_lead_id = o.source_lead_id""",
)
def _(i: Inputs):
    both = i.good_leads(2).unionByName(i.earlier_leads())  # rows of another batch, to be left out
    return star.fact_marketing_lead(i.earlier_gold("fact_marketing_lead"), both, 2)


@_query(
    "M12_weblog_insert_absent",
    """SELECT CAST(count(*) FILTER (WHERE o.source_line_number IS NULL) AS BIGINT) AS inserted,
  CAST(count(*) FILTER (WHERE o.source_line_number IS NOT NULL) AS BIGINT) AS skipped
FROM src_weblog_lines n LEFT JOIN old_weblog_lines o ON n.source_line_number = o.source_line_number""",
)
def _(i: Inputs):
    return weblogs.insert_counts(files.parse_weblogs(i.earlier("weblog_lines")), files.parse_weblogs(i.raw("weblog_lines")))


@_query("M12_weblog_rows", f"SELECT * , 'access.log' AS source_file FROM ({PARSED}) p")
def _(i: Inputs):
    held, rows = files.parse_weblogs(i.earlier("weblog_lines")), files.parse_weblogs(i.raw("weblog_lines"))
    return weblogs.insert_absent_actions(held, rows).drop("_action")


@_query(
    "M9_touched_months",
    """SELECT CAST(date_key // 100 AS BIGINT) AS "month", count(*) AS row_count FROM sales_rows
WHERE source_order_item_id IN (SELECT source_order_item_id FROM old_sales_rows) GROUP BY ALL""",
)
def _(i: Inputs):
    """Where a fact holds the keys of a batch: the months that a merge has to rewrite."""
    held = _by_month(i, i.gold("fact_sales"), "source_order_item_id")
    found = tables.held_parts(held, i.earlier_gold("fact_sales"), ["source_order_item_id"], tables.month_part())
    return found.groupBy(F.col(tables.PART).alias("month")).agg(F.count("*").alias("row_count"))


@_query(
    "M13_merge_counts",
    """SELECT action, count(*) AS row_count FROM (SELECT CASE WHEN o.source_order_item_id IS NULL THEN 'insert' ELSE 'update' END AS action
FROM sales_rows r LEFT JOIN old_sales_rows o ON r.source_order_item_id = o.source_order_item_id
UNION ALL SELECT 'keep' FROM old_sales_rows WHERE source_order_item_id NOT IN (SELECT source_order_item_id FROM sales_rows)) a GROUP BY action""",
)
def _(i: Inputs):
    return merge.merge_counts(
        star.sales_actions(
            i.earlier_gold("fact_sales"), i.good_lines(2), i.gold("dim_company"), i.gold("dim_customer"), i.gold("dim_product"), NOW
        )
    )


# --- Reports -----------------------------------------------------------------------------------------------------------------------


def _top_devices(i: Inputs) -> DataFrame:
    return reports.top_devices(i.gold("fact_web_activity"), i.gold("dim_device"))


def _top_products(i: Inputs) -> DataFrame:
    return reports.top_products(i.gold("fact_web_activity"), i.gold("fact_sales"), i.gold("dim_geo"), i.gold("dim_product"))


def _months(i: Inputs) -> DataFrame:
    return reports.monthly_sales(i.gold("fact_sales"), i.gold("dim_date"), AS_OF)


@_query("R1_top_devices", "SELECT * FROM best_devices")
def _(i: Inputs):
    return _top_devices(i)


@_query("R2_top_products_in_top_country", "SELECT * FROM best_products")
def _(i: Inputs):
    return _top_products(i)


@_query("R3_monthly_sales_last_year", "SELECT * FROM months ORDER BY month_start DESC")
def _(i: Inputs):
    return _months(i)


@_query("R3_monthly_sales_by_parts", "SELECT * FROM months")
def _(i: Inputs):
    """The monthly report from days kept by month: first those of the earlier sales, then brought up to date."""
    w = load.Warehouse(i.spark, scratch_path(i.spark, "monthly"))
    for sales in (i.earlier_gold("fact_sales"), i.gold("fact_sales")):
        tables.publish(i.spark, w.path("gold", "fact_sales"), sales.select(*schemas.GOLD["fact_sales"].names), NOW, tables.month_part())
        load.refresh_sales_days(w, NOW)
    days = tables.read_table(i.spark, w.path("gold", "sales_days"), schemas.SALES_DAYS)
    return reports.monthly_from_days(days, i.gold("dim_date"), AS_OF)


@_query(
    "S11_reports_as_loaded",
    """SELECT 'devices' AS report, CAST(rank_no AS VARCHAR) AS place, device_type AS label, total_logins AS amount FROM best_devices
UNION ALL SELECT 'products', CAST(rank_no AS VARCHAR), product_name, total_units_sold FROM best_products
UNION ALL SELECT 'months', CAST(month_start AS VARCHAR), month_name, total_items_sold FROM months""",
)
def _(i: Inputs):
    """All three report tables read back whole, as a refresh over a warehouse leaves them."""
    w = load.Warehouse(i.spark, scratch_path(i.spark, "reported"))
    for table in ("dim_device", "dim_geo", "dim_product", "dim_date", "fact_web_activity", "fact_sales"):
        part = tables.month_part() if table.startswith("fact") else None
        tables.publish(i.spark, w.path("gold", table), i.gold(table).select(*schemas.GOLD[table].names), NOW, part)
    load.refresh_reports(w, AS_OF)

    def rows(table: str, report: str, place: str, label: str, amount: str) -> DataFrame:
        return w.report(table).select(F.lit(report).alias("report"), F.col(place).cast("string").alias("place"), F.col(label).alias("label"), F.col(amount).alias("amount"))

    return reduce(
        DataFrame.unionByName,
        [
            rows("report_top_devices", "devices", "rank_no", "device_type", "total_logins"),
            rows("report_top_products_in_top_country", "products", "rank_no", "product_name", "total_units_sold"),
            rows("report_monthly_sales_last_year", "months", "month_start", "month_name", "total_items_sold"),
        ],
    )


# --- Load history ------------------------------------------------------------------------------------------------------------------


@_query(
    "K1_job_runs",
    """SELECT job_run_id, arg_max(batch_id, seq) AS batch_id, arg_max(job_name, seq) AS job_name, arg_max(status, seq) AS status,
  min(event_time) FILTER (WHERE status = 'RUNNING') AS started_at, arg_max(event_time, seq) FILTER (WHERE status <> 'RUNNING') AS finished_at,
  max(error_message) AS error_message FROM log_job_events GROUP BY job_run_id""",
)
def _(i: Inputs):
    return audit.job_runs(i.history("job_events"))


@_query("K2_layer_state", "SELECT * FROM layer_now")
def _(i: Inputs):
    return audit.layer_state(i.history("layer_events"))


@_query(
    "K3_resume_point",
    """SELECT b.pipeline_name, b.batch_id AS last_batch_id,
  CASE WHEN b.status = 'FAILED' AND NOT gold THEN b.batch_id END AS restart_batch_id,
  CASE WHEN b.status <> 'FAILED' OR gold THEN 'bronze' WHEN silver THEN 'gold' WHEN bronze THEN 'silver' ELSE 'bronze' END AS resume_from_layer
FROM (SELECT *, EXISTS (SELECT 1 FROM layer_now l WHERE l.pipeline_name = n.pipeline_name AND l.last_batch_id = n.batch_id AND l.status = 'SUCCESS' AND l.layer_name = 'gold_star_schema_layer') AS gold,
    EXISTS (SELECT 1 FROM layer_now l WHERE l.pipeline_name = n.pipeline_name AND l.last_batch_id = n.batch_id AND l.status = 'SUCCESS' AND l.layer_name = 'silver_cleansing_layer') AS silver,
    EXISTS (SELECT 1 FROM layer_now l WHERE l.pipeline_name = n.pipeline_name AND l.last_batch_id = n.batch_id AND l.status = 'SUCCESS' AND l.layer_name = 'bronze_ingestion_layer') AS bronze
  FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY batch_id DESC) AS place FROM batch_now) n WHERE place = 1) b""",
)
def _(i: Inputs):
    return audit.resume_point(audit.batch_status(i.history("batch_events")), audit.layer_state(i.history("layer_events")))


@_query("K4_batch_status", "SELECT * FROM batch_now")
def _(i: Inputs):
    return audit.batch_status(i.history("batch_events"))
