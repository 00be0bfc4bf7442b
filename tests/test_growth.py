"""Inputs beyond the given ones: keys that fill a long, and what is shuffled of sales and their lines."""

from __future__ import annotations

from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import merge, spans, star
from strata.plans import audit, catalog, fixtures, load, reports
from strata.plans.inputs import Inputs
from strata.sources import files, tables

LAST = 8_999_999  # of 60 times the 150,000 orders of the largest given table


@pytest.fixture()
def few_lines(spark, tmp_path):
    """Three lines of the last order, the second of them twice; the third one's quantity is turned back."""
    rows = [(LAST, 1_199_999, 59_999, 1, 5.0, 10.0, "N"), (LAST, 1_199_998, 59_998, 2, 6.0, 11.0, "N"), (LAST, 1_199_998, 59_998, 2, 6.0, 12.0, "N"), (LAST, 7, 7, 7, 3.0, 1.0, "R")]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string")
    lines.withColumn("l_shipdate", F.lit("2001-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(LAST, 899_999)], "o_orderkey long, o_custkey long")
    orders.withColumn("o_orderdate", F.lit("2001-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "orders.parquet"))
    return Inputs(spark, str(tmp_path))


def test_job_events_of_the_last_order_are_numbered_beyond_a_long(few_lines):
    events = few_lines.history("job_events").collect()
    assert sorted(int(e.seq) for e in events) == sorted(2 * e.job_run_id + (e.event_time != datetime(2001, 1, 1)) for e in events)
    assert max(int(e.seq) for e in events) > 2**63
    runs = {r.job_run_id: r for r in audit.job_runs(few_lines.history("job_events")).collect()}
    assert len(runs) == 4 and sorted(r.status for r in runs.values()) == ["FAILED", "SUCCESS", "SUCCESS", "SUCCESS"]
    assert all((r.started_at, r.finished_at) == (datetime(2001, 1, 1), datetime(2001, 1, 1, 0, 10)) for r in runs.values())
    assert [r.error_message for r in runs.values() if r.status == "FAILED"] == ["quantity -3"]


def test_wide_history_differs_in_the_width_alone():
    for table, sql in fixtures.WIDE_HISTORY.items():
        assert sql.replace("CAST(order_item_id AS DECIMAL(20,0))", "order_item_id") == fixtures.HISTORY[table] != sql


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_dealt_by_order_once_for_numbering_and_join(few_lines, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert exchanges(few_lines.lines()) == 2  # lines, orders
    got = sorted((r.source_order_item_id % 10, r.source_product_id, r.quantity) for r in few_lines.lines().collect())
    assert got == [(0, 7, -3), (0, 1_199_998, 6), (0, 1_199_999, 5), (1, 1_199_998, 6)]


@pytest.fixture()
def sales(spark, tmp_path):
    """Four lines, the last two with one key, of which one has no product and so no fact; and written dimensions."""
    rows = [(1, 10, 1, 2, 3, 5), (2, 10, 1, 2, 3, 6), (3, 11, 1, 2, 4, 7), (3, 11, 1, 2, 99, 8), (4, 11, 1, None, 4, 9)]
    lines = spark.createDataFrame(rows, "source_order_item_id long, source_order_id long, source_company_id long, source_customer_id long, source_product_id long, quantity int")
    lines = lines.select(
        "*", F.lit(date(2001, 1, 1)).cast("timestamp_ntz").alias("order_timestamp"), F.lit(1).cast("decimal(12,2)").alias("unit_price"),
        F.lit(2).cast("decimal(18,2)").alias("total_amount"), F.lit(1).cast("bigint").alias("batch_id"),
    )
    dimensions = []
    for name, ids in (("company", [1]), ("customer", [2, None]), ("product", [3, 4])):
        rows = [(n, None if n is None else n * 100) for n in ids]
        spark.createDataFrame(rows, f"source_{name}_id long, {name}_key long").write.parquet(str(tmp_path / name))
        dimensions.append(spark.read.parquet(str(tmp_path / name)))
    return lines, dimensions


def test_key_pairs_are_broadcast_to_sales_whatever_the_limit(sales, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines, dimensions = sales
    facts = star.fact_sales_lookup(lines, *dimensions)
    assert exchanges(facts) == 0
    got = sorted((r.source_order_item_id, r.company_key, r.customer_key, r.product_key) for r in facts.collect())
    assert got == [(1, 100, 200, 300), (2, 100, 200, 300), (3, 100, 200, 400)]
    assert sorted(r.quantity for r in star.unmatched_lines(lines, *dimensions).collect()) == [8, 9]


def test_first_sales_are_written_without_a_shuffle_of_their_rows(spark, tmp_path, sales):
    lines, dimensions = sales
    empty = Inputs(spark, str(tmp_path)).empty("fact_sales")
    now = datetime(2001, 12, 1)
    actions = star.sales_actions(empty, lines, *dimensions, now)
    assert exchanges(actions) == 0
    assert actions.columns == [*empty.columns, "_action"]
    assert sorted((r.source_order_item_id, r.quantity, r._action) for r in actions.collect()) == [(1, 5, "insert"), (2, 6, "insert"), (3, 7, "insert")]
    with pytest.raises(Exception, match="repeated key in updates: source_order_item_id"):
        star.sales_actions(empty, lines.union(lines), *dimensions, now)


def test_first_rows_as_in_any_merge(spark):
    target = spark.createDataFrame([], "k long, v string, more long")
    updates = spark.createDataFrame([("a", None), ("b", None), ("c", 7)], "v string, k long")  # without a key, nothing conflicts
    key = lambda r: str(tuple(r))
    new, any_ = merge.all_new(target, updates, ["k"]), merge.merged(target, updates, ["k"], ["v"])
    assert new.dtypes == any_.dtypes and sorted(new.collect(), key=key) == sorted(any_.collect(), key=key)


def test_first_rows_are_told_from_repeated_ones_by_counting_keys(spark):
    target = spark.createDataFrame([], "k long, l long, v string")
    nulls = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 1, "d"), (1, None, "e"), (1, None, "f")], "k long, l long, v string")
    assert merge.all_new(target, nulls, ["k", "l"]).count() == 6  # a key with a NULL repeats nothing
    with pytest.raises(ValueError, match="repeated key in updates: k, l"):
        merge.all_new(target, nulls.union(nulls.limit(1)), ["k", "l"])


def pages(files):
    """Codec and encodings of a column in each of some Parquet files."""
    found = [pq.read_metadata(f.removeprefix("file:")).row_group(0).column(0) for f in files]
    return {(c.compression, "DELTA_BINARY_PACKED" in c.encodings) for c in found}


def test_facts_are_written_as_differences_whatever_the_codec(spark, tmp_path, conf):
    conf("spark.sql.parquet.compression.codec", "snappy")
    rows = spark.range(300_000).select((F.col("id") * 1_000_000_000_007).alias("k"), F.lit(20010101).alias("date_key"), (F.xxhash64("id") % 10**12).cast("decimal(28,2)").alias("amount"))
    new = merge.all_new(spark.createDataFrame([], rows.schema), rows, ["k"])
    assert pages(new.inputFiles()) == {("ZSTD", True)}
    path = str(tmp_path / "fact")
    tables.publish(spark, path, rows, datetime(2001, 12, 1), tables.month_part(), key=["k"])
    held = tables.read_table(spark, path, rows.schema)
    assert pages(held.inputFiles()) == {("ZSTD", True)}
    assert held.exceptAll(rows).isEmpty() and new.drop("_action").exceptAll(rows).isEmpty() and held.count() == new.count() == rows.count()


def test_many_keys_are_not_listed_to_find_their_spans(spark, monkeypatch):
    many, few = spark.range(1000, 2000).toDF("k"), spark.range(3).crossJoin(spark.range(500).select()).toDF("k")
    table = spark.range(5000).toDF("k")
    assert sorted(r.k for r in spans.narrowed(table, few, "k").collect()) == [0, 1, 2]

    def shuffled(_):
        raise AssertionError("all keys are shuffled")

    monkeypatch.setattr(type(many), "distinct", shuffled)
    assert spans.narrowed(table, many, "k").agg(F.min("k"), F.max("k"), F.count("*")).first() == (1000, 1999, 1000)


def test_shuffles_of_a_session_are_written_by_zstd(spark):
    assert spark.sparkContext.getConf().get("spark.io.compression.codec") == "zstd"


FAR = 53_999_999  # the last order of 360 times the largest given table: its lines' keys exceed a long


@pytest.fixture()
def far_lines(spark, tmp_path):
    """Folder of tables: an order of the last year with four lines, two of them equal, whose revenue exceeds fourteen digits, and one order before."""
    day = "timestamp_ntz"
    lines = [(FAR, 7_199_999, 359_999, 1, 50.0, 9e9, "N"), (FAR, 7_199_998, 359_998, 2, 40.0, 9e9, "N"), (FAR, 7_199_998, 359_998, 2, 40.0, 9e9, "N"), (FAR, 7, 7, 7, 3.0, 1.0, "R"), (FAR - 1, 7, 7, 1, 2.0, 5.0, "N")]
    tables_ = {
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string").withColumn("l_shipdate", F.lit("2001-01-01").cast(day)),
        "orders": spark.createDataFrame([(FAR, 5_399_999, "2001-01-05"), (FAR - 1, 5_399_999, "2000-06-01")], "o_orderkey long, o_custkey long, d string").select("o_orderkey", "o_custkey", F.col("d").cast(day).alias("o_orderdate")),
        "customer": spark.createDataFrame([(5_399_999, "c", "m", 1.0)], "c_custkey long, c_name string, c_mktsegment string, c_acctbal double"),
        "supplier": spark.createDataFrame([(9, "s")], "s_suppkey long, s_name string"),
        "part": spark.createDataFrame([(k, "p", 1.0) for k in (7, 7_199_998, 7_199_999)], "p_partkey long, p_name string, p_retailprice double"),
    }
    for name, rows in tables_.items():
        rows.write.parquet(str(tmp_path / "far" / f"{name}.parquet"))
    return str(tmp_path / "far"), lines


def line_keys(lines):
    seen = {}
    for order, part, supplier, line, *_ in lines:
        key = (((order * 10 + line) * 1000000 + part) * 10000 + supplier) * 10
        seen[key] = seen.get(key, -1) + 1
        yield key + seen[key]


def test_line_keys_beyond_a_long_are_decimals_and_others_longs(spark, far_lines, few_lines):
    path, lines = far_lines
    keys = sorted(line_keys(lines))
    assert max(keys) > 2**63 and len(set(keys)) == 5
    assert sorted(int(r.order_item_id) for r in Inputs(spark, path).raw("order_items").collect()) == keys
    read = catalog.QUERIES["S2_quantile_ranges"](spark, path)
    assert sorted(int(r.order_item_id) for r in read.collect()) == keys
    assert few_lines.raw("order_items").schema["order_item_id"].dataType.typeName() == "long"


def test_wide_lines_differ_in_the_width_alone():
    for table, sql in fixtures.WIDE_RAW.items():
        narrow = sql.replace("CAST((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS DECIMAL(20,0))", "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey)")
        assert narrow == fixtures.RAW[table] != sql


@pytest.mark.parametrize("query", ["R3_monthly_sales_last_year", "R3_monthly_sales_by_parts"])
def test_months_hold_a_revenue_of_more_than_fourteen_digits(spark, far_lines, query):
    months = [tuple(r) for r in catalog.QUERIES[query](spark, far_lines[0]).collect()]
    assert months == [(date(2001, 1, 1), 2001, 1, "January", 1, 130, 130 * 9 * 10**9)]


def test_reports_of_a_revenue_of_more_than_fourteen_digits_are_read_back(spark, far_lines, tmp_path):
    months = catalog.QUERIES["R3_monthly_sales_last_year"](spark, far_lines[0])
    w = load.Warehouse(spark, str(tmp_path / "w"))
    files.write_full(months, w.path("gold", "report_monthly_sales_last_year"))
    assert [r.monthly_revenue for r in w.report("report_monthly_sales_last_year").collect()] == [130 * 9 * 10**9]
    small = reports.by_month(spark.createDataFrame([(1, date(2001, 1, 1), 2001, 1, "January", 2)], "source_order_id long, full_date date, year int, month int, month_name string, quantity int").withColumn("total_amount", F.lit(7).cast("decimal(18,2)")))
    assert small.schema["monthly_revenue"].dataType == schemas.REPORT_MONEY and [r.monthly_revenue for r in small.collect()] == [7]
    assert reports.by_month(small.limit(0).select(F.lit(1).alias("source_order_id"), F.col("month_start").alias("full_date"), "year", "month", "month_name", F.lit(1).alias("quantity"), F.lit(1).cast("decimal(18,2)").alias("total_amount"))).collect() == []
