from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from strata import schemas
from strata.operators import conform, quality
from strata.sources import files


def schema(**fields):
    return StructType([StructField(n, t) for n, t in fields.items()])


def test_resolve_column_prefers_the_first_spelling_that_exists(spark):
    df = spark.range(1).select(F.lit(1).alias("Order_ID"), F.lit(2).alias("SOURCE_ORDER_ID"))
    assert conform.resolve_column(df, ["source_order_id", "order_id"]) == "SOURCE_ORDER_ID"
    assert conform.resolve_column(df, ["order_id", "source_order_id"]) == "Order_ID"
    assert conform.resolve_column(df, ["missing", "absent"]) == "missing"


def test_align_exact_ignores_case_and_raises_on_a_gap(spark):
    df = spark.createDataFrame([("7", "x")], "Quantity string, extra string")
    assert conform.align_schema(df, schema(quantity=IntegerType())).collect() == [(7,)]
    with pytest.raises(ValueError, match="price"):
        conform.align_schema(df, schema(quantity=IntegerType(), price=LongType()))
    with pytest.raises(ValueError, match="mode"):
        conform.align_schema(df, schema(quantity=IntegerType()), "loose")


def test_align_alias_takes_related_names_and_leaves_out_the_rest(spark):
    df = spark.createDataFrame([(1, "a", 5)], "company_id int, name string, score int")
    aligned = conform.align_schema(
        df, schema(source_company_id=LongType(), company_name=StringType(), zip=StringType(), score=LongType()), "alias"
    )
    assert aligned.columns == ["source_company_id", "company_name", "score"]
    assert aligned.collect() == [(1, "a", 5)]


def test_raw_tables_may_carry_prefixed_keys(spark):
    items = spark.createDataFrame([(1, 10, 5, 2, Decimal("3.50"))], "source_order_item_id long, ORDER_ID long, product_id long, quantity int, unit_price decimal(12,2)")
    orders = spark.createDataFrame(
        [(10, 1, 2, datetime(2001, 1, 1), 4)],
        "order_id long, source_company_id long, customer_id long, order_timestamp timestamp_ntz, batch_id long",
    )
    row = conform.sales_lines(items, orders).first()
    assert (row.source_order_item_id, row.source_order_id, row.total_amount, row.batch_id) == (1, 10, Decimal("7.00"), 4)


def test_orphan_items_and_orders_without_items_are_left_out(spark):
    items = spark.createDataFrame([(1, 10, 5, 2, Decimal(1)), (2, 99, 5, 2, Decimal(1))], schemas.BRONZE["order_items"].fieldNames()[:5])
    orders = spark.createDataFrame([(10, 1, 2, datetime(2001, 1, 1), 1), (11, 1, 2, datetime(2001, 1, 1), 1)], schemas.BRONZE["orders"].fieldNames())
    assert [r.source_order_item_id for r in conform.sales_lines(items, orders).collect()] == [1]


def test_raw_lead_columns_are_replaced_by_typed_ones(spark):
    leads = spark.createDataFrame([("L1", "12", "2001-01-02 03:04:05")], "lead_id string, Lead_Score_Raw string, acquired_at string")
    typed = conform.lead_types(leads)
    assert typed.columns == ["lead_id", "lead_score", "acquired_at"]
    assert typed.first() == ("L1", 12, datetime(2001, 1, 2, 3, 4, 5))


def verdicts(spark, rule, rows, ddl):
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"n int, {ddl}")
    good, bad, undecided = quality.split(df, rule)
    found = {r.n: v for v, part in [("good", good), ("bad", bad), ("undecided", undecided)] for r in part.collect()}
    assert len(found) == len(rows)
    assert good.columns == df.columns
    return [found[n] for n in range(len(rows))]


def test_sales_rule_truth_table(spark):
    rows = [(q, p) for q in (-1, 0, 1, None) for p in (-1, 0, 1, None)]
    expected = []
    for q, p in rows:
        bad = (q is not None and q < 0) or (p is not None and p < 0)
        good = q is not None and p is not None and not bad
        expected.append("bad" if bad else "good" if good else "undecided")
    assert verdicts(spark, quality.sales_rule(), rows, "quantity int, unit_price int") == expected


def test_weblog_rule_truth_table(spark):
    rows = [("1.2.3.4",), ("bad_ip_address",), (None,), ("",)]
    assert verdicts(spark, quality.weblog_rule(), rows, "client_ip string") == ["good", "bad", "undecided", "good"]


def test_lead_rule_truth_table(spark):
    rows = [(s, e, c) for s in (-1, 0, None) for e in ("a@b", "ab", None) for c in ("Acme", "  ", None)]
    expected = []
    for s, e, c in rows:
        blank = c is None or c.strip() == ""
        bad = (s is not None and s < 0) or (e is not None and "@" not in e) or blank
        good = s is not None and s >= 0 and e is not None and "@" in e and not blank
        expected.append("bad" if bad else "good" if good else "undecided")
    assert verdicts(spark, quality.lead_rule(), rows, "lead_score int, email string, company_name string") == expected


def test_quarantine_repeats_replace_only_their_batch(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.createDataFrame([(1, "x", None), (2, None, 3)], "id int, a string, b int")
    for batch in (1, 2, 1):
        files.append_quarantine(quality.quarantine(rows, "S", "R", batch), path, batch)
    kept = files.read_quarantine(spark, path)
    assert sorted((r.batch_id, r.raw_record) for r in kept.collect()) == [
        (b, j) for b in (1, 2) for j in ('{"id":1,"a":"x"}', '{"id":2,"b":3}')
    ]
    assert kept.select("job_name", "source_name", "error_reason").distinct().collect() == [("daily_load", "S", "R")]
    counts = {r.source_name: r.rejected for r in quality.reject_counts(kept).collect()}
    assert counts == {"S": 4, None: 4}


def test_quarantined_rows_can_be_queried_as_variant(spark):
    rows = spark.createDataFrame([(7, "x")], "id int, a string")
    record = quality.quarantine(rows, "S", "R", 1).select(F.parse_json("raw_record").alias("v"))
    assert record.select(F.variant_get("v", "$.id", "int")).first()[0] == 7


def test_table_schema_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, date(2001, 1, 1))], "a long, b date").write.parquet(path)
    assert files.table_schema(spark, path) == spark.read.parquet(path).schema
