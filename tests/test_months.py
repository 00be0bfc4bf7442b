"""The monthly report from days that are kept by month."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import merge
from strata.plans import fixtures, load, reports
from strata.plans.inputs import inputs
from strata.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def warehouse(spark, tmp_path):
    w = load.Warehouse(spark, str(tmp_path / "w"))
    sales = inputs(spark, SF_DIR).gold("fact_sales").select(*schemas.GOLD["fact_sales"].names)
    tables.publish(spark, w.path("gold", "fact_sales"), sales, fixtures.NOW, tables.month_part())
    return w


def report(w):
    days = tables.read_table(w.spark, w.path("gold", "sales_days"), schemas.SALES_DAYS)
    return [tuple(r) for r in reports.monthly_from_days(days, inputs(w.spark, SF_DIR).gold("dim_date"), fixtures.AS_OF).collect()]


def from_scratch(w):
    return [tuple(r) for r in reports.monthly_sales(w.gold("fact_sales"), inputs(w.spark, SF_DIR).gold("dim_date"), fixtures.AS_OF).collect()]


def test_a_batch_of_one_month_reads_one_month(spark, warehouse, monkeypatch):
    w = warehouse
    months = load.refresh_sales_days(w, fixtures.NOW)
    assert len(months) > 50 and report(w) == from_scratch(w) != []
    assert load.refresh_sales_days(w, fixtures.NOW) == []  # nothing has changed

    some = w.gold("fact_sales", [200106]).orderBy("source_order_item_id").limit(20).withColumn("quantity", F.col("quantity") + 5)
    done, n = load._fact_updates(w, "fact_sales", "source_order_item_id", some, ("quantity",))
    assert n == 20 and done.replaces == [200106]
    assert load.publish_merge(w, done, fixtures.NOW)[merge.UPDATE] == 20
    read, real = [], load.Warehouse.gold
    monkeypatch.setattr(load.Warehouse, "gold", lambda self, table, parts=None: read.append((table, parts)) or real(self, table, parts))
    before = report(w)
    assert load.refresh_sales_days(w, fixtures.NOW) == [200106] and read == [("fact_sales", [200106])]
    assert report(w) == from_scratch(w) != before
    # months that no merge touched are the files they were
    entries = dict((p, v) for v, p in tables._current(spark, w.path("gold", "sales_days"))[1])
    assert entries[200106] == 2 and {v for p, v in entries.items() if p != 200106} == {1}


def test_reports_of_a_warehouse_are_read_back(spark, tmp_path):
    """All three tables as the load leaves them."""
    i = inputs(spark, SF_DIR)
    w = load.Warehouse(spark, str(tmp_path / "w"))
    for table in ("dim_device", "dim_geo", "dim_product", "dim_date", "fact_web_activity", "fact_sales"):
        part = tables.month_part() if table.startswith("fact") else None
        tables.publish(spark, w.path("gold", table), i.gold(table).select(*schemas.GOLD[table].names), fixtures.NOW, part)
    for _ in range(2):
        load.refresh_reports(w, fixtures.AS_OF)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(w.report("report_top_devices")) == rows(reports.top_devices(i.gold("fact_web_activity"), i.gold("dim_device")))
    expected = reports.top_products(i.gold("fact_web_activity"), i.gold("fact_sales"), i.gold("dim_geo"), i.gold("dim_product"))
    assert rows(w.report("report_top_products_in_top_country")) == rows(expected)
    assert rows(w.report("report_monthly_sales_last_year")) == rows(reports.monthly_sales(i.gold("fact_sales"), i.gold("dim_date"), fixtures.AS_OF))


def test_an_order_on_several_days_is_refused(spark, tmp_path):
    w = load.Warehouse(spark, str(tmp_path / "w"))
    rows = [(1, 7, 20010105), (2, 7, 20010109), (3, 8, 20010105), (4, 8, 20010205), (5, None, None)]
    sales = spark.createDataFrame(rows, "source_order_item_id long, source_order_id long, date_key int")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.GOLD["fact_sales"].fields if f.name not in sales.columns]
    publish = lambda df: tables.publish(spark, w.path("gold", "fact_sales"), df.select("*", *nothing).select(*schemas.GOLD["fact_sales"].names), datetime(2001, 1, 1), tables.month_part())
    publish(sales)
    with pytest.raises(ValueError, match="several days"):
        load.refresh_sales_days(w, datetime(2001, 1, 1))
    publish(sales.filter("source_order_item_id <> 2"))  # an order in two months counts in both, as in the report from scratch
    assert load.refresh_sales_days(w, datetime(2001, 1, 1)) == [200101, 200102]
    days = tables.read_table(spark, w.path("gold", "sales_days"), schemas.SALES_DAYS)
    assert sorted((r.date_key, r.orders) for r in days.collect()) == [(20010105, 2), (20010205, 1)]


def test_days_and_their_check_share_one_shuffle_of_the_orders(spark, tmp_path):
    rows = [(7, 20010105, 2, 1), (7, 20010105, 3, 1), (8, 20010105, 1, 1), (8, 20010205, 1, 1), (9, 20010106, 1, 1), (9, 20010108, 4, 1), (None, 20010107, None, None), (7, None, 9, 9)]
    path = str(tmp_path / "sales")
    spark.createDataFrame(rows, "source_order_id long, date_key int, quantity int, amount int").withColumn("total_amount", F.col("amount").cast("decimal(18,2)")).write.parquet(path)
    days = reports.sales_days(spark.read.parquet(path))
    assert days._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # orders, days
    found = sorted((r.date_key, r.orders, r.units, r.split_orders) for r in days.collect())
    assert found == [(20010105, 2, 6, 0), (20010106, 1, 5, 1), (20010107, 0, None, 0), (20010205, 1, 1, 0)]


def test_days_of_a_fact_that_lost_all_rows_are_gone(spark, warehouse):
    w = warehouse
    assert load.refresh_sales_days(w, fixtures.NOW) != []
    tables.publish(spark, w.path("gold", "fact_sales"), w.gold("fact_sales").limit(0), fixtures.NOW, tables.month_part())
    assert load.refresh_sales_days(w, fixtures.NOW) == [] and report(w) == []
