"""What Spark makes of the plans: what is read, what is shuffled, what happens to hot keys."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import session
from strata.operators import conform, merge, quality, star
from strata.plans import fixtures, reports
from strata.plans.inputs import inputs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def shuffled(conf):
    """No broadcasts, as with sides too large for it, and skew handling from small sizes on."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    return conf


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan adaptive execution ended with."""
    df.collect()
    return plan(df)


def scans(df):
    """Columns read and filters pushed, per scan."""
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", plan(df).replace("\n", " "))


def columns(read):
    return sorted(re.findall(r"(\w+):", read))


def test_monthly_report_reads_four_columns_of_recent_rows(spark):
    i = inputs(spark, SF_DIR)
    report = reports.monthly_sales(i.gold("fact_sales"), i.gold("dim_date"), fixtures.AS_OF)
    pushed, read = scans(report)[0]
    assert "GreaterThanOrEqual(date_key,20001201)" in pushed
    assert columns(read) == ["date_key", "quantity", "source_order_id", "total_amount"]
    assert "BroadcastHashJoin" in plan(report) and "SortMergeJoin" not in plan(report)


def test_device_report_reads_one_fact_column_and_takes_the_top(spark):
    i = inputs(spark, SF_DIR)
    report = reports.top_devices(i.gold("fact_web_activity"), i.gold("dim_device"))
    assert columns(scans(report)[0][1]) == ["device_key"]
    assert "TakeOrderedAndProject" in plan(report)


def test_country_logins_read_two_fact_columns(spark):
    i = inputs(spark, SF_DIR)
    logins = reports.customer_country_logins(i.gold("fact_web_activity"), i.gold("dim_geo"))
    assert columns(scans(logins)[0][1]) == ["customer_key", "geo_key"]


@pytest.mark.parametrize("update_cols", [["v"], []])
def test_merge_shuffles_each_side_once(spark, shuffled, tmp_path, update_cols):
    for name in ("t", "u"):
        spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / name))
    target, updates = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "u"))
    assert plan(merge.upsert(target, updates, ["k"], update_cols)).count("Exchange hashpartitioning") == 2


def test_small_merge_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    merged = merge.upsert(target, target.limit(5), ["k"], ["v"], updates_rows=5)
    kept = plan(merged).split("Union")[1].split("BuildRight")[0]
    assert "Exchange" not in kept


def test_lines_of_a_hot_order_are_split(spark, shuffled):
    """A third of all lines belong to one order."""
    n = 200_000
    items = spark.range(n).select(
        F.col("id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("order_id"),
        (F.col("id") % 100).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit("1.00").cast("decimal(12,2)").alias("unit_price"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"), F.lit(1).alias("company_id"), F.lit(2).alias("customer_id"),
        F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz").alias("order_timestamp"), F.lit(1).alias("batch_id"),
    )
    lines = conform.sales_lines(items, orders)
    assert "skew=true" in final_plan(lines)
    assert lines.count() == n


def test_unknown_accounts_and_a_hot_address_are_split(spark, shuffled, tmp_path):
    """A third of the log has no customer, another third one address."""
    n = 300_000
    activity = spark.range(n).select(
        F.col("id").alias("source_log_id"),
        F.when(F.col("id") % 3 == 1, "10.0.0.1").otherwise(F.concat(F.lit("10.1.0."), (F.col("id") % 200).cast("string"))).alias("client_ip"),
        F.lit("Desktop").alias("device_type"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 1000).cast("int").alias("mapped_customer_id"),
        F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz").alias("request_time"),
        F.lit(1).alias("batch_id"),
    )
    activity.write.parquet(str(tmp_path / "web"))
    activity = spark.read.parquet(str(tmp_path / "web"))
    geo = activity.select("client_ip").distinct().select(F.col("client_ip").alias("ip_address"), F.hash("client_ip").cast("bigint").alias("geo_key"))
    geo.write.parquet(str(tmp_path / "geo"))
    geo = spark.read.parquet(str(tmp_path / "geo"))
    device = spark.range(1).select(F.lit("Desktop").alias("device_type"), F.col("id").alias("device_key"))
    customer = spark.range(1000).select(F.col("id").alias("source_customer_id"), (F.col("id") + 1).alias("customer_key"))
    facts = star.fact_web_lookup(activity, geo, device, customer)
    joins = re.findall(r"SortMergeJoin\(skew=true\).*?(Inner|LeftOuter)", final_plan(facts))
    assert "Inner" in joins
    # Rows without a customer are not split there: they stay out of the join with customers.
    assert any("IsNotNull(mapped_customer_id)" in pushed for pushed, _ in scans(facts))
    counted = facts.agg(F.count("*").alias("n"), F.count_if(F.col("customer_key").isNull()).alias("unknown")).first()
    assert (counted.n, counted.unknown) == (n, n // 3)


def test_sales_of_a_hot_customer_are_split(spark, shuffled):
    """A third of all sales belong to one customer; the customers' countries come out of an aggregate."""
    n = 300_000
    sales = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 11).otherwise(F.col("id") % 2000).alias("customer_key"), (F.col("id") % 500).alias("product_key"),
        F.lit(2).alias("quantity"), F.lit("1.50").cast("decimal(18,2)").alias("total_amount"),
    )
    product = spark.range(500).select(F.col("id").alias("product_key"), F.lit("p").alias("product_name"))
    logins = spark.range(6000).select((F.col("id") % 2000).alias("customer_key"), F.lit("UK").alias("country"), F.lit(1).alias("logins"))
    sums = reports.units_revenue(sales, product, reports.held_customers(reports.primary_country(logins)))
    assert "skew=true" in final_plan(sums)
    row = sums.first()
    assert (row.total_units_sold, float(row.total_revenue)) == (2 * n, 1.5 * n)


def test_hot_groups_are_counted_before_the_shuffle(spark):
    i = inputs(spark, SF_DIR)
    for df in (
        quality.reject_counts(i.rejects()),
        reports.logins_by_device(i.gold("fact_web_activity"), i.gold("dim_device")),
        star.distinct_devices(i.good_web()),
    ):
        below = plan(df).split("Exchange hashpartitioning", 1)[1]
        assert "HashAggregate" in below


def test_a_side_is_broadcast_by_rows_and_by_bytes(spark):
    narrow = spark.range(1000)
    wide = narrow.select("id", F.repeat(F.lit("x"), 2000).alias("name"))
    nested = narrow.select("id", F.array_repeat(F.struct(F.lit("y" * 500).alias("v"), F.lit(1).alias("n")), 4).alias("all"))
    hinted = lambda df, **bounds: "hint" in session.broadcast_if_small(df, **bounds)._jdf.queryExecution().logical().toString().lower()
    assert hinted(narrow) and hinted(wide) and hinted(nested) and hinted(narrow.limit(0))
    assert not hinted(narrow, rows=999) and hinted(narrow, rows=1000)
    for df in (wide, nested):
        assert not hinted(df, size=2_000_000) and hinted(df, size=2_200_000)
    holes = spark.sql("select cast(null as string) as s, cast(null as array<string>) as a, cast(null as struct<x:string>) as t, cast(null as binary) as b")
    assert hinted(holes) and not hinted(holes, size=10)
