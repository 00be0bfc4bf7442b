"""Dimensions and facts of the star schema. Every function takes the current table and the conformed rows and returns the merged table.

Sales carry more rows and columns than all else, so the key pairs of their dimensions are counted and broadcast up to a fixed size, whatever
the session's limit. Other joins carry no broadcast hints: dimensions are read from written tables, whose size Spark knows and checks
against its broadcast limit. Beyond these sizes a join shuffles, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import date_key, fixed_time
from strata.operators.conform import for_batch
from strata.operators.merge import Keyed, all_new, keyed_merge, merged
from strata.session import broadcast_if_small

#: Pairs of natural and surrogate key that are broadcast to sales: as many as 64 MB hold.
KEY_PAIRS = 2_000_000

SALES_UPDATES = ("quantity", "total_amount", "etl_batch_id", "updated_at")
# Of log rows with one id the earliest counts; the further columns only make the choice definite.
WEB_FIRST = ("request_time", "geo_key", "device_key", "customer_key", "etl_batch_id", "date_key")
LEAD_UPDATES = ("date_key", "company_name", "lead_score", "etl_batch_id")


def company_merge(target: DataFrame, silver: DataFrame) -> Keyed:
    rows = silver.select("source_company_id", "cuit", "company_name", "is_supplier")
    return keyed_merge(target, rows, "source_company_id", "company_key", ["cuit", "company_name", "is_supplier"])


def customer_merge(target: DataFrame, silver: DataFrame) -> Keyed:
    """A known customer keeps the birth date it came with."""
    rows = silver.select("source_customer_id", "document_number", "full_name", "date_of_birth", "age")
    return keyed_merge(target, rows, "source_customer_id", "customer_key", ["document_number", "full_name", "age"])


def product_merge(target: DataFrame, silver: DataFrame) -> Keyed:
    """A known product keeps its supplier."""
    rows = silver.select("source_product_id", "source_supplier_id", "product_name", "default_price")
    return keyed_merge(target, rows, "source_product_id", "product_key", ["product_name", "default_price"])


def distinct_devices(web: DataFrame) -> DataFrame:
    return web.select("device_type").distinct()


def distinct_geo(web: DataFrame) -> DataFrame:
    return web.filter(F.col("client_ip").isNotNull()).select("client_ip", "country", "city").distinct()


def device_merge(target: DataFrame, silver_web: DataFrame) -> Keyed:
    return keyed_merge(target, distinct_devices(silver_web), "device_type", "device_key", [])


def geo_merge(target: DataFrame, silver_web: DataFrame) -> Keyed:
    rows = distinct_geo(silver_web).withColumnRenamed("client_ip", "ip_address")
    return keyed_merge(target, rows, "ip_address", "geo_key", ["country", "city"])


def calendar(spark, as_of: date) -> DataFrame:
    """One row per day from two years before `as_of` to one year after it."""
    days = F.sequence(F.add_months(F.lit(as_of), -24), F.add_months(F.lit(as_of), 12), F.expr("interval 1 day"))
    day = F.col("full_date")
    return spark.range(1).select(F.explode(days).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
    )


def date_actions(target: DataFrame, as_of: date) -> DataFrame:
    return merged(target, calendar(target.sparkSession, as_of), ["date_key"], [])


def _sales_keys(lines: DataFrame, company: DataFrame, customer: DataFrame, product: DataFrame, how: str) -> DataFrame:
    def pairs(dimension: DataFrame, name: str) -> DataFrame:
        return broadcast_if_small(dimension.select(f"source_{name}_id", f"{name}_key"), KEY_PAIRS)

    return (
        lines.join(pairs(company, "company"), "source_company_id", how)
        .join(pairs(customer, "customer"), "source_customer_id", how)
        .join(pairs(product, "product"), "source_product_id", how)
    )


def fact_sales_lookup(lines: DataFrame, company: DataFrame, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Order lines with dimension keys; a line without one of its dimension rows is left out."""
    return _sales_keys(lines, company, customer, product, "inner").select(
        "source_order_item_id",
        "source_order_id",
        date_key(F.col("order_timestamp")).alias("date_key"),
        "company_key",
        "customer_key",
        "product_key",
        "quantity",
        "unit_price",
        "total_amount",
        F.col("batch_id").alias("etl_batch_id"),
    )


def unmatched_lines(lines: DataFrame, company: DataFrame, customer: DataFrame, product: DataFrame) -> DataFrame:
    """The lines `fact_sales_lookup` leaves out."""
    lacking = F.col("company_key").isNull() | F.col("customer_key").isNull() | F.col("product_key").isNull()
    return _sales_keys(lines, company, customer, product, "left").filter(lacking).select(*lines.columns)


def fact_web_lookup(activity: DataFrame, geo: DataFrame, device: DataFrame, customer: DataFrame) -> DataFrame:
    """Log rows with dimension keys; the customer key is NULL for unknown accounts.

    Rows without an account match no customer, so they stay out of that join: they would all be shuffled to one task.
    """
    located = activity.join(device.select("device_type", "device_key"), "device_type").join(
        geo.select(F.col("ip_address").alias("client_ip"), "geo_key"), "client_ip"
    )
    columns = [
        "source_log_id",
        date_key(F.col("request_time")).alias("date_key"),
        "geo_key",
        "device_key",
        "customer_key",
        "request_time",
        F.col("batch_id").alias("etl_batch_id"),
    ]
    accounts = customer.select(F.col("source_customer_id").alias("mapped_customer_id"), "customer_key")
    named = located.filter(F.col("mapped_customer_id").isNotNull()).join(accounts, "mapped_customer_id", "left")
    nobody = F.lit(None).cast(customer.schema["customer_key"].dataType).alias("customer_key")
    unnamed = located.filter(F.col("mapped_customer_id").isNull()).select(*activity.columns, "geo_key", "device_key", nobody)
    return named.select(*columns).unionByName(unnamed.select(*columns))


def sales_rows(lines: DataFrame, company: DataFrame, customer: DataFrame, product: DataFrame, now: datetime) -> DataFrame:
    return fact_sales_lookup(lines, company, customer, product).withColumn("updated_at", fixed_time(now))


def lead_rows(silver: DataFrame, batch_id: int) -> DataFrame:
    return for_batch(silver, batch_id).select(
        F.col("lead_id").alias("source_lead_id"),
        date_key(F.col("acquired_at")).alias("date_key"),
        "company_name",
        "lead_score",
        F.col("batch_id").alias("etl_batch_id"),
    )


def sales_actions(
    target: DataFrame, silver: DataFrame, company: DataFrame, customer: DataFrame, product: DataFrame, now: datetime,
    update_cols: tuple[str, ...] = SALES_UPDATES, updates_rows: int | None = None,
) -> DataFrame:
    """Without `unit_price` in `update_cols` (the default) a changed price shows in the amount only. The first sales of all are written."""
    rows = sales_rows(silver, company, customer, product, now)
    if target.isEmpty():
        return all_new(target, rows, ["source_order_item_id"])
    return merged(target, rows, ["source_order_item_id"], update_cols, updates_rows=updates_rows)


def web_actions(target: DataFrame, silver: DataFrame, geo: DataFrame, device: DataFrame, customer: DataFrame) -> DataFrame:
    rows = fact_web_lookup(silver, geo, device, customer)
    return merged(target, rows, ["source_log_id"], [], on_duplicate="first", first_by=WEB_FIRST)


def lead_actions(target: DataFrame, silver: DataFrame, batch_id: int, updates_rows: int | None = None) -> DataFrame:
    return merged(target, lead_rows(silver, batch_id), ["source_lead_id"], LEAD_UPDATES, updates_rows=updates_rows)


def dim_company(target: DataFrame, silver: DataFrame) -> DataFrame:
    return company_merge(target, silver).rows.drop("_action")


def dim_customer(target: DataFrame, silver: DataFrame) -> DataFrame:
    return customer_merge(target, silver).rows.drop("_action")


def dim_product(target: DataFrame, silver: DataFrame) -> DataFrame:
    return product_merge(target, silver).rows.drop("_action")


def dim_device(target: DataFrame, silver_web: DataFrame) -> DataFrame:
    return device_merge(target, silver_web).rows.drop("_action")


def dim_geo(target: DataFrame, silver_web: DataFrame) -> DataFrame:
    return geo_merge(target, silver_web).rows.drop("_action")


def dim_date(target: DataFrame, as_of: date) -> DataFrame:
    return date_actions(target, as_of).drop("_action")


def fact_sales(target, silver, company, customer, product, now, update_cols=SALES_UPDATES) -> DataFrame:
    return sales_actions(target, silver, company, customer, product, now, update_cols).drop("_action")


def fact_web_activity(target, silver, geo, device, customer) -> DataFrame:
    return web_actions(target, silver, geo, device, customer).drop("_action")


def fact_marketing_lead(target, silver, batch_id) -> DataFrame:
    return lead_actions(target, silver, batch_id).drop("_action")
