"""Projections that turn raw rows into conformed rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata import fixed
from strata.functions import (
    age_in_years,
    city,
    country,
    device_type,
    fixed_time,
    mapped_customer,
    row_hash,
    wall_clock,
    whole_number,
)
from strata.operators.numbering import with_line_numbers
from strata.schemas import LINE_AMOUNT


def stamp_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def for_batch(df: DataFrame, batch_id: int) -> DataFrame:
    """Rows of one batch. On tables partitioned by batch this prunes whole directories."""
    return df.filter(F.col("batch_id") == F.lit(batch_id).cast("bigint"))


def beyond(df: DataFrame, column: str, after: datetime | None, until: datetime) -> DataFrame:
    """Rows whose time lies after one mark and not after another, and rows without a time, which no mark can tell to be known. The bounds
    are literals, so a scan of a database or of Parquet files gets them. after: None for all up to `until`."""
    at = F.col(column)
    inside = at <= fixed_time(until)
    return df.filter(at.isNull() | (inside if after is None else (at > fixed_time(after)) & inside))


def since(df: DataFrame, day_col: str, as_of: date, months: int) -> DataFrame:
    """Rows dated `months` months before `as_of`, or later."""
    return df.filter(F.col(day_col) >= F.add_months(F.lit(as_of), -months))


def add_lineage(df: DataFrame, now: datetime, source_file: str = fixed.LEADS_ORIGIN, null_safe: bool = False) -> DataFrame:
    """Origin, record number, content hash, arrival time and processed flag. The hash covers the columns `df` came with, those of its
    file position left out."""
    return (
        with_line_numbers(df)
        .withColumn("source_file", F.lit(source_file))
        .withColumn("row_hash", row_hash([c for c in df.columns if c not in ("_file", "_block")], null_safe))
        .withColumn("ingested_at", fixed_time(now))
        .withColumn("is_processed", F.lit(False))
    )


def _matching_column(names: list[str], field: StructField, by_part: bool) -> str | None:
    wanted = field.name.lower()
    same = [n for n in names if n.lower() == wanted]
    if same:
        return same[-1]
    related = [n for n in names if n.lower() in wanted or wanted in n.lower()]
    return related[0] if by_part and related else None


def align_schema(df: DataFrame, schema: StructType, mode: str = "exact") -> DataFrame:
    """Select and cast to `schema`. "exact" matches names ignoring case and raises when one is missing. "alias" falls back to the first
    column whose name contains, or is contained in, the wanted one, and leaves out fields without a match."""
    if mode not in ("exact", "alias"):
        raise ValueError(f"unknown alignment mode: {mode}")
    pairs = [(field, _matching_column(df.columns, field, mode == "alias")) for field in schema]
    missing = [field.name for field, name in pairs if name is None]
    if mode == "exact" and missing:
        raise ValueError(f"no column for {', '.join(missing)} among {', '.join(df.columns)}")
    return df.select(*[F.col(f"`{name}`").cast(field.dataType).alias(field.name) for field, name in pairs if name is not None])


def resolve_column(df: DataFrame, options: list[str]) -> str:
    """The frame's own spelling of the first option it has, whatever the case; the first option when it has none."""
    own = {name.lower(): name for name in reversed(df.columns)}
    return next((own[o.lower()] for o in options if o.lower() in own), options[0])


def _source(df: DataFrame, name: str) -> Column:
    """Key column `name`, which raw tables may already carry with a `source_` prefix."""
    return F.col(resolve_column(df, [f"source_{name}", name]))


def companies(df: DataFrame) -> DataFrame:
    return df.select(_source(df, "company_id").alias("source_company_id"), "cuit", "company_name", "is_supplier", "batch_id")


def customers(df: DataFrame, as_of: date) -> DataFrame:
    return df.select(
        _source(df, "customer_id").alias("source_customer_id"),
        "document_number",
        "full_name",
        "date_of_birth",
        age_in_years(as_of, F.col("date_of_birth")).alias("age"),
        "batch_id",
    )


def products(df: DataFrame) -> DataFrame:
    return df.select(
        _source(df, "product_id").alias("source_product_id"),
        _source(df, "supplier_id").alias("source_supplier_id"),
        "product_name",
        "default_price",
        "batch_id",
    )


def line_amount(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast(LINE_AMOUNT)


def sales_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their order. Both sides are narrowed before the shuffle; a hot order's lines are split by adaptive execution."""
    i = items.select(
        _source(items, "order_item_id").alias("source_order_item_id"),
        _source(items, "order_id").alias("source_order_id"),
        _source(items, "product_id").alias("source_product_id"),
        "quantity",
        "unit_price",
    )
    o = orders.select(
        _source(orders, "order_id").alias("source_order_id"),
        _source(orders, "company_id").alias("source_company_id"),
        _source(orders, "customer_id").alias("source_customer_id"),
        "order_timestamp",
        "batch_id",
    )
    return i.join(o, "source_order_id").select(
        "source_order_item_id",
        "source_order_id",
        "source_company_id",
        "source_customer_id",
        "source_product_id",
        "order_timestamp",
        "quantity",
        "unit_price",
        line_amount(F.col("quantity"), F.col("unit_price")).alias("total_amount"),
        "batch_id",
    )


def web_activity(weblogs: DataFrame) -> DataFrame:
    """Log rows with customer, device and place derived from account, user agent and address."""
    return weblogs.select(
        _source(weblogs, "log_id").alias("source_log_id"),
        "client_ip",
        "username",
        "request_time",
        "user_agent",
        "batch_id",
        mapped_customer(F.col("username")).alias("mapped_customer_id"),
        device_type(F.col("user_agent")).alias("device_type"),
        country(F.col("client_ip")).alias("country"),
        city(F.col("client_ip")).alias("city"),
    )


def lead_types(leads: DataFrame) -> DataFrame:
    """Typed score and time at the end of the row; the text columns they came from are left out. Bad text becomes NULL."""
    score = resolve_column(leads, ["lead_score", "lead_score_raw"])
    time = resolve_column(leads, ["acquired_at", "acquired_at_raw"])
    kept = [c for c in leads.columns if c not in (score, time)]
    return leads.select(
        *kept,
        whole_number(F.col(score)).alias("lead_score"),
        wall_clock(F.col(time)).alias("acquired_at"),
    )
