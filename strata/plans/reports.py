"""The three reports, and the aggregates they are built from.

Facts are aggregated by surrogate key before they meet a dimension wherever that makes them smaller; hot keys are then already reduced
on the map side. Ranks are numbered over the aggregate in range partitions, never over one unpartitioned window, unless a top-n bounds them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import date_key, month_start
from strata.operators.conform import since
from strata.operators.numbering import number_rows
from strata.schemas import DAY_MONEY, REPORT_MONEY
from strata.session import materialize


def web_device(fact_web: DataFrame, dim_device: DataFrame) -> DataFrame:
    return fact_web.join(dim_device, "device_key")


def web_geo(fact_web: DataFrame, dim_geo: DataFrame) -> DataFrame:
    return fact_web.join(dim_geo, "geo_key")


def sales_date(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The calendar has one row per day, a few thousand at most, so it is always broadcast."""
    return fact_sales.join(F.broadcast(dim_date), "date_key")


def logins_by_device(fact_web: DataFrame, dim_device: DataFrame) -> DataFrame:
    by_key = fact_web.groupBy("device_key").agg(F.count("*").alias("logins"))
    return by_key.join(dim_device, "device_key").groupBy("device_type").agg(F.sum("logins").alias("total_logins"))


def customer_country_logins(fact_web: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """Logins per customer (NULL for unknown accounts) and country."""
    by_key = fact_web.groupBy("customer_key", "geo_key").agg(F.count("*").alias("logins"))
    located = by_key.join(dim_geo.select("geo_key", "country"), "geo_key")
    return located.groupBy("customer_key", "country").agg(F.sum("logins").alias("logins"))


def logins_by_country(fact_web: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """One column of the fact is read; what is shuffled is a count for each address."""
    by_key = fact_web.groupBy("geo_key").agg(F.count("*").alias("logins"))
    return by_key.join(dim_geo.select("geo_key", "country"), "geo_key").groupBy("country").agg(F.sum("logins").alias("logins"))


def logins_by_customer_country(logins: DataFrame) -> DataFrame:
    return logins.filter(F.col("customer_key").isNotNull())


def top_country(by_country: DataFrame) -> DataFrame:
    """One row; among equals the first name."""
    return by_country.orderBy(F.desc("logins"), F.asc("country")).limit(1)


def primary_country(by_customer_country: DataFrame) -> DataFrame:
    """Each customer's country with most logins, the first name among equals: an aggregate, reduced before the shuffle."""
    order = F.struct((-F.col("logins")).alias("fewest_first"), F.col("country"))
    return by_customer_country.groupBy("customer_key").agg(F.min_by("country", order).alias("country"))


def held_customers(customer_country: DataFrame) -> DataFrame:
    """Customers and countries as a written table. Sales join it on the customer: Spark then knows its size, and where it is too large to
    broadcast both sides are plain shuffles, the form in which adaptive execution can split a hot customer's sales."""
    return materialize(customer_country, "customers")


def in_top_country(primary: DataFrame, top: DataFrame) -> DataFrame:
    """Customers at home in the top country: an equality join with one row instead of a cross join and filter."""
    return primary.join(F.broadcast(top.select("country")), "country").select("customer_key", "country")


def sales_product_country(fact_sales: DataFrame, dim_product: DataFrame, customer_country: DataFrame) -> DataFrame:
    """`customer_country` should be held (see above)."""
    return fact_sales.join(customer_country, "customer_key").join(dim_product.select("product_key", "product_name"), "product_key")


def units_revenue(fact_sales: DataFrame, dim_product: DataFrame, customer_country: DataFrame) -> DataFrame:
    """Units and revenue per country and product name; sums per product key come first, so products join their few sums only."""
    by_key = (
        fact_sales.join(customer_country, "customer_key")
        .groupBy("country", "product_key")
        .agg(F.sum("quantity").alias("units"), F.sum("total_amount").alias("amount"))
    )
    named = by_key.join(dim_product.select("product_key", "product_name"), "product_key")
    return named.groupBy("country", "product_name").agg(
        F.sum("units").cast("bigint").alias("total_units_sold"), F.sum("amount").cast(REPORT_MONEY).alias("total_revenue")
    )


def _largest_first(amount: str, name: str) -> list[Column]:
    return [F.desc_nulls_first(amount), F.desc_nulls_first(name)]


def rank_all(aggregate: DataFrame, amount: str, name: str) -> DataFrame:
    """`rank_no` over a whole aggregate of any size: amount downwards, then name downwards."""
    ranked = number_rows(aggregate, _largest_first(amount, name), "rank_no")
    return ranked.select(F.col("rank_no").cast("int").alias("rank_no"), *aggregate.columns)


def rank_top(aggregate: DataFrame, amount: str, name: str, n: int) -> DataFrame:
    """The first `n` ranks. Top-n first, so the window sees n rows."""
    order = _largest_first(amount, name)
    top = aggregate.orderBy(*order).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank_no"), *aggregate.columns)


def _by_month(dated: DataFrame, amount: str, **sums: Column) -> DataFrame:
    """Aggregates `sums` and monthly_revenue, the sum of `amount`, of each month: REPORT_MONEY, or where a month has more than that holds, as
    wide as it is summed up. Which of them is seen from sums by month alone, reduced before the shuffle, ahead of the rest."""
    month = [month_start(F.col("full_date")).alias("month_start"), "year", "month", "month_name"]
    total = F.sum(amount)
    most = dated.groupBy(*month).agg(total.alias("total")).agg(F.max(F.abs("total"))).first()[0]
    fits = most is None or most < 10 ** (REPORT_MONEY.precision - REPORT_MONEY.scale)
    revenue = total.cast(REPORT_MONEY) if fits else total
    return dated.groupBy(*month).agg(*[c.alias(n) for n, c in sums.items()], revenue.alias("monthly_revenue"))


def by_month(dated_sales: DataFrame) -> DataFrame:
    return _by_month(
        dated_sales, "total_amount", total_orders=F.count_distinct("source_order_id"), total_items_sold=F.sum("quantity").cast("bigint")
    )


def top_devices(fact_web: DataFrame, dim_device: DataFrame, n: int = 5) -> DataFrame:
    return rank_top(logins_by_device(fact_web, dim_device), "total_logins", "device_type", n)


def top_products(
    fact_web: DataFrame, fact_sales: DataFrame, dim_geo: DataFrame, dim_product: DataFrame, logins: DataFrame | None = None
) -> DataFrame:
    """Products bought by customers whose main country is the country with most logins. Give `logins` (customer_country_logins) when it
    is already held. The web fact is shuffled by customer once, without the rows that have none."""
    if logins is None:
        logins = customer_country_logins(fact_web, dim_geo)
    top = top_country(logins_by_country(fact_web, dim_geo))
    customers = held_customers(in_top_country(primary_country(logins_by_customer_country(logins)), top))
    return rank_all(units_revenue(fact_sales, dim_product, customers), "total_units_sold", "product_name")


def monthly_sales(fact_sales: DataFrame, dim_date: DataFrame, as_of: date) -> DataFrame:
    """Newest month first. The bound on the fact's own key repeats what the calendar join implies, so that files outside it are skipped."""
    first_key = date_key(F.add_months(F.lit(as_of), -12))
    recent = fact_sales.filter(F.col("date_key") >= first_key)
    days = since(dim_date, "full_date", as_of, 12).select("date_key", "full_date", "year", "month", "month_name")
    return month_order(by_month(sales_date(recent, days)))


def sales_days(fact_sales: DataFrame) -> DataFrame:
    """Orders, units and revenue of each day of the fact: what the monthly report is summed up from. An order lies on one day, so its
    counts add up; `split_orders` tells how many do not: those on several days of the day's month, of which it is the first. Rows are shuffled
    once, as one for each order and month."""
    by_order = fact_sales.filter(F.col("date_key").isNotNull()).groupBy(F.expr("date_key div 100").alias("month"), "source_order_id").agg(
        F.min("date_key").alias("date_key"), F.max("date_key").alias("last"), F.sum("quantity").alias("units"), F.sum("total_amount").alias("amount")
    )
    return by_order.groupBy("date_key").agg(
        F.count("source_order_id").alias("orders"), F.sum("units").alias("units"), F.sum("amount").cast(DAY_MONEY).alias("amount"),
        F.count_if(F.col("date_key") < F.col("last")).alias("split_orders"),
    )


def monthly_from_days(days: DataFrame, dim_date: DataFrame, as_of: date) -> DataFrame:
    """`monthly_sales` from a row a day instead of the fact."""
    calendar = since(dim_date, "full_date", as_of, 12).select("date_key", "full_date", "year", "month", "month_name")
    dated = days.filter(F.col("date_key") >= date_key(F.add_months(F.lit(as_of), -12))).join(F.broadcast(calendar), "date_key")
    return month_order(_by_month(dated, "amount", total_orders=F.sum("orders"), total_items_sold=F.sum("units").cast("bigint")))


def month_order(months: DataFrame) -> DataFrame:
    return months.orderBy(F.desc("month_start"))


def report_top(report: DataFrame, order_cols: list, n: int = 5) -> DataFrame:
    return report.orderBy(*order_cols).limit(n)
