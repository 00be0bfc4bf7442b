"""Column expressions. All are built-in functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import fixed


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer; computed from the parts, without formatting text."""
    day = day.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def month_start(day: Column) -> Column:
    return F.trunc(day.cast("date"), "MM").cast("date")


def age_in_years(as_of: date, born: Column) -> Column:
    return F.floor(F.months_between(F.lit(as_of), born.cast("date")) / 12)


def mapped_customer(username: Column) -> Column:
    """Customer id of a customer account; NULL for other accounts, without digits, or beyond the int range."""
    number = F.regexp_extract(username, fixed.CUSTOMER_NUMBER, 1)
    return F.when(F.startswith(username, F.lit(fixed.CUSTOMER_PREFIX)), number.try_cast("int"))


def device_type(user_agent: Column) -> Column:
    return (
        F.when(user_agent.ilike(fixed.MOBILE_MARK), fixed.MOBILE)
        .when(user_agent.ilike(fixed.TABLET_MARK), fixed.TABLET)
        .otherwise(fixed.DESKTOP)
    )


def _place(names: list[str], ip: Column) -> Column:
    # Widened before abs: the smallest int has no positive counterpart.
    index = F.abs(F.hash(ip).cast("bigint")) % len(names)
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def country(ip: Column) -> Column:
    return _place(fixed.COUNTRIES, ip)


def city(ip: Column) -> Column:
    return _place(fixed.CITIES, ip)


def whole_number(text: Column) -> Column:
    """Text as an int: a decimal part is cut off, anything else but digits gives NULL."""
    return F.regexp_replace(text, r"^\s*([+-]?)(\d*)\.\d*\s*$", "$10$2").try_cast("int")


def fixed_time(when: datetime) -> Column:
    """A zone-free timestamp literal. Made from text: a plain literal would be read in one zone and written in another."""
    return F.lit(str(when)).cast("timestamp_ntz")


def wall_clock(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` text as a zone-free timestamp; NULL for any other text or an impossible time."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def row_hash(columns: list[str], null_safe: bool = False) -> Column:
    """md5 of the joined text. Joining skips NULLs, so `null_safe` can mark them to keep ('a', NULL) and (NULL, 'a') apart."""
    parts = [F.col(c).cast("string") for c in columns]
    if null_safe:
        parts = [F.coalesce(F.concat(F.lit("="), p), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws(fixed.HASH_SEPARATOR, *parts))
