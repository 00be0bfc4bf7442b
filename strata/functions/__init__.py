from strata.functions.columns import (
    age_in_years,
    city,
    country,
    date_key,
    device_type,
    fixed_time,
    mapped_customer,
    month_start,
    row_hash,
    wall_clock,
    whole_number,
)

__all__ = [
    "age_in_years",
    "city",
    "country",
    "date_key",
    "device_type",
    "fixed_time",
    "mapped_customer",
    "month_start",
    "row_hash",
    "wall_clock",
    "whole_number",
]
