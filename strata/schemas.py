"""Explicit schema of every table, per layer."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(12, 2)
LINE_AMOUNT = DecimalType(18, 2)
REPORT_MONEY = DecimalType(14, 2)
DAY_MONEY = DecimalType(28, 2)

_long, _int, _text, _flag, _day, _time = LongType(), IntegerType(), StringType(), BooleanType(), DateType(), TimestampNTZType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


LEADS_CSV = _schema(lead_id=_text, full_name=_text, email=_text, company_name=_text, lead_score=_text, acquired_at=_text)
LOG_LINES = _schema(raw_line=_text)

BRONZE = {
    "companies": _schema(company_id=_long, cuit=_text, company_name=_text, is_supplier=_flag, batch_id=_long),
    "end_customers": _schema(customer_id=_long, document_number=_text, full_name=_text, date_of_birth=_day, batch_id=_long),
    "products": _schema(product_id=_long, supplier_id=_long, product_name=_text, default_price=MONEY, batch_id=_long),
    "orders": _schema(order_id=_long, company_id=_long, customer_id=_long, order_timestamp=_time, batch_id=_long),
    "order_items": _schema(order_item_id=_long, order_id=_long, product_id=_long, quantity=_int, unit_price=MONEY, batch_id=_long),
    "weblogs": _schema(log_id=_long, client_ip=_text, username=_text, request_time=_time, user_agent=_text, batch_id=_long),
    "marketing_leads": _schema(
        lead_id=_text, full_name=_text, email=_text, company_name=_text, lead_score=_text, acquired_at=_text, source_file=_text,
        source_line_number=_long, row_hash=_text, ingested_at=_time, is_processed=_flag, batch_id=_long,
    ),
}

WEBLOG_ROWS = _schema(
    log_id=_long, client_ip=_text, username=_text, request_time=_time, user_agent=_text, raw_line=_text, source_file=_text, source_line_number=_long
)

SILVER = {
    "companies": _schema(source_company_id=_long, cuit=_text, company_name=_text, is_supplier=_flag, batch_id=_long),
    "customers": _schema(
        source_customer_id=_long, document_number=_text, full_name=_text, date_of_birth=_day, age=_long, batch_id=_long
    ),
    "products": _schema(source_product_id=_long, source_supplier_id=_long, product_name=_text, default_price=MONEY, batch_id=_long),
    "sales_order_lines": _schema(
        source_order_item_id=_long, source_order_id=_long, source_company_id=_long, source_customer_id=_long, source_product_id=_long,
        order_timestamp=_time, quantity=_int, unit_price=MONEY, total_amount=LINE_AMOUNT, batch_id=_long,
    ),
    "web_activity": _schema(
        source_log_id=_long, client_ip=_text, username=_text, request_time=_time, user_agent=_text, batch_id=_long,
        mapped_customer_id=_int, device_type=_text, country=_text, city=_text,
    ),
    "marketing_leads": _schema(
        lead_id=_text, full_name=_text, email=_text, company_name=_text, source_file=_text, source_line_number=_long, row_hash=_text,
        ingested_at=_time, is_processed=_flag, batch_id=_long, lead_score=_int, acquired_at=_time,
    ),
}

QUARANTINE = _schema(batch_id=_long, job_name=_text, source_name=_text, error_reason=_text, raw_record=_text)

GOLD = {
    "dim_company": _schema(company_key=_long, source_company_id=_long, cuit=_text, company_name=_text, is_supplier=_flag),
    "dim_customer": _schema(
        customer_key=_long, source_customer_id=_long, document_number=_text, full_name=_text, date_of_birth=_day, age=_long
    ),
    "dim_product": _schema(
        product_key=_long, source_product_id=_long, source_supplier_id=_long, product_name=_text, default_price=MONEY
    ),
    "dim_device": _schema(device_key=_long, device_type=_text),
    "dim_geo": _schema(geo_key=_long, ip_address=_text, country=_text, city=_text),
    "dim_date": _schema(date_key=_int, full_date=_day, year=_int, quarter=_int, month=_int, month_name=_text, day=_int),
    "fact_sales": _schema(
        source_order_item_id=_long, source_order_id=_long, date_key=_int, company_key=_long, customer_key=_long, product_key=_long,
        quantity=_int, unit_price=MONEY, total_amount=LINE_AMOUNT, etl_batch_id=_long, updated_at=_time,
    ),
    "fact_web_activity": _schema(
        source_log_id=_long, date_key=_int, geo_key=_long, device_key=_long, customer_key=_long, request_time=_time, etl_batch_id=_long
    ),
    "fact_marketing_lead": _schema(
        source_lead_id=_text, date_key=_int, company_name=_text, lead_score=_int, etl_batch_id=_long
    ),
}

REPORTS = {
    "report_top_devices": _schema(rank_no=_int, device_type=_text, total_logins=_long),
    "report_top_products_in_top_country": _schema(
        rank_no=_int, country=_text, product_name=_text, total_units_sold=_long, total_revenue=REPORT_MONEY
    ),
    "report_monthly_sales_last_year": _schema(
        month_start=_day, year=_int, month=_int, month_name=_text, total_orders=_long, total_items_sold=_long,
        monthly_revenue=REPORT_MONEY,
    ),
}

AUDIT = {
    "batch_events": _schema(seq=_long, batch_id=_long, pipeline_name=_text, status=_text, event_time=_time, error_message=_text),
    "job_events": _schema(seq=_long, job_run_id=_long, batch_id=_long, job_name=_text, status=_text, event_time=_time, error_message=_text),
    "layer_events": _schema(
        seq=_long, pipeline_name=_text, layer_name=_text, last_watermark=_time, batch_id=_long, status=_text, event_time=_time
    ),
}

# One row per published version of a merged table: which data directories it consists of.
# Which state of a log file has been loaded: a file of another length or time is looked at again.
LOG_FILES = _schema(file=_text, length=_long, modified=_time)

VERSIONS = _schema(
    version=_long, published_at=_time, entries=ArrayType(_schema(data_version=_long, part=_long)), stream=_text, stream_batch=_long
)
# What the monthly report is summed up from: a row a day, with the version of the fact's month that it was taken from.
SALES_DAYS = _schema(date_key=IntegerType(), orders=_long, units=_long, amount=DAY_MONEY, fact_version=_long)
