"""Loads that read only what came after the last committed mark."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import fixed, schemas
from strata.operators import conform, quality
from strata.plans import fixtures, load
from strata.plans.inputs import inputs
from strata.sources import files

SF_DIR = "/root/testdata/sf0.001"
FIRST, SECOND = datetime(1997, 1, 1), datetime(2030, 1, 1)


def make_sources(spark, broken=()):
    i = inputs(spark, SF_DIR)
    leads = i.leads_dir

    def given(table):
        if table in broken:
            raise OSError("the source is away")
        return i.raw(table)

    raw = {t: (lambda t=t: given(t)) for t in ("companies", "end_customers", "products", "orders", "order_items", "weblogs")}
    return raw | {"marketing_leads": lambda: files.read_leads(spark, leads)}


def run(spark, root, now, broken=(), marks=load.BY_TIME):
    return load.run_load(spark, root, make_sources(spark, broken), fixtures.AS_OF, now, marks=marks)


def order_times(w, batch_id):
    return w.bronze("orders", batch_id).agg(F.min("order_timestamp"), F.max("order_timestamp"), F.count("*")).first()


def test_second_load_reads_beyond_the_mark_and_facts_stay(spark, tmp_path):
    root = str(tmp_path / "w")
    w = load.Warehouse(spark, root)
    all_orders = inputs(spark, SF_DIR).raw("orders")
    early, late = (all_orders.filter(F.col("order_timestamp") <= F.lit(FIRST).cast("timestamp_ntz")), all_orders.filter(F.col("order_timestamp") > F.lit(FIRST).cast("timestamp_ntz")))

    assert run(spark, root, FIRST) == (1, ["bronze", "silver", "gold"])
    assert w.committed_mark(fixed.LOAD_NAME) == FIRST and order_times(w, 1)[2] == early.count() > 0

    with pytest.raises(OSError):
        run(spark, root, SECOND, broken=("weblogs",))
    assert w.committed_mark(fixed.LOAD_NAME) == FIRST  # nothing was taken in
    assert run(spark, root, SECOND) == (2, ["bronze", "silver", "gold"])  # its own window again
    low, _, n = order_times(w, 2)
    assert low > FIRST and n == late.count() and w.committed_mark(fixed.LOAD_NAME) == SECOND
    items = w.bronze("order_items", 2)
    assert items.join(w.bronze("orders", 2), "order_id", "left_anti").count() == 0
    assert items.count() == inputs(spark, SF_DIR).raw("order_items").join(late, "order_id", "left_semi").count()

    # together the two loads hold what one load of everything holds
    whole = str(tmp_path / "whole")
    assert run(spark, whole, SECOND, marks=None) == (1, ["bronze", "silver", "gold"])
    other = load.Warehouse(spark, whole)
    assert other.committed_mark(fixed.LOAD_NAME) is None  # a load without marks sets none
    for table in ("fact_sales", "fact_web_activity"):
        key = [f.name for f in schemas.GOLD[table].fields if f.name.startswith("source_")][0]
        assert sorted(r[0] for r in w.gold(table).select(key).collect()) == sorted(r[0] for r in other.gold(table).select(key).collect())

    assert run(spark, root, SECOND, marks=None)[0] == 3
    assert w.committed_mark(fixed.LOAD_NAME) == SECOND  # and leaves an old one standing


def test_a_batch_that_failed_later_keeps_its_mark(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    with monkeypatch.context() as m:
        m.setattr(load, "load_silver", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run(spark, root, FIRST)
    w = load.Warehouse(spark, root)
    taken = order_times(w, 1)
    assert run(spark, root, SECOND) == (1, ["silver", "gold"]) and order_times(w, 1) == taken
    assert w.committed_mark(fixed.LOAD_NAME) == FIRST


def test_lines_are_copied_by_the_orders_that_were_copied(spark, tmp_path):
    """An order that arrives while the load runs is left to the next one with all of its lines; the source's orders are read once."""
    i = inputs(spark, SF_DIR)
    reads = []

    def orders():
        reads.append("orders")
        return i.raw("orders") if len(reads) > 1 else i.raw("orders").filter("order_id % 5 <> 0")

    w = load.Warehouse(spark, str(tmp_path / "w"))
    only = ("order_items", "orders")
    load.load_bronze(w, {"orders": orders, "order_items": lambda: i.raw("order_items")}, 1, SECOND, "exact", load.BY_TIME, FIRST, only)
    assert reads == ["orders"]
    items, copied = w.bronze("order_items", 1), w.bronze("orders", 1)
    assert copied.filter("order_id % 5 = 0").count() == 0
    assert items.count() == i.raw("order_items").join(copied, "order_id", "left_semi").count() > 0
    assert w.counted(1) == {("orders", "raw"): copied.count(), ("order_items", "raw"): items.count()}


def test_spans_of_the_copied_keys_reach_the_scan_of_the_lines(spark, conf, tmp_path, monkeypatch):
    conf("spark.sql.maxMetadataStringLength", "1000")
    seen = []
    write = files.write_full
    monkeypatch.setattr(files, "write_full", lambda df, path, *a, **k: (seen.append((path, df._jdf.queryExecution().executedPlan().toString())), write(df, path, *a, **k))[1])
    spark.range(5_000).select(F.col("id").cast("int").alias("order_id"), F.timestamp_seconds(F.col("id") * 86_400).cast("timestamp_ntz").alias("order_timestamp")).write.parquet(str(tmp_path / "orders"))
    spark.range(15_000).select(F.col("id").cast("int").alias("line"), F.expr("cast(id div 3 as int)").alias("order_id")).write.parquet(str(tmp_path / "items"))
    sources = {"orders": lambda: spark.read.parquet(str(tmp_path / "orders")), "order_items": lambda: spark.read.parquet(str(tmp_path / "items"))}
    filled = lambda df, schema, _: df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    monkeypatch.setattr(conform, "align_schema", filled)
    w = load.Warehouse(spark, str(tmp_path / "w"))
    load.load_bronze(w, sources, 1, datetime(1979, 1, 1), "exact", load.BY_TIME, datetime(1978, 1, 1), ("orders", "order_items"))
    plan = next(p for path, p in seen if path.endswith("order_items"))
    assert "GreaterThanOrEqual(order_id,2923)" in plan and "LessThanOrEqual(order_id,3287)" in plan
    assert w.bronze("order_items", 1).count() == 3 * w.bronze("orders", 1).count() == 3 * 365


def test_marks_that_wait_for_each_other_are_refused(spark, tmp_path):
    w = load.Warehouse(spark, str(tmp_path / "w"))
    marks = {"orders": load.Mark("order_id", of="order_items"), "order_items": load.Mark("order_id", of="orders")}
    with pytest.raises(ValueError, match="wait for each other"):
        load.load_bronze(w, {}, 1, SECOND, "exact", marks, None, ("orders", "order_items"))


def test_the_bound_reaches_the_scan(spark, tmp_path):
    rows = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 86_400).cast("timestamp_ntz").alias("at"))
    rows.write.parquet(str(tmp_path / "t"))
    taken = conform.beyond(spark.read.parquet(str(tmp_path / "t")), "at", datetime(1971, 1, 1), datetime(1972, 1, 1))
    pushed = re.search(r"PushedFilters: \[(.*)\], ReadSchema", taken._jdf.queryExecution().executedPlan().toString())[1]
    assert "GreaterThan(at" in pushed and "LessThanOrEqual(at" in pushed
    assert taken.agg(F.min("id"), F.max("id")).first() == (366, 730)
    untimed = spark.sql("select 1 as id, cast(null as timestamp_ntz) as at")
    assert conform.beyond(untimed, "at", FIRST, SECOND).count() == 1


def test_rejected_rows_as_variants(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.createDataFrame([(1, -5, "x"), (2, None, None)], "id int, quantity int, note string")
    records = quality.quarantine(rows, "Sales", "bad", 7)
    torn = records.limit(1).withColumn("raw_record", F.lit('{"id":3,"quan'))
    files.append_quarantine(records.unionByName(torn), path, 7)
    read = files.read_quarantine(spark, path, parsed=True)
    assert read.schema["record"].dataType.simpleString() == "variant" and read.filter("record is null").count() == 1
    fields = "id int, quantity int, note string, other date"
    from pyspark.sql.types import StructType

    got = quality.rejected_fields(read, StructType.fromDDL(fields), "Sales")
    assert sorted(map(repr, (tuple(r) for r in got.select("id", "quantity", "note", "other").collect()))) == sorted(
        map(repr, [(1, -5, "x", None), (2, None, None, None), (None, None, None, None)])
    )
    assert got.columns == [*schemas.QUARANTINE.names, "id", "quantity", "note", "other"]  # the text stays
    read.write.parquet(str(tmp_path / "variants"))
    back = spark.read.parquet(str(tmp_path / "variants"))
    assert {(r.quantity, r.rejected) for r in quality.reject_reasons(back, "quantity").collect()} == {("-5", 1), (None, 2)}
    # values compare as numbers
    assert back.filter(F.try_variant_get("record", "$.quantity", "int") < 0).count() == 1
