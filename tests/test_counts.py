"""Counts that a load takes from the writes it makes anyway."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strata.operators import quality, star
from strata.plans import fixtures, load
from strata.plans.inputs import inputs
from strata.session import counted, materialize_counted
from strata.sources import files, tables

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def make_sources(spark):
    """Some orders and some customers are missing, so that rows are lost in joins."""
    i = inputs(spark, SF_DIR)
    raw = {t: (lambda t=t: i.raw(t)) for t in ("companies", "products", "order_items", "weblogs")}
    leads = i.leads_dir
    return raw | {
        "orders": lambda: i.raw("orders").filter("order_id % 7 <> 0"),
        "end_customers": lambda: i.raw("end_customers").filter("customer_id % 5 <> 0"),
        "marketing_leads": lambda: files.read_leads(spark, leads),
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("counted"))
    load.run_load(spark, root, make_sources(spark), fixtures.AS_OF, fixtures.NOW)
    return load.Warehouse(spark, root)


def test_counts_equal_what_joins_would_find(spark, loaded):
    got = {(r.table, r.outcome): r.rows for r in loaded.load_counts().filter("batch_id = 1").collect()}
    items, orders = loaded.bronze("order_items", 1), loaded.bronze("orders", 1)
    good = loaded.judged("sales_order_lines", quality.GOOD)
    dims = [loaded.gold(f"dim_{d}") for d in ("company", "customer", "product")]
    expected = {
        ("sales_order_lines", "orphan"): items.join(orders.select("order_id"), "order_id", "left_anti").count(),
        ("fact_sales", "unmatched"): star.unmatched_lines(good, *dims).count(),
        ("fact_sales", "fact"): star.fact_sales_lookup(good, *dims).count(),
        ("fact_sales", "insert"): loaded.gold("fact_sales").count(),
        ("fact_web_activity", "fact"): loaded.gold("fact_web_activity").count(),
        ("fact_web_activity", "unmatched"): 0,
        ("dim_customer", "insert"): dims[1].count(),
    }
    assert expected["sales_order_lines", "orphan"] > 0 and expected["fact_sales", "unmatched"] > 0
    assert {k: got.get(k, 0) for k in expected} == expected
    verdicts = {(r.table, r.verdict): r.rows for r in load.verdict_counts(loaded).collect()}
    assert {k: n for k, n in got.items() if k[1] in (quality.GOOD, quality.BAD, quality.UNDECIDED)} == verdicts


def test_counts_need_no_join_and_no_table(spark, loaded, monkeypatch):
    whole = load.load_counts(loaded, 1)

    def refused(*_, **__):
        raise AssertionError("a table was read or joined for counts")

    frame = type(spark.range(1))
    for name in ("bronze", "silver", "judged", "gold"):
        monkeypatch.setattr(load.Warehouse, name, refused)
    monkeypatch.setattr(frame, "join", refused)
    assert load.load_counts(loaded, 1) == whole and len(whole) > 8


def test_second_load_counts_updates(spark, tmp_path):
    root, sources = str(tmp_path / "w"), make_sources(spark)
    for _ in range(2):
        load.run_load(spark, root, sources, fixtures.AS_OF, fixtures.NOW)
    w = load.Warehouse(spark, root)
    got = {(r.batch_id, r.table, r.outcome): r.rows for r in w.load_counts().collect()}
    assert got[2, "fact_sales", "update"] == got[1, "fact_sales", "insert"] and (2, "fact_sales", "insert") not in got
    assert got[2, "dim_customer", "update"] == got[1, "dim_customer", "insert"]
    # nothing changed in the dimensions, so they have one version each
    assert tables._current(spark, w.path("gold", "dim_customer"))[0] == 1


@pytest.mark.parametrize("rows", [0, 1000])
def test_counts_of_a_write(spark, tmp_path, rows):
    df = spark.range(rows).withColumn("v", F.col("id") % 3)
    wanted = {"rows": F.count(F.lit(1)), "zeros": F.count_if(F.col("v") == 0), "last": F.max("id")}
    held, seen = materialize_counted(df, "counted", wanted)
    assert seen == {"rows": rows, "zeros": (rows + 2) // 3, "last": rows - 1 if rows else None} and held.count() == rows
    split = files.write_full(df, str(tmp_path / "split"), "v", wanted)
    assert split == seen
    tally = tables.Tally(wanted)
    tables.publish(spark, str(tmp_path / "table"), df.withColumn("date_key", F.lit(20010101)), fixtures.NOW, tables.month_part(), None, tally)
    assert tally.seen == seen
    assert counted(df, {}, lambda x: x.count()) == {}


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import functions as F
from strata.session import build_session, counted

spark = build_session("retried", **{"spark.master": "local[2,3]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"})

def flaky(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise OSError("lost after all its rows were handed on")

rows = spark.range(0, 10000, 1, 4).repartition(4, "id").mapInArrow(flaky, "id long")
seen = counted(rows, {"rows": F.count(F.lit(1)), "total": F.sum("id")}, lambda df: df.write.parquet(sys.argv[1]))
print("seen", seen["rows"], seen["total"], spark.read.parquet(sys.argv[1]).count())
"""


def test_a_repeated_task_counts_once(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path / "out")], env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=240
    )
    assert "seen 10000 49995000 10000" in done.stdout, done.stderr[-2000:]
    assert done.stderr.count("lost after all its rows") >= 4
