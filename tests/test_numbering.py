from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.numbering import number_rows, with_line_numbers
from strata.plans import reports
from strata.sources import files


def test_numbers_are_dense_and_in_order(spark):
    random.seed(3)
    values = random.sample(range(10**9), 20_000)
    df = spark.createDataFrame([(v, f"r{v}") for v in values], "v long, t string").repartition(13)
    numbered = number_rows(df, [F.col("v")], "n", after=100)
    got = {r.v: r.n for r in numbered.collect()}
    assert got == {v: 101 + k for k, v in enumerate(sorted(values))}


def test_numbers_with_mixed_directions_and_nulls(spark):
    rows = [(a, b) for a in (None, 1, 2, 3) for b in ("x", "y", None)]
    df = spark.createDataFrame(rows, "a int, b string")
    numbered = number_rows(df, [F.desc_nulls_first("a"), F.asc_nulls_last("b")], "n")
    order = sorted(rows, key=lambda r: (0 if r[0] is None else 1, -(r[0] or 0), 1 if r[1] is None else 0, r[1] or ""))
    assert [(r.a, r.b) for r in numbered.orderBy("n").collect()] == order
    assert [r.n for r in numbered.orderBy("n").collect()] == list(range(1, 13))


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0), [F.col("id")], "n").collect() == []


@pytest.mark.parametrize("split_bytes", [64, 1000, 10**9])
def test_line_numbers_over_many_splits(spark, conf, tmp_path, split_bytes):
    """A small split size cuts each file into many tasks, as big files are."""
    conf("spark.sql.files.maxPartitionBytes", str(split_bytes))
    conf("spark.sql.files.openCostInBytes", "0")
    expected = {}
    for name, lines in [("a.log", 400), ("b.log", 1), ("c.log", 57)]:
        texts = [f"{name} line {k} " + "x" * (k % 31) for k in range(1, lines + 1)]
        (tmp_path / name).write_text("\n".join(texts) + "\n")
        expected.update({t: (name, k) for k, t in enumerate(texts, 1)})
    numbered = with_line_numbers(files.read_lines(spark, str(tmp_path)))
    got = {r.raw_line: (r.source_file.rsplit("/", 1)[1], r.source_line_number) for r in numbered.collect()}
    assert got == expected


def test_line_numbers_without_broadcast(spark, conf, tmp_path, monkeypatch):
    """Beyond the checked size the starts of the splits are joined by shuffle; the numbers stay the same."""
    conf("spark.sql.files.maxPartitionBytes", "200")
    conf("spark.sql.files.openCostInBytes", "0")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr("strata.operators.numbering.broadcast_if_small", lambda df: df)
    (tmp_path / "a.log").write_text("".join(f"{k}\n" for k in range(1, 501)))
    rows = with_line_numbers(files.read_lines(spark, str(tmp_path))).collect()
    assert all(int(r.raw_line) == r.source_line_number for r in rows) and len(rows) == 500


def test_rank_all_equals_a_plain_window(spark):
    random.seed(5)
    rows = [(f"p{k}", random.randrange(50)) for k in range(3000)]
    ranked = reports.rank_all(spark.createDataFrame(rows, "name string, units long"), "units", "name")
    order = sorted(sorted(rows, key=lambda r: r[0], reverse=True), key=lambda r: r[1], reverse=True)
    assert [(r.name, r.units) for r in ranked.orderBy("rank_no").collect()] == order
