"""Lookups of a batch's keys in a large table: what the scan leaves out, and that nothing is lost by it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import merge, spans
from strata.plans import fixtures, load
from strata.plans.inputs import inputs
from strata.sources import files, tables
from strata.streaming import weblogs

SF_DIR = "/root/testdata/sf0.001"
MONTHS, EACH = 80, 500


def frame(spark, keys, kind="long"):
    return spark.createDataFrame([(k,) for k in keys], f"id {kind}")


@pytest.mark.parametrize("seed", range(3))
def test_spans_hold_all_keys_and_leave_the_widest_gaps(spark, seed):
    draw = random.Random(seed)
    starts = [draw.randrange(-(10**9), 10**9) for _ in range(6)]
    keys = {s + draw.randrange(1000) for s in starts for _ in range(200)}
    got = spans.key_spans(frame(spark, [*keys, None, *keys]), "id", spans=6, steps=10**6)
    assert len(got) == 6 and all(a <= b for a, b in got) and all(b < c for (_, b), (c, _) in zip(got, got[1:]))
    assert all(any(a <= k <= b for a, b in got) for k in keys)
    assert {x for ends in got for x in ends} <= keys and sum(b - a for a, b in got) <= 6 * 1000


def test_spans_at_the_ends_of_a_long(spark):
    keys = [-(1 << 63), -(1 << 63) + 1, 0, (1 << 63) - 1]
    assert spans.key_spans(frame(spark, keys), "id", spans=3) == [(-(1 << 63), -(1 << 63) + 1), (0, 0), ((1 << 63) - 1, (1 << 63) - 1)]
    assert spans.key_spans(frame(spark, []), "id") == spans.key_spans(frame(spark, [None]), "id") == []


@pytest.mark.parametrize("kind", ["long", "int", "string", "double"])
@pytest.mark.parametrize("n", [0, 1, 20, 200])
def test_what_can_match_stays(spark, kind, n):
    draw = random.Random(n)
    keys = [draw.randrange(100_000) for _ in range(n)] + [None]
    table, updates = (frame(spark, x).select(F.col("id").cast(kind).alias("id")) for x in (list(range(0, 100_000, 7)) + keys, keys))
    near = spans.narrowed(table, updates, "id")
    matched = lambda t: sorted(r.id for r in t.join(updates, "id", "left_semi").collect())
    assert matched(near) == matched(table)
    if n <= spans.FEW and kind != "double":
        assert {r.id for r in near.collect()} == {r.id for r in updates.dropna().collect()}
    left = lambda t: sorted(map(repr, merge.not_yet_present(updates, t, ["id"]).collect()))
    assert left(near) == left(table)


def scanned(df):
    """Rows that the file scans of a plan gave when it ran."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], {}
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            rows[node.id()] = (node.toString(), node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return [n for text, n in rows.values() if "data_version" in text]


def month_table(spark, path, ids):
    """A fact of eighty months."""
    rows = spark.createDataFrame(ids, "place long, id long").select("id", F.expr("200001 + 100 * (place div 6000) + (place div 500) % 12").alias("month"))
    rows = rows.select("id", (F.col("month") * 100 + 1).cast("int").alias("date_key"))
    tables.publish(spark, path, rows, fixtures.NOW, tables.month_part(), key=["id"])
    return tables.read_table(spark, path, rows.schema)


@pytest.mark.parametrize("order", ["in order of time", "shuffled"])
def test_a_batch_of_two_months_reads_few_row_groups(spark, tmp_path, order):
    n = MONTHS * EACH
    ids = list(range(n))
    if order == "shuffled":
        random.Random(1).shuffle(ids)
    table = month_table(spark, str(tmp_path / "t"), list(enumerate(ids)))
    assert len(tables._current(spark, str(tmp_path / "t"))[1]) == MONTHS
    # all keys of two months that lie far apart; where keys have no order only a handful can be told apart
    places = [p for m in (3, 70) for p in range(m * EACH, (m + 1) * EACH)]
    if order == "shuffled":
        places = places[::50]
    updates = spark.createDataFrame([(ids[p], 20000101) for p in places], "id long, date_key int")
    held = tables.held_parts(table, updates, ["id"], tables.month_part(), len(places))
    assert {r[0] for r in held.collect()} == {200004, 200511}
    read = scanned(held)
    assert len(read) == 1 and 0 < read[0] < n / 10, read
    whole = table.join(F.broadcast(updates.select("id")), "id", "left_semi").select(tables.month_part().alias("p"))
    assert sorted(r[0] for r in held.collect()) == sorted(r[0] for r in whole.collect())
    assert sorted(tables.touched_parts(table, updates, ["id"], tables.month_part())) == [200001, 200004, 200511]


def test_files_lie_in_order_of_the_key(spark, tmp_path):
    ids = list(range(2000))
    random.Random(2).shuffle(ids)
    table = month_table(spark, str(tmp_path / "t"), list(enumerate(ids)))
    name, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    read = spark.read.schema("id long, date_key int").parquet(str(tmp_path / "t" / "data_version=1"))
    by_file = {}
    for r in read.select(name.alias("f"), at.alias("i"), "id").collect():
        by_file.setdefault(r.f, []).append((r.i, r.id))
    assert table.count() == 2000
    for rows in by_file.values():
        assert [x for _, x in sorted(rows)] == sorted(x for _, x in rows)


def test_new_log_rows_are_told_by_few_old_ones(spark, tmp_path):
    """The load's own merge of the web fact: ids of a batch against a fact with earlier ones."""
    i, w = inputs(spark, SF_DIR), load.Warehouse(spark, str(tmp_path / "w"))
    web = i.gold("fact_web_activity").select(*schemas.GOLD["fact_web_activity"].names)
    tables.publish(spark, w.path("gold", "fact_web_activity"), web, fixtures.NOW, tables.month_part(), key=["source_log_id"])
    last = web.agg(F.max("source_log_id")).first()[0]
    rows = web.filter(F.col("source_log_id") > last - 10).unionByName(web.limit(5).withColumn("source_log_id", F.col("source_log_id") + last))
    held = spans.narrowed(w.gold("fact_web_activity"), rows, "source_log_id", rows.count())
    actions = merge.merged(held, rows, ["source_log_id"], [], on_duplicate="first", first_by=["request_time"])
    added = actions.filter(F.col("_action") == merge.INSERT)
    expected = merge.not_yet_present(rows, web, ["source_log_id"])
    assert sorted(r.source_log_id for r in added.collect()) == sorted(r.source_log_id for r in expected.collect()) != []
    assert "KEEP" not in added._jdf.queryExecution().optimizedPlan().toString()


def test_a_log_reads_its_own_history_only(spark, tmp_path, monkeypatch):
    """Files of earlier batches are left out by the scan; ids go on from the last batch."""
    target, seen = str(tmp_path / "out"), []
    real = weblogs.insert_absent_actions
    monkeypatch.setattr(weblogs, "insert_absent_actions", lambda held, rows: seen.append(scanned(held)) or real(held, rows))
    for n in range(4):
        (tmp_path / f"{n}.log").write_text("".join(f"line {n} {k}\n" for k in range(50)))
        lines = files.read_lines(spark, str(tmp_path / f"{n}.log"))
        assert weblogs.load_lines(spark, lines, target, fixtures.NOW) == {"inserted": 50, "skipped": 0}
    (tmp_path / "1.log").write_text("".join(f"line 1 {k}\n" for k in range(55)))
    assert weblogs.load_lines(spark, files.read_lines(spark, str(tmp_path / "1.log")), target, fixtures.NOW) == {"inserted": 5, "skipped": 50}
    assert [sum(x) for x in seen] == [0, 0, 0, 0, 50]
    rows = tables.read_table(spark, target, schemas.WEBLOG_ROWS).collect()
    assert sorted(r.log_id for r in rows) == list(range(1, 206))
    by_id = [(r.source_file, r.source_line_number) for r in sorted(rows, key=lambda r: r.log_id)]
    assert by_id[:50] == sorted(by_id[:50]) and [n for _, n in by_id[-5:]] == [51, 52, 53, 54, 55]
