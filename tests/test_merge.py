from __future__ import annotations

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators import merge

DDL = "k long, part string, a int, b string"
SETS = [["k"], ["k", "part"]]


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def expected(target, updates, keys, update_cols):
    """Brute force over dictionaries; a NULL in the key conflicts with nothing."""
    names = ["k", "part", "a", "b"]
    at = [names.index(k) for k in keys]
    held = [list(r) for r in target]
    where = {tuple(r[i] for i in at): r for r in held if None not in [r[i] for i in at]}
    for u in updates:
        row = where.get(tuple(u[i] for i in at))
        if row is None:
            held.append(list(u))
        else:
            for c in update_cols:
                row[names.index(c)] = u[names.index(c)]
    return sorted(map(repr, map(tuple, held)))


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.select("k", "part", "a", "b").collect())


def some(seed, count, low, high, null_share=0.1):
    random.seed(seed)
    keys = random.sample(range(low, high), count)
    text = [None, "x", "y"]
    return [
        (None if random.random() < null_share else k, f"p{k % 3}", random.choice([None, 1, 2, 3]), random.choice(text)) for k in keys
    ]


@pytest.mark.parametrize("keys", SETS)
@pytest.mark.parametrize("update_cols", [["a"], ["a", "b"], ["b"], []])
@pytest.mark.parametrize("updates_rows", [None, 300])
def test_upsert_equals_brute_force(spark, keys, update_cols, updates_rows):
    target, updates = some(1, 400, 0, 1000), some(2, 300, 0, 1000)
    result = merge.upsert(frame(spark, target), frame(spark, updates), keys, update_cols, updates_rows=updates_rows)
    assert rows_of(result) == expected(target, updates, keys, update_cols)


@pytest.mark.parametrize("update_cols", [["a", "b"], []])
def test_merging_twice_changes_nothing(spark, update_cols):
    target, updates = some(3, 50, 0, 100, 0), some(4, 60, 0, 100, 0)
    once = merge.upsert(frame(spark, target), frame(spark, updates), ["k"], update_cols)
    assert rows_of(merge.upsert(once, frame(spark, updates), ["k"], update_cols)) == rows_of(once)


def test_new_null_overwrites(spark):
    result = merge.upsert(frame(spark, [(1, "p", 5, "x")]), frame(spark, [(1, "q", None, "y")]), ["k"], ["a"])
    assert result.collect() == [(1, "p", None, "x")]


@pytest.mark.parametrize("update_cols", [["a"], []])
@pytest.mark.parametrize("updates_rows", [None, 2])
def test_repeated_key_fails(spark, update_cols, updates_rows):
    twice = frame(spark, [(1, "p", 1, "x"), (1, "p", 2, "y")])
    with pytest.raises((PySparkException, Py4JJavaError), match="repeated key"):  # the latter where a broadcast fails
        merge.upsert(frame(spark, [(2, "p", 1, "x")]), twice, ["k"], update_cols, updates_rows=updates_rows).collect()


def test_repeated_key_keeps_the_first(spark):
    updates = [(k % 5, "p", k, "x") for k in range(500)] + [(None, "p", 1, "x")] * 3
    result = merge.upsert(frame(spark, []), frame(spark, updates), ["k"], [], on_duplicate="first", first_by=["a"])
    assert sorted(((r.k, r.a) for r in result.collect()), key=repr) == sorted([(k, k) for k in range(5)] + [(None, 1)] * 3, key=repr)


def test_rows_with_null_keys_are_all_kept(spark):
    nothing = [(None, "p", n, "x") for n in range(50)]
    result = merge.upsert(frame(spark, nothing), frame(spark, nothing), ["k"], ["a"])
    assert result.count() == 100


def test_columns_only_the_target_has(spark):
    target = spark.createDataFrame([(1, 10, "x")], "k long, key long, a string")
    updates = spark.createDataFrame([(1, "y"), (2, "z")], "k long, a string")
    assert sorted(merge.upsert(target, updates, ["k"], ["a"]).collect()) == [(1, 10, "y"), (2, None, "z")]


def test_unknown_names_are_refused(spark):
    one = frame(spark, [(1, "p", 1, "x")])
    with pytest.raises(ValueError, match="missing"):
        merge.upsert(one, one, ["k"], ["nope"])
    with pytest.raises(ValueError, match="duplicate"):
        merge.upsert(one, one, ["k"], ["a"], on_duplicate="maybe")


def test_actions_are_counted(spark):
    target, updates = [(1, "p", 1, "x"), (2, "p", 1, "x")], [(2, "p", 2, "x"), (3, "p", 2, "x"), (4, "p", 2, "x")]
    counts = merge.merge_counts(merge.merged(frame(spark, target), frame(spark, updates), ["k"], ["a"]))
    assert {r.action: r.row_count for r in counts.collect()} == {"keep": 1, "update": 1, "insert": 2}


def test_keys_are_stable_dense_and_unique(spark):
    random.seed(8)
    names = [f"n{v}" for v in random.sample(range(10**6), 3000)]
    empty = spark.createDataFrame([], "name string, id long")
    known = {}
    held = empty
    for upto in (1000, 1000, 3000):
        batch = spark.createDataFrame([(n,) for n in names[:upto]], "name string")
        keyed = merge.assign_keys(held, batch, "name", "id")
        held = merge.upsert(held, keyed, ["name"], [])
        got = {r.name: r.id for r in held.collect()}
        assert all(got[n] == i for n, i in known.items())
        assert sorted(got.values()) == list(range(1, upto + 1))
        fresh = sorted(set(got) - set(known))
        assert [got[n] for n in fresh] == sorted(got[n] for n in fresh)
        known = got


def test_hot_null_key_is_spread(spark, conf):
    """A third of both sides without a key: no task of the outer join gets much more than its share."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")

    def side(shift):
        key = F.when(F.col("id") % 3 != 0, F.col("id") + shift)
        return spark.range(30_000).select(key.alias("k"), F.lit("p").alias("part"), F.col("id").cast("int").alias("a"), F.lit("x").alias("b"))

    result = merge.upsert(side(0), side(15_000), ["k"], ["a"])
    sizes = [r["count"] for r in result.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 50_000  # 20,000 without a key, 30,000 different keys
    assert len(sizes) == 8 and max(sizes) < 1.3 * sum(sizes) / 8


def test_keyed_merge_reads_and_shuffles_the_target_once(spark, tmp_path, conf, monkeypatch):
    from strata import session

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.createDataFrame([(10, "a", 1), (11, "b", 2), (15, "c", None)], "id long, name string, v int").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    updates = spark.createDataFrame([("c", None), ("b", 7), ("z", 1), ("d", 2)], "name string, v int")
    written = []
    real = session.materialize_counted
    monkeypatch.setattr(session, "materialize_counted", lambda df, *rest: written.append(df) or real(df, *rest))
    got = merge.keyed_merge(target, updates, "name", "id", ["v"])
    assert sorted(tuple(r) for r in got.rows.select("id", "name", "v", "_action").collect()) == [
        (10, "a", 1, "keep"), (11, "b", 7, "update"), (15, "c", None, "update"), (16, "d", 2, "insert"), (17, "z", 1, "insert"),
    ]
    assert got.counts == {"insert": 2, "update": 2, "keep": 1} and got.changed == 1  # NULL for NULL changes nothing
    [joined] = written
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 2
    # what remains to be done reads the written join, not the target
    assert str(tmp_path) not in got.rows._jdf.queryExecution().toString()
    # the same rows by the general operators
    keyed = merge.assign_keys(target, updates, "name", "id")
    other = merge.upsert(target, keyed, ["name"], ["v"])
    assert sorted(map(repr, other.collect())) == sorted(map(repr, got.rows.drop("_action").select(*other.columns).collect()))
