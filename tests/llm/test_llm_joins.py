"""How tables that grow with the documents are joined, whatever Spark takes their sizes for."""

from __future__ import annotations

import pytest

from strata.llm import labelled, simhash

TEXTS = [f"{' '.join(f'word{k}' for k in range(40))} {tail}" for tail in ("one", "two", "two", "three")] + ["", "quite another text of a few words", None]


@pytest.mark.parametrize("made", [simhash.simhash_groups, simhash.one_of_each_group])
def test_near_copies_broadcast_nothing_that_grows_with_the_documents(spark, conf, monkeypatch, made):
    conf("spark.sql.autoBroadcastJoinThreshold", "1g")  # all of it is small enough by Spark's reckoning
    plans, keep = [], simhash.keep

    def kept(df, label):
        plans.append((label, df._jdf.queryExecution().sparkPlan().toString()))
        return keep(df, label)

    monkeypatch.setattr(simhash, "keep", kept)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    out = made(docs)
    plans.append(("result", out._jdf.queryExecution().sparkPlan().toString()))
    assert {"signatures", "rooted"} <= {label for label, _ in plans}
    assert [label for label, plan in plans if "Broadcast" in plan] == []
    groups = simhash.simhash_groups(docs).select("component_id").distinct().count()
    assert out.count() == (len(TEXTS) if made is simhash.simhash_groups else groups)


def test_only_the_chosen_ids_are_broadcast_to_the_texts(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "1g")
    docs = spark.createDataFrame([(n, f"text {n}") for n in [*range(40), 3, 4]] + [(None, "no id"), (41, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(50)] + [(3, 1), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    sample = labelled.training_sample(docs, labels, "quality", per_class=6)
    plan = sample._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 2  # chosen with labels and ids, once for each class
    held = {r.id for r in labels.select(labelled.held_out(labels.doc_id).alias("out"), labels.doc_id.alias("id")).filter("out").collect()}
    got = sorted((r.y, r.id, bytes(r.text).decode()) for r in sample.collect())
    assert len(got) == 12 and sum(y for y, _, _ in got) == 6
    assert all(text == f"text {id_}" and id_ < 40 and id_ not in held and (y == id_ % 2 or (id_, y) == (5, 0)) for y, id_, text in got)
