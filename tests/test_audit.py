from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from strata import fixed, schemas
from strata.plans import audit

START = datetime(2001, 1, 1)


def at(n):
    return START + timedelta(minutes=n)


def batches(spark, *events):
    rows = [(n, batch, load, status, at(n), error) for n, (batch, load, status, error) in enumerate(events)]
    return spark.createDataFrame(rows, schemas.AUDIT["batch_events"])


def layers(spark, *events):
    rows = [(n, load, layer, mark, batch, status, at(n)) for n, (load, layer, batch, status, mark) in enumerate(events)]
    return spark.createDataFrame(rows, schemas.AUDIT["layer_events"])


LAYER = {"bronze": fixed.BRONZE, "silver": fixed.SILVER, "gold": fixed.GOLD}

CASES = {
    "succeeded": ("SUCCESS", {"bronze": "SUCCESS", "silver": "SUCCESS", "gold": "SUCCESS"}, (None, "bronze")),
    "killed": ("RUNNING", {"bronze": "SUCCESS"}, (None, "bronze")),
    "failed_at_once": ("FAILED", {}, (7, "bronze")),
    "failed_in_bronze": ("FAILED", {"bronze": "FAILED"}, (7, "bronze")),
    "failed_in_silver": ("FAILED", {"bronze": "SUCCESS", "silver": "FAILED"}, (7, "silver")),
    "interrupted_in_silver": ("FAILED", {"bronze": "SUCCESS", "silver": "RUNNING"}, (7, "silver")),
    "failed_in_gold": ("FAILED", {"bronze": "SUCCESS", "silver": "SUCCESS", "gold": "FAILED"}, (7, "gold")),
    "failed_after_gold": ("FAILED", {"bronze": "SUCCESS", "silver": "SUCCESS", "gold": "SUCCESS"}, (None, "bronze")),
}


def test_resume_point_of_all_loads_at_once(spark):
    history, states = [], []
    for load, (status, done, _) in CASES.items():
        # An older batch that failed, and whose states must not count.
        history += [(3, load, "FAILED", "old"), (7, load, "RUNNING", None), (7, load, status, None)]
        states += [(load, LAYER[n], 3, "SUCCESS", None) for n in LAYER if n not in done]
        states += [(load, LAYER[n], 7, s, None) for n, s in done.items()]
    # One batch number belongs to one load: batches are told apart by load here only to keep the cases side by side.
    rows = {load: batches(spark, *[h for h in history if h[1] == load]) for load in CASES}
    state = audit.layer_state(layers(spark, *states))
    for load, (_, _, expected) in CASES.items():
        point = audit.resume_point(audit.batch_status(rows[load]), state).first()
        assert (point.pipeline_name, point.last_batch_id) == (load, 7)
        assert (point.restart_batch_id, point.resume_from_layer) == expected, load


def test_layer_state_keeps_the_last_watermark_and_seeds_missing_layers(spark):
    events = layers(
        spark,
        ("a", fixed.BRONZE, 1, "RUNNING", at(100)),
        ("a", fixed.BRONZE, 1, "SUCCESS", None),
        ("a", fixed.BRONZE, 2, "RUNNING", None),
        ("b", fixed.GOLD, 5, "FAILED", None),
    )
    got = {(r.pipeline_name, r.layer_name): (r.last_watermark, r.last_batch_id, r.status) for r in audit.layer_state(events).collect()}
    pending = (None, 0, "PENDING")
    assert got == {
        ("a", fixed.BRONZE): (at(100), 2, "RUNNING"),
        ("a", fixed.SILVER): pending,
        ("a", fixed.GOLD): pending,
        ("b", fixed.BRONZE): pending,
        ("b", fixed.SILVER): pending,
        ("b", fixed.GOLD): (None, 5, "FAILED"),
    }


@pytest.mark.parametrize("last, finished, error", [("RUNNING", None, None), ("SUCCESS", 2, None), ("FAILED", 2, "e" * 255)])
def test_batch_status(spark, last, finished, error):
    events = batches(spark, (1, "a", "RUNNING", None), (1, "a", "FAILED", "older"), (1, "a", last, "e" * 300 if last == "FAILED" else None))
    row = audit.batch_status(events).first()
    assert (row.status, row.started_at, row.error_message) == (last, at(0), error)
    assert row.finished_at == (None if finished is None else at(finished))


def test_job_runs(spark):
    rows = [
        (1, 10, 1, "bronze", "RUNNING", at(1), None),
        (2, 10, 1, "bronze", "FAILED", at(2), "boom"),
        (3, 11, 1, "bronze", "RUNNING", at(3), None),
        (4, 12, 1, "silver", "RUNNING", at(4), None),
        (5, 12, 1, "silver", "SUCCESS", at(5), None),
    ]
    runs = audit.job_runs(spark.createDataFrame(rows, schemas.AUDIT["job_events"]))
    assert sorted(tuple(r) for r in runs.collect()) == [
        (10, 1, "bronze", "FAILED", at(1), at(2), "boom"),
        (11, 1, "bronze", "RUNNING", at(3), None, None),
        (12, 1, "silver", "SUCCESS", at(4), at(5), None),
    ]
