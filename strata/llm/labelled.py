"""Labelled training texts: a bounded sample of rows that are not held out."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import crc_bucket

#: One of so many rows is held out: those whose crc32 of the id leaves this remainder.
FOLDS, HELD_OUT = 4, 2
#: Rows of each class that a model is fitted on at most, and the longest text among them, in characters.
PER_CLASS, LONGEST = 2500, 20_000


def held_out(id_col: Column) -> Column:
    """Whether a row's label may not be learnt; a null id counts as the empty text and is not held out."""
    return crc_bucket(id_col, FOLDS) == HELD_OUT


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, y (0 or 1) and text (UTF-8) of at most `per_class` rows of each class, none of them held out.

    Only fitting uses the sample; statistics of a model that are said to be of the corpus do not. Ids are chosen among those with
    a text in `docs` of at most `longest` characters, in order of a hash of the id, so reruns take the same ones; they are
    broadcast (2 * per_class numbers), the ids of all documents never. A repeated id counts once, with the first of its texts by code point; of several labels of
    one id each counts. Rows without id, label or text are left out.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    usable = marked.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.length("text") <= longest)
    at_hand = usable.join(texts.filter(~held_out(F.col("id"))).select("id").distinct().hint("merge"), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [at_hand.filter(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    found = texts.join(F.broadcast(chosen[0].union(chosen[1])), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    return found.select("id", "y", F.col("text").cast("binary").alias("text"))


def fit_in_task(sample: DataFrame, fit: Callable[[list[bytes], np.ndarray], Any]) -> Any:
    """What `fit` makes of a bounded sample's texts and labels, in one task, so that neither texts nor training weigh on the driver.

    Rows are put in a fixed order first, so reruns fit the same model. An empty sample is fitted as well: to nothing.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["id"], r["y"], r["text"]) for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r[0] * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, r))
        model = fit([r[2] for r in rows], np.array([r[1] for r in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = sample.repartition(1).mapInArrow(work, "model binary").first()
    return pickle.loads(made[0]) if made else fit([], np.zeros(0, np.int64))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def calibrate(margins: np.ndarray, y: np.ndarray, weights: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """a > 0 and b, so that sigmoid(a * margin + b) is the probability of label 1: logistic regression on one number, a little damped."""
    scale = float(np.abs(margins).max()) or 1.0
    x = np.stack([margins / scale, np.ones_like(margins)], axis=1)
    weights = weights / weights.sum()

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((weights * (np.logaddexp(0, z) - y * z)).sum() + 5e-4 * theta @ theta)

    theta = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ theta)
        slope = x.T @ (weights * (p - y)) + 1e-3 * theta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(step).max() < 1e-9 or size <= 1e-6:
            break
    return max(float(theta[0]), 1e-3) / scale, float(theta[1])
