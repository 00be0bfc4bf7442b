"""Text classifier of the kind naive Bayes support vectors: n-gram indicators times class log-count ratios, hinge loss, dual coordinate descent."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_ids_and_text, map_arrow, prepare, utf8
from strata.llm.labelled import LONGEST, PER_CLASS, calibrate, fit_in_task, held_out, sigmoid, training_sample

#: Indicators are hashed into 2**BITS places. Character n-grams run over bytes within and across words, up to this order.
BITS, ORDER = 18, 4
#: Bytes whose n-grams are taken at once.
STRETCH = 1 << 20
#: Smoothing of counts, cost of a margin error, passes over the sample, share of the fitted weights against their mean size.
ALPHA, COST, PASSES, SHARE = 1.0, 1.0, 20, 0.9
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _place(codes: np.ndarray, kind: int) -> np.ndarray:
    """Places of n-gram codes of one kind: multiplicative hashing."""
    mixed = (codes.astype(np.uint64) + np.uint64((kind + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def _mark(data: np.ndarray, seen: np.ndarray) -> None:
    """Set the places of all n-grams of some bytes: characters (1 to ORDER), words, pairs of words, and runs of one word."""
    codes = data.astype(np.uint64)
    for n in range(1, ORDER + 1):
        if n > 1:
            if len(data) < n:
                break
            codes = codes[:-1] << np.uint64(8) | data[n - 1 :]
        seen[_place(codes, n)] = True
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.flatnonzero(~space)
    if not len(inside):
        return
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    place = inside - np.repeat(starts, np.add.reduceat((~space).astype(np.int64), starts))
    with np.errstate(over="ignore"):
        powers = _MIX ** (np.arange(int(place.max()) + 1, dtype=np.uint64) % np.uint64(4096))
        hashed = np.where(space, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)))
        hashed[inside] *= powers[place]
        words = np.add.reduceat(hashed, starts)
        seen[_place(words, 10)] = True
        if len(words) > 1:
            seen[_place(words[:-1] * np.uint64(31) + words[1:], 11)] = True
            again = (words[1:] == words[:-1]).astype(np.uint64)
            for n in range(1, 4):  # "same as before" as a word of its own: runs of it
                runs = again[: len(again) - n + 1].copy()
                for k in range(1, n):
                    runs = runs * np.uint64(2) + again[k : len(again) - n + 1 + k]
                if len(runs):
                    seen[_place(runs, 11 + n)] = True


def indicators(text: bytes) -> np.ndarray:
    """The places of all n-grams that a text holds, in order; long texts are read in stretches that overlap by a word."""
    seen = np.zeros(1 << BITS, bool)
    at = 0
    while at < len(text) or at == 0:
        end = at + STRETCH
        _mark(np.frombuffer(text[at:end], np.uint8), seen)
        if end >= len(text):
            break
        cut = max(text.rfind(b" ", at + STRETCH // 2, end), text.rfind(b"\n", at + STRETCH // 2, end))
        at = cut if cut > 0 else end - ORDER
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # of each place; what an indicator adds to the margin before the length is divided out
    ratios: np.ndarray  # squared log-count ratios: their sum over a text's indicators is its squared length
    bias: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        return float(self.weights[places].sum() / np.sqrt(self.ratios[places].sum() + 1e-9)) + self.bias

    def score(self, text: bytes) -> float:
        return float(sigmoid(np.array(self.slope * self.margin(indicators(text)) + self.offset)))


class Weighted(Sequence):
    """Sparse rows of a text each: its places, and their ratios at length 1, worked out when they are asked for. Only places are held (four
    bytes each, the last one that of the bias, whose value is 1), so a text of the sample costs a fifth of what its values would."""

    def __init__(self, places: list[np.ndarray], ratio: np.ndarray):
        self.places, self.ratio = places, np.append(ratio, 0.0)
        self.lengths = [np.sqrt((ratio[p[:-1]] ** 2).sum() + 1e-9) for p in places]

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        values = self.ratio[self.places[i]] / self.lengths[i]
        values[-1] = 1.0
        return self.places[i], values


def dual_descent(rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, size: int, passes: int = PASSES, seed: int = 0) -> np.ndarray:
    """Weights of a linear hinge-loss model without bias: sparse rows (places, values), y of -1 and 1, upper bounds of the dual variables."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    square = np.array([v @ v for _, v in rows]) + 1e-12
    draw = np.random.default_rng(seed)
    for _ in range(passes):
        most = 0.0
        for i in draw.permutation(len(rows)):
            places, values = rows[i]
            slope = y[i] * (w[places] @ values) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w[places] += (new - alpha[i]) * y[i] * values
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-4:
            break
    return w


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """Fitted on four fifths of the sample; the scores' slope and offset on the rest. Without both classes scores are their share."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(np.zeros(size, np.float32), np.ones(size, np.float32), 0.0, 1e-3, float(np.log(share / (1 - share))))
    # one more place stands for the bias
    marked = [np.append(indicators(t), np.int32(size)) for t in texts]
    found = [m[:-1] for m in marked]
    other = np.arange(len(texts)) % 5 == 4
    if len(set(labels[other].tolist())) < 2 or len(set(labels[~other].tolist())) < 2:
        other[:] = False
    counts = [np.full(size, ALPHA), np.full(size, ALPHA)]
    for places, label in zip((found[i] for i in np.flatnonzero(~other)), labels[~other]):
        counts[label][places] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    rows = Weighted([marked[i] for i in np.flatnonzero(~other)], ratio)
    y = np.where(labels[~other] == 1, 1, -1)
    share = np.array([np.mean(y == -1), np.mean(y == 1)])
    w = dual_descent(rows, y, COST * 0.5 / share[(y + 1) // 2], size + 1)
    mean = np.abs(w[:-1]).mean()
    weights = ((1 - SHARE) * mean + SHARE * w[:-1]) * ratio
    model = Model(weights.astype(np.float32), (ratio**2).astype(np.float32), float(w[-1]), 1.0, 0.0)
    rest = np.flatnonzero(other) if other.any() else np.arange(len(texts))
    margins = np.array([model.margin(found[i]) for i in rest])
    model.slope, model.offset = calibrate(margins, labels[rest], np.ones(len(rest)))
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row of `docs`, null and empty texts and repeated rows included."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in utf8(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return map_arrow(doc_ids_and_text(docs, id_col, text_col), work, "doc_id long, score double")


def score_column(model: Model, text_col: str = "text") -> Column:
    """The score as a column beside all others of a row."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score((t or "").encode()) for t in texts])

    return score(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def good_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7, per_class: int = PER_CLASS, longest: int = LONGEST) -> DataFrame:
    """The rows of `docs`, all columns kept, that quality_scores predicts to be of label 1.

    Without labelled texts of both classes nothing is known that could tell rows apart, so all of them stay.
    """
    model = fit_in_task(training_sample(docs, labels, label, per_class, longest), fit)
    if not model.weights.any():
        return docs
    prepare(docs.sparkSession)
    return docs.filter(score_column(model) >= threshold)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7, per_class: int = PER_CLASS, longest: int = LONGEST) -> DataFrame:
    """doc_id, held_out, score and predicted (1 where score >= threshold) of every row of `docs`.

    The model is fitted in one task, on a bounded sample of labelled rows that are not held out (per_class, longest: see
    training_sample); every row's whole text is scored. Only the text enters a score. A null text is empty; null ids and repeated
    rows stay. With labels of one class only, or none, all scores are about the share of label 1 (a half without any).
    """
    model = fit_in_task(training_sample(docs, labels, label, per_class, longest), fit)
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
