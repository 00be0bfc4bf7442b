"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_ids_and_text, map_arrow, prepare, utf8
from strata.llm.labelled import LONGEST, calibrate, fit_in_task, held_out, sigmoid, training_sample

#: Words of a window, and from one window's start to the next one's: windows overlap by their difference.
WINDOW, STRIDE = 48, 32
#: Hidden units of each direction, units of the attention, and the width of the word's and of the characters' input.
HIDDEN, ATTENTION, WORD_IN, CHAR_IN = 8, 8, 6, 6
#: Words and character n-grams are hashed into 2**BITS vectors. Longer words are read as several pieces of PIECE bytes.
BITS, PIECE = 16, 24
#: Words whose inputs a Python worker remembers, words and windows scored at once.
MEMORY, WORDS, WINDOWS = 200_000, 200_000, 4096
#: Rows of each class that the network is trained on at most.
PER_CLASS = 1500
#: Training steps (in whole passes over the windows), windows of a step, step size, and the seed of the starting values.
STEPS, BATCH, RATE, SEED = 360, 128, 0.01, 7
#: Slope of the scores of a network that has seen one class only.
BLIND = 1e-6
#: A word or n-gram that so many texts hold has half of its log ratio as starting value.
FEW = 5
_APART = bytes(b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else 0x20 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words of a text: runs of digits, letters and non-ASCII bytes; long ones in pieces."""
    words = text.lower().translate(_APART).split()
    if max(map(len, words), default=0) > PIECE:
        return [w[k : k + PIECE] for w in words for k in range(0, len(w), PIECE)]
    return words


def _place(codes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (codes + np.uint64(kind * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) * _MIX
    return ((mixed ^ (mixed >> np.uint64(31))) * _MIX >> np.uint64(64 - BITS)).astype(np.int32)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its own place, then the places of its n-grams of 3 and 4 characters, borders included, one after the other, and where each word's begin."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    wide = PIECE + 2
    flat = np.frombuffer(b"".join(b"\x02" + w + b"\x03" + bytes(PIECE - len(w)) for w in words), np.uint8).reshape(-1, wide).astype(np.uint64)
    with np.errstate(over="ignore"):
        three = flat[:, :-2] << np.uint64(16) | flat[:, 1:-1] << np.uint64(8) | flat[:, 2:]
        four = three[:, :-1] << np.uint64(8) | flat[:, 3:]
        whole = np.zeros(len(words), np.uint64)
        for k in range(wide):
            whole = (whole ^ flat[:, k]) * np.uint64(0x100000001B3)
        own = _place(whole, 1)
        at = np.arange(wide)
        has3, has4 = (at[: wide - n + 1] <= lengths[:, None] + 2 - n for n in (3, 4))
        grams = np.concatenate([_place(three, 2), _place(four, 3)], axis=1)
    has = np.concatenate([has3, has4], axis=1)
    begins = np.concatenate([[0], np.cumsum(has.sum(axis=1))])
    return own, grams[has], begins


def _gru(inputs: np.ndarray, recurrent: np.ndarray, mask: np.ndarray | None, keep: bool = False):
    """Hidden states (batch, time, HIDDEN) of one direction; inputs are already projected to the gates. keep: also what the way back needs."""
    batch, time, _ = inputs.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    states = np.empty((batch, time, HIDDEN), np.float32)
    kept = []
    for t in range(time):
        g, a = inputs[:, t], h @ recurrent
        gates = 0.5 * np.tanh(0.5 * (g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])) + 0.5
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(g[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[:, t, None], new, h)
        if keep:
            kept.append((h, r, z, n, a[:, 2 * HIDDEN :]))
        h = states[:, t] = new
    return (states, kept) if keep else states


def _gru_back(slopes: np.ndarray, kept: list, recurrent: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the inputs and of the recurrent weights from those of the hidden states."""
    batch, time, _ = slopes.shape
    to_inputs, to_recurrent = np.zeros((batch, time, 3 * HIDDEN), np.float32), np.zeros_like(recurrent)
    dh = np.zeros((batch, HIDDEN), np.float32)
    for t in range(time - 1, -1, -1):
        h, r, z, n, a = kept[t]
        dh = dh + slopes[:, t]
        m = mask[:, t, None]
        here = dh * m
        dn = here * (1 - z) * (1 - n * n)
        dr, dz = dn * a * r * (1 - r), here * (h - n) * z * (1 - z)
        to_inputs[:, t] = np.concatenate([dr, dz, dn], axis=1)
        da = np.concatenate([dr, dz, dn * r], axis=1)
        to_recurrent += h.T @ da
        dh = dh * (1 - m) + here * z + da @ recurrent.T
    return to_inputs, to_recurrent


@dataclass
class Network:
    """Parameters by name, and the slope and offset that turn the highest logit of a text's windows into a probability."""

    p: dict[str, np.ndarray]
    slope: float = 1.0
    offset: float = 0.0
    known: dict[bytes, int] = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"p": self.p, "slope": self.slope, "offset": self.offset, "known": {}, "table": None}

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """The vector of each word: its own, the mean of its characters' n-grams, and how telling the most telling of these is."""
        own, grams, begins = word_features(words)
        chars = np.add.reduceat(self.p["chars"][grams], begins[:-1], axis=0) / np.diff(begins)[:, None]
        telling = np.maximum.reduceat(self.p["telling"][grams], begins[:-1])
        return np.concatenate([self.p["words"][own], chars, telling[:, None]], axis=1).astype(np.float32)

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Rows of `table` (a word's inputs to all gates) for the words of each text; row 0 is no word."""
        seen = set().union(*texts)
        if self.table is None or len(self.known) + len(seen) > MEMORY:
            self.known, self.table = {}, np.zeros((1, 6 * HIDDEN), np.float32)
        new = list(seen.difference(self.known))
        if new:
            rows = [self.inputs(new[k : k + 4096]) @ self.p["in"] + self.p["in_bias"] for k in range(0, len(new), 4096)]
            self.known.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, *rows])
        return [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in texts]

    def pool(self, forward: np.ndarray, backward: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        states = np.concatenate([forward, backward], axis=2)
        weights = np.tanh(states @ self.p["look"] + self.p["look_bias"]) @ self.p["see"]
        if mask is not None:
            weights = np.where(mask, weights, -1e9)
        weights = np.exp(weights - weights.max(axis=1, keepdims=True))
        if mask is not None:
            weights = weights * mask
        weights = weights / np.maximum(weights.sum(axis=1, keepdims=True), 1e-9)
        return (np.matmul(weights[:, None, :], states)[:, 0] @ self.p["out"] + self.p["out_bias"])[:, 0]

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """One logit a window; rows: numbers of its words, 0 where it has none."""
        out = np.empty(len(rows), np.float32)
        half = 3 * HIDDEN
        full = rows.min(axis=1, initial=1) > 0
        for whole in (True, False):
            some = np.flatnonzero(full == whole)
            for k in range(0, len(some), WINDOWS):
                part = some[k : k + WINDOWS]
                ids = rows[part]
                mask = None if whole else ids > 0
                gates = self.table[ids]
                forward = _gru(gates[:, :, :half], self.p["forward"], mask)
                back = _gru(gates[:, ::-1, half:], self.p["backward"], None if whole else mask[:, ::-1])[:, ::-1]
                out[part] = self.pool(forward, back, mask)
        return out

    def best(self, texts: list[bytes]) -> np.ndarray:
        """The highest logit of each whole text's windows. A text without words is one empty window."""
        out = np.full(len(texts), -np.inf, np.float32)
        group, size = [], 0
        for k, text in enumerate(texts):
            words = words_of(text)
            for at in range(0, max(1, len(words)), WORDS - WINDOW):  # very long texts in stretches that overlap by a window
                stretch = words[at : at + WORDS]
                if size + len(stretch) > WORDS:
                    self._group(group, out)
                    group, size = [], 0
                group.append((k, stretch))
                size += len(stretch)
        self._group(group, out)
        return out

    def _group(self, group: list[tuple[int, list[bytes]]], out: np.ndarray) -> None:
        if group:
            cut = [windows(x) for x in self.numbers([words for _, words in group])]
            owner = np.repeat([k for k, _ in group], list(map(len, cut)))
            np.maximum.at(out, owner, self.logits(np.concatenate(cut)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * self.best(texts).astype(np.float64) + self.offset)


def windows(numbers: np.ndarray) -> np.ndarray:
    """All windows of a text's words: a row each, the last ones filled up with 0."""
    count = 1 + max(0, -(-(len(numbers) - WINDOW) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.int64)
    padded[: len(numbers)] = numbers
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE].copy()


class Trainer:
    """Steps of Adam on the mean logistic loss of labelled windows."""

    def __init__(self, words: list[bytes], prior: tuple[np.ndarray, np.ndarray]):
        """words: what the windows' numbers stand for, from 1 on. prior: starting values of one coordinate of words and n-grams."""
        draw = np.random.default_rng(SEED)
        width, both = WORD_IN + CHAR_IN + 1, 2 * HIDDEN
        some = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "words": 0.1 * draw.standard_normal((1 << BITS, WORD_IN)).astype(np.float32),
            "chars": 0.1 * draw.standard_normal((1 << BITS, CHAR_IN)).astype(np.float32),
            "in": some(width, 6 * HIDDEN), "in_bias": np.zeros(6 * HIDDEN, np.float32),
            "forward": some(HIDDEN, 3 * HIDDEN), "backward": some(HIDDEN, 3 * HIDDEN),
            "look": some(both, ATTENTION), "look_bias": np.zeros(ATTENTION, np.float32), "see": some(ATTENTION),
            "out": some(both, 1), "out_bias": np.zeros(1, np.float32),
        }
        self.p["words"][:, 0], self.p["chars"][:, 0] = prior
        self.p["telling"] = np.zeros(1 << BITS, np.float32) + prior[1]  # stays as it is
        self.own, self.grams, self.begins = word_features(words)
        self.first = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.steps = 0

    def step(self, rows: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
        p, half = self.p, 3 * HIDDEN
        mask = rows > 0
        used, inverse = np.unique(rows, return_inverse=True)
        inverse = inverse.reshape(rows.shape)
        real = np.maximum(used - 1, 0)
        counts = self.begins[real + 1] - self.begins[real]
        grams = np.concatenate([self.grams[self.begins[r] : self.begins[r + 1]] for r in real])
        begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
        chars = np.add.reduceat(p["chars"][grams], begins, axis=0) / counts[:, None]
        telling = np.maximum.reduceat(p["telling"][grams], begins)
        vectors = np.concatenate([p["words"][self.own[real]], chars, telling[:, None]], axis=1).astype(np.float32)
        gates = (vectors @ p["in"] + p["in_bias"])[inverse]
        forward, kept_f = _gru(gates[:, :, :half], p["forward"], mask, True)
        backward, kept_b = _gru(gates[:, ::-1, half:], p["backward"], mask[:, ::-1], True)
        states = np.concatenate([forward, backward[:, ::-1]], axis=2)
        looks = np.tanh(states @ p["look"] + p["look_bias"])
        focus = np.where(mask, looks @ p["see"], -1e9)
        focus = np.exp(focus - focus.max(axis=1, keepdims=True)) * mask
        focus /= np.maximum(focus.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", focus, states)
        logit = (pooled @ p["out"] + p["out_bias"])[:, 0]
        chance = sigmoid(logit)
        loss = float(-(weights * np.log(np.where(y == 1, chance, 1 - chance) + 1e-9)).mean())

        g = {}
        d_logit = (weights * (chance - y) / len(y)).astype(np.float32)
        g["out"], g["out_bias"] = pooled.T @ d_logit[:, None], d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"][:, 0]
        d_states = focus[:, :, None] * d_pooled[:, None, :]
        d_focus = np.einsum("bh,bth->bt", d_pooled, states)
        d_focus = focus * (d_focus - (focus * d_focus).sum(axis=1, keepdims=True))
        g["see"] = np.einsum("bt,bta->a", d_focus, looks)
        d_looks = d_focus[:, :, None] * p["see"] * (1 - looks * looks)
        g["look"], g["look_bias"] = np.einsum("bth,bta->ha", states, d_looks), d_looks.sum(axis=(0, 1))
        d_states += d_looks @ p["look"].T
        to_f, g["forward"] = _gru_back(d_states[:, :, :HIDDEN], kept_f, p["forward"], mask)
        to_b, g["backward"] = _gru_back(d_states[:, ::-1, HIDDEN:], kept_b, p["backward"], mask[:, ::-1])
        d_gates = np.zeros((len(used), 6 * HIDDEN), np.float32)
        np.add.at(d_gates, inverse.ravel(), np.concatenate([to_f, to_b[:, ::-1]], axis=2).reshape(-1, 6 * HIDDEN))
        g["in"], g["in_bias"] = vectors.T @ d_gates, d_gates.sum(axis=0)
        d_vectors = d_gates @ p["in"].T
        g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
        np.add.at(g["words"], self.own[real], d_vectors[:, :WORD_IN])
        np.add.at(g["chars"], grams, np.repeat(d_vectors[:, WORD_IN:-1] / counts[:, None], counts, axis=0).astype(np.float32))
        self.steps += 1
        size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for k, v in g.items():
            v = v * min(1.0, 5.0 / (size + 1e-9))
            self.first[k] += 0.1 * (v - self.first[k])
            self.second[k] += 0.01 * (v * v - self.second[k])
            move = self.first[k] / (1 - 0.9**self.steps) / (np.sqrt(self.second[k] / (1 - 0.99**self.steps)) + 1e-8)
            p[k] = (p[k] - RATE * move).astype(np.float32)
        return loss


def _prior(texts: list[list[bytes]], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[bytes, float]]:
    """Log ratios of how many texts of each label hold a word or n-gram, by place, within -3 and 3, small where few do; and the words' own."""
    size = 1 << BITS
    words = list(set().union(*texts))
    own, grams, begins = word_features(words)
    number = dict(zip(words, range(len(words))))
    holds = np.zeros((2, 2, size)) + 0.5
    for text, label in zip(texts, y):
        ids = np.array([number[w] for w in set(text)], np.int64)
        holds[label, 0, np.unique(own[ids])] += 1
        holds[label, 1, np.unique(np.concatenate([grams[begins[i] : begins[i + 1]] for i in ids]))] += 1
    totals = np.array([max(1, (y == k).sum()) for k in (0, 1)])[:, None, None] + 1
    ratio = np.clip(np.log(holds[1] / totals[1]) - np.log(holds[0] / totals[0]), -3, 3)
    seen = holds.sum(axis=0) - 1
    ratio *= seen / (seen + FEW)
    best = np.maximum.reduceat(ratio[1][grams], begins[:-1])
    return ratio[0].astype(np.float32), ratio[1].astype(np.float32), dict(zip(words, ratio[0][own] + best))


def fit(texts: list[bytes], labels: np.ndarray, share: float | None = None) -> Network:
    """Trained on four fifths of the sample; slope and offset on the rest. share: of label 1 among all labelled rows.

    A text's label is not that of each of its windows. Windows of label-0 texts are all of label 0; of a label-1 text that with the
    most telling word stands for it at first, and after half of the passes that which the network scores highest.
    """
    share = min(max(labels.mean() if share is None and len(labels) else share or 0.5, 1e-3), 1 - 1e-3)
    # one text each without words, so that there are vectors to draw even from an empty sample
    cut = [words_of(t) for t in texts]
    used = np.flatnonzero([bool(w) for w in cut])
    if len(set(labels[used].tolist())) < 2:
        blank = Trainer([b"x"], (np.float32(0), np.float32(0))).p
        return Network(blank, BLIND, float(np.log(share / (1 - share))))
    rest = used[np.arange(len(used)) % 5 == 4]
    own = used[np.arange(len(used)) % 5 != 4]
    if len(set(labels[rest].tolist())) < 2 or len(set(labels[own].tolist())) < 2:
        rest = own = used
    *prior, telling = _prior([cut[i] for i in own], labels[own])
    words = sorted(set().union(*(cut[i] for i in own)))
    number = dict(zip(words, range(1, len(words) + 1)))
    value = np.array([0.0, *(telling[w] for w in words)])
    rows = [windows(np.array([number[w] for w in cut[i]], np.int64)) for i in own]
    y = labels[own]
    trainer, draw = Trainer(words, tuple(prior)), np.random.default_rng(SEED)
    weight = np.array([1.0, (y == 0).sum() / max(1, (y == 1).sum())])
    picked = [int(value[r].max(axis=1).argmax()) for r in rows]
    passes = max(8, -(-STEPS // -(-2 * len(own) // BATCH)))
    for turn in range(passes):
        if turn == passes // 2:
            model = _ready(trainer, words)
            picked = [int(model.logits(r).argmax()) for r in rows]
        chosen = [(r[k], r[draw.integers(len(r))] if label == 0 else r[k]) for r, k, label in zip(rows, picked, y)]
        batch, of = np.concatenate(list(map(np.stack, chosen))), np.repeat(np.arange(len(own)), 2)
        order = draw.permutation(len(batch))
        for k in range(0, len(order), BATCH):
            part = order[k : k + BATCH]
            trainer.step(batch[part], y[of[part]], np.minimum(weight[y[of[part]]], 10))
    model = Network(trainer.p)
    best = model.best([texts[i] for i in rest]).astype(np.float64)
    real = np.array([1 - share, share]) / np.array([(labels[rest] == 0).mean(), (labels[rest] == 1).mean()])
    model.slope, model.offset = calibrate(best, labels[rest], real[labels[rest]])
    return model


def _ready(trainer: Trainer, words: list[bytes]) -> Network:
    """A network whose table holds the training words under their numbers."""
    model = Network(trainer.p)
    rows = [model.inputs(words[k : k + 4096]) @ trainer.p["in"] + trainer.p["in_bias"] for k in range(0, len(words), 4096)]
    model.table = np.concatenate([np.zeros((1, 6 * HIDDEN), np.float32), *rows]).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, longest: int = LONGEST) -> Network:
    """A network for the labelled rows of `docs` that are not held out: trained in one task, on a bounded sample of them."""
    usable = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id").cast("long")))
    share = usable.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return fit_in_task(training_sample(docs, labels, label, per_class, longest), lambda texts, y: fit(texts, y, share))


def score_documents(docs: DataFrame, model: Network) -> DataFrame:
    """doc_id and score of every row of `docs`: the highest of all overlapping windows of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few megabytes, whatever the input

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.scores(utf8(batch)), pa.float64())], ["doc_id", "score"])

    return map_arrow(doc_ids_and_text(docs), work, "doc_id long, score double")


def clean_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.3, per_class: int = PER_CLASS, longest: int = LONGEST) -> DataFrame:
    """The rows of `docs`, all columns kept, that toxicity_scores predicts to be of label 0.

    Without labelled texts of both classes nothing is known that could tell rows apart, so all of them stay.
    """
    network = train(docs, labels, label, per_class, longest)
    if network.slope <= BLIND:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores([(t or "").encode() for t in texts]))

    prepare(docs.sparkSession)
    return docs.filter(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) < threshold)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.3, per_class: int = PER_CLASS, longest: int = LONGEST) -> DataFrame:
    """doc_id, held_out, score and predicted (1 where score >= threshold) of every row of `docs`.

    The network is trained on a bounded sample of labelled rows that are not held out (per_class, longest: see training_sample);
    all overlapping windows of every whole text are scored, and the highest counts. Only the text enters a score. A null text is
    empty: it has one window without words. Null ids and repeated rows stay. With labels of one class only, or none, all scores
    are about the share of label 1 (a half without any).
    """
    scored = score_documents(docs, train(docs, labels, label, per_class, longest))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
