"""Whitening of embeddings: leading eigenpairs of their covariance by spectrum slicing, then a projection of every row."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import keep, map_arrow

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Bunch and Kaufman's bound on pivots: it keeps the factors of an indefinite matrix from growing.
PIVOT = (1 + 17**0.5) / 8
#: Rayleigh quotient steps from one start; each triples the correct digits, so a few are enough near an isolated eigenvalue.
STEPS = 12
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def positive_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above zero: the positive pivots of its LDL' factorisation (Sylvester's inertia).

    Pivots are single entries or, where those are too small beside their column, blocks of two, which have one eigenvalue of each sign.
    """
    a, n, k, positive = matrix.copy(), len(matrix), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        own, two = abs(a[k, k]), False
        if max(own, most) == 0.0:  # a zero column: a zero eigenvalue
            k += 1
            continue
        if own < PIVOT * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            rest = row.max()
            if own * rest < PIVOT * most * most:
                if abs(a[r, r]) >= PIVOT * rest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            block, column = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= column @ np.linalg.solve(block, column.T)
            positive += 1
            k += 2
        else:
            column = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(column, column / a[k, k])
            positive += a[k, k] > 0
            k += 1
    return int(positive)


class Slices:
    """Eigenvalues of a symmetric matrix by counts: how many lie above a shift is known from one factorisation."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.n = matrix, len(matrix)
        off = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        self.norm = max(float((np.abs(np.diag(matrix)) + off).max()), np.finfo(float).tiny)
        self.low, self.high = -self.norm, 2 * self.norm
        self.known = {self.low: self.n, self.high: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = positive_pivots(self.matrix - shift * np.eye(self.n))
        return self.known[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """The tightest known interval that holds the k-th largest eigenvalue (from 1)."""
        return max(s for s, c in self.known.items() if c >= k), min(s for s, c in self.known.items() if c < k)

    def isolate(self, k: int) -> tuple[float, float, bool]:
        """Bisect until the interval holds the k-th eigenvalue only, or is as narrow as rounding allows (then it holds a cluster)."""
        while True:
            low, high = self.bracket(k)
            if self.known[low] == k and self.known[high] == k - 1:
                return low, high, True
            if high - low <= 8 * self.n * np.finfo(float).eps * self.norm:
                return low, high, False
            self.above((low + high) / 2)

    def halve(self, k: int) -> bool:
        low, high = self.bracket(k)
        if high - low <= 8 * self.n * np.finfo(float).eps * self.norm:
            return False
        self.above((low + high) / 2)
        return True

    def pair(self, k: int, found: np.ndarray) -> tuple[float, np.ndarray]:
        """The k-th eigenvalue and a unit eigenvector at right angles to the rows of `found`.

        From the middle of the isolating interval one inverse step, then Rayleigh quotient steps. A quotient that leaves the
        interval, or a count that gives the result another number than k, halves the interval and starts again.
        """
        random = np.random.default_rng(k)
        enough = 16 * self.n * np.finfo(float).eps * self.norm
        while True:
            low, high, alone = self.isolate(k)
            x = _straight(random.standard_normal(self.n), found)
            value = (low + high) / 2
            for step in range(STEPS):
                x = _straight(_solve(self.matrix, value, x), found)
                y = self.matrix @ x
                rest = np.linalg.norm(y - (x @ y) * x)
                if alone and step:
                    value = float(x @ y)
                    if not low <= value <= high:
                        break
                if rest <= enough:
                    break
            value = float(x @ (self.matrix @ x))
            slack = 4 * max(rest, enough)
            certain = self.above(value - slack) >= k and self.above(value + slack) < k
            if rest <= 64 * enough and (certain or not alone):
                return value, x
            if not self.halve(k):
                return value, x


def _straight(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):  # twice is enough
        if len(found):
            x = x - found.T @ (found @ x)
        x = x / np.linalg.norm(x)
    return x


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    size = np.abs(matrix).max()
    for nudge in (0.0, 1.0, -3.0):  # a shift that is an eigenvalue to the last bit leaves nothing to divide by
        try:
            y = np.linalg.solve(matrix - (shift + nudge * 4 * np.finfo(float).eps * size) * np.eye(len(x)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all() and y.any():
            return y / np.abs(y).max()
    return x


def leading_pairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues, falling, and their eigenvectors as rows. Those that rounding cannot tell from zero are left out."""
    if not len(matrix) or not np.abs(matrix).max():
        return np.empty(0), np.empty((0, len(matrix)))
    # Worked on at a scale near one, so that no product of entries leaves the range of doubles.
    scale = 2.0 ** np.round(np.log2(np.abs(matrix).max()))
    slices = Slices(matrix / scale)
    count = min(most, slices.above(4 * len(matrix) * np.finfo(float).eps * slices.norm))
    values, vectors = [], np.empty((0, len(matrix)))
    for k in range(1, count + 1):
        value, vector = slices.pair(k, vectors)
        values.append(value)
        vectors = np.vstack([vectors, vector])
    order = np.argsort(-np.array(values), kind="stable")  # within a cluster, the quotients decide
    return np.array(values)[order] * scale, vectors[order]


def _matrix(batch: pa.RecordBatch, dim: int, scale: int, shift: int) -> np.ndarray:
    """floor(scale * x) + shift of a batch of vectors, as int64."""
    values = np.floor(batch.column("e").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * float(scale))
    if not (np.abs(values) < float(1 << 62)).all():
        raise ValueError("a component is too large for a long once scaled")
    return values.astype(np.int64) + shift


def _exact(x: np.ndarray, factor: int) -> np.ndarray:
    """`x` in a type in which `factor` times it cannot overflow."""
    top = int(np.abs(x).max(initial=0))
    return x if top * max(factor, 1) < 1 << 62 else x.astype(object)


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _rows(matrix: np.ndarray) -> pa.RecordBatch:
    """A task's matrix, a row each, to be added up with those of the other tasks."""
    n = len(matrix)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int32()), pa.array([_task()] * n, pa.int32()), pa.array(matrix.tolist(), pa.list_(pa.float64()))], ["i", "task", "v"]
    )


MATRIX = "i int, task int, v array<double>"


def added(parts: DataFrame) -> DataFrame:
    """i and v: rows of one number added up, in order of their tasks, so that reruns agree to the last bit. In: as from _rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for i, v in zip(batch.column("i").to_pylist(), batch.column("v").to_pylist()):
                if i != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["i", "v"])
                    now, total = i, np.zeros(len(v))
                total += v
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["i", "v"])

    return map_arrow(parts.repartition("i").sortWithinPartitions("i", "task"), work, "i int, v array<double>")


def sums(rows: DataFrame, dim: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension. A row a task is added up; a number a dimension comes to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = _matrix(batch, dim, scale, shift)
            count += len(x)
            total = total + _exact(x, len(x)).sum(axis=0).astype(object)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array([count], pa.int64()), pa.array([[Decimal(int(s)) for s in total]], pa.list_(pa.decimal128(38, 0)))], ["n", "s"]
            )

    parts = map_arrow(rows, work, "n long, s array<decimal(38,0)>").select("n", F.posexplode("s").alias("i", "s"))
    whole = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (whole[0].n, [int(r.s) for r in whole]) if whole else (0, [0] * dim)


def covariance(rows: DataFrame, dim: int, n: int, total: list[int], scale: int, shift: int) -> DataFrame:
    """The covariance (divisor n) as rows i, v. Whole numbers are centred before anything is multiplied."""
    near = [round(s / n) for s in total]
    rest = np.array([(s - n * m) / n for s, m in zip(total, near)])
    middle = np.array(near, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dim, dim))
        for batch in batches:
            centred = (_matrix(batch, dim, scale, shift) - middle) - rest
            products += centred.T @ centred
        yield _rows(products / n)

    return added(map_arrow(rows, work, MATRIX))


def eigenpairs(matrix: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Leading eigenvalues, eigenvectors and the trace of a matrix given as rows i, v. Solved in one task, whose memory is the matrix, bounded
    by the number of dimensions; what comes to the driver is `most` vectors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {i: v for batch in batches for i, v in zip(batch.column("i").to_pylist(), batch.column("v").to_pylist())}
        if not rows:
            return
        whole = np.array([rows[i] for i in range(len(rows))])
        whole = (whole + whole.T) / 2
        values, vectors = leading_pairs(whole, most)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(values) + 1), pa.int32()),
                pa.array([float(np.trace(whole)), *values.tolist()], pa.float64()),
                pa.array([[], *vectors.tolist()], pa.list_(pa.float64())),
            ],
            ["k", "e", "u"],
        )

    found = map_arrow(matrix.repartition(1), work, "k int, e double, u array<double>").orderBy("k").collect()
    return np.array([r.e for r in found[1:]]), np.array([r.u for r in found[1:]]), found[0].e


def _projected(rows: DataFrame, dim: int, n: int, total: list[int], values: np.ndarray, vectors: np.ndarray, scale: int, shift: int) -> DataFrame:
    """vec_id, deviation and w, the whitened coordinates, of every row."""
    near = [round(s / n) for s in total]
    rest = np.array([(s - n * m) / n for s, m in zip(total, near)])
    middle = np.array(near, np.int64)
    turn = (vectors / np.sqrt(values)[:, None]).T

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dim, scale, shift)
            spread = n * _exact(x, n).astype(object) - np.array(total, object)
            top = max((abs(int(v)) for v in (spread.max(), spread.min())), default=0) if spread.size else 0
            squares = (spread.astype(np.int64) ** 2 if top * top * dim < 1 << 62 else spread * spread).sum(axis=1)
            if top * top * dim >= 1 << 62 and any(int(v) >= 1 << 63 for v in squares):
                raise ValueError("a deviation is too large for a long")
            w = ((x - middle) - rest) @ turn
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([int(v) for v in squares], pa.int64()), pa.array(w.tolist(), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"]
            )

    return map_arrow(rows, work, "vec_id long, deviation long, w array<double>")


def identity_error(wide: DataFrame, n: int, most: int) -> float:
    """The largest absolute entry of the covariance of all coordinates, as they were written, minus the identity."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total = np.zeros((most, most)), np.zeros(most)
        for batch in batches:
            w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(-1, most)
            products += w.T @ w
            total += w.sum(axis=0)
        yield _rows(np.vstack([products, total]) / n)

    rows = {r.i: np.array(r.v) for r in added(map_arrow(wide.select("w"), work, MATRIX)).collect()}
    products, mean = np.array([rows[i] for i in range(most)]), rows[most]
    return float(np.abs(products - np.outer(mean, mean) - np.eye(most)).max())


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each vector and leading component.

    Vectors become whole numbers x = floor(scale * c) + shift. n is their count, S their sum; deviation is the sum over dimensions of
    (n * x - S) squared, exact. Components are the eigenvectors of the covariance (divisor n), numbered from 1 by falling eigenvalue e;
    whitened is x - S / n projected on one, over the root of e; explained is e / trace. There are at most `components`, fewer where
    the covariance has fewer eigenvalues above rounding error: a direction without variance cannot be whitened, so it has no rows
    (equal vectors, or a single one, give none at all). identity_error is computed from the written coordinates.

    Rows whose vector is null or holds null or non-finite entries are dropped; so are empty vectors, which have no components.
    Null ids, ties and repeated rows stay. Vectors of another length are whitened by themselves, as a list of their own. A
    scaled component of 2**62 or more, or a deviation beyond a long, raises. Other columns are not read. Empty in, empty out.

    Eigenvalues are isolated by inertia counts (spectrum slicing), eigenvectors found by Rayleigh quotient iteration, and numbers
    certified by counts at both sides. Every task holds one batch of vectors and one matrix of dimensions x dimensions.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))
    rows = rows.filter(F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("e") > 0))
    lengths = [r[0] for r in rows.select(F.size("e")).distinct().collect()]
    results = [_whiten_length(spark, rows.filter(F.size("e") == dim), dim, components, scale, shift) for dim in sorted(lengths)]
    return reduce(DataFrame.union, results) if results else spark.createDataFrame([], RESULT)


def _whiten_length(spark: SparkSession, rows: DataFrame, dim: int, components: int, scale: int, shift: int) -> DataFrame:
    n, total = sums(rows, dim, scale, shift)
    values, directions, trace = eigenpairs(covariance(rows, dim, n, total, scale, shift), components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    wide = keep(_projected(rows, dim, n, total, values, directions, scale, shift), "whitened")
    error = identity_error(wide, n, len(values))
    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    long = wide.select("vec_id", "deviation", F.posexplode("w").alias("place", "whitened"))
    return long.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
