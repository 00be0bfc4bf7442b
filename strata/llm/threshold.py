"""Exact top-k search by inner product with the threshold algorithm over sorted lists, one a dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import arrow_batches, keep, prepare
from strata.session import broadcast_if_small

#: Vectors of a chunk, which has sorted lists of its own, and queries that go through it together.
CHUNK_ROWS, QUERY_ROWS = 4096, 1024
#: Rows of every list that are read in the first step; each further step reads twice as many.
FIRST_STEP = 8
#: Components below it (after scaling) are packed in four bytes, larger ones as doubles: floors of finite doubles are doubles.
SMALL = 1 << 31
PACKED = "dim int, kind string, chunk string, ids binary, vectors binary"


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v, floor(scale * x) of every component as a double; only rows with an id and without null or non-finite components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & finite).select("vec_id", F.col("e").alias("v"), F.lit(scale).alias("scale"))


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed, `size` at most together, by their number of dimensions and kind; chunk names each. Nothing is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, count = TaskContext.get().partitionId(), 0
        held: dict[tuple[int, str], list[tuple[int, np.ndarray]]] = {}

        def packed(of: tuple[int, str]) -> pa.RecordBatch:
            ids, vectors = zip(*held.pop(of))
            data = [np.array(ids, "<i8").tobytes(), np.concatenate(vectors).astype(of[1]).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([of[0]], pa.int32()), pa.array([of[1]]), pa.array([f"{task}-{count}"]), *(pa.array([x], pa.binary()) for x in data)], ["dim", "kind", "chunk", "ids", "vectors"])

        for batch in batches:
            for vec_id, v, scale in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "v", "scale"))):
                whole = _floors(v, scale)
                of = (len(v), "<i4" if np.abs(whole).max(initial=0) < SMALL else "<f8")
                held.setdefault(of, []).append((vec_id, whole))
                if len(held[of]) >= size:
                    yield packed(of)
                    count += 1
        for of in sorted(held):
            yield packed(of)
            count += 1

    prepare(rows.sparkSession)
    return rows.mapInArrow(work, PACKED)


def _floors(vector: list[float], scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(np.array(vector, float) * float(scale))
    if not np.isfinite(scaled).all():
        raise ValueError("a component is beyond all doubles once scaled")
    return scaled


class Lists:
    """Vectors of one chunk with, for each dimension, their numbers in order of that component, from both ends."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.n, self.dims = ids, len(ids), np.arange(vectors.shape[1])
        self.top_value = int(np.abs(vectors).max(initial=0))
        self.plain = vectors
        rising = np.argsort(vectors, axis=0, kind="stable").T
        self.numbers = np.stack([rising[:, ::-1], rising])  # best first for a positive and for a negative weight
        self.held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def _exact(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights, vectors and sorted values in a type in which no sum of products is rounded: Python's integers for the largest."""
        most = self.top_value * int(np.abs(query).max(initial=0)) * len(self.dims)
        kind = "f8" if most < 1 << 52 else "i8" if most < 1 << 62 else "O"
        if kind not in self.held:
            vectors = _typed(self.plain, kind)
            dims = self.dims[:, None]
            self.held[kind] = vectors, np.stack([vectors.T[dims, self.numbers[0]], vectors.T[dims, self.numbers[1]]])
        return _typed(query, kind), *self.held[kind]

    def top(self, query: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """The k best as (score, id, number in the chunk), ties to the smaller id; and how it is known.

        All lists are read in step. Every vector met is scored in full. What has not been met yet has, in each dimension, at most
        the value read last, so its score is at most the sum of the weights times these: once the k-th best exceeds that bound
        the rest cannot change the result. Equal to it is not enough, as an unmet vector could tie with a smaller id.
        """
        if not len(self.dims):  # nothing to sum: all are equal
            return [(0, int(self.ids[i]), int(i)) for i in np.argsort(self.ids, kind="stable")[:k]]
        weights, vectors, values = self._exact(query)
        side = (query < 0).astype(np.intp)
        met = np.zeros(self.n, bool)
        best: list[tuple[int, int, int]] = []
        depth, step = 0, FIRST_STEP
        while depth < self.n:
            until = min(self.n, depth + step)
            now = np.zeros(self.n, bool)
            now[self.numbers[side, self.dims, depth:until].ravel()] = True
            new = np.flatnonzero(now & ~met)
            met |= now
            if len(new):
                scores = vectors[new] @ weights
                if scores.dtype != object and len(new) > k:  # only the k best of them can matter, and what ties with the last
                    near = scores >= np.partition(scores, len(new) - k)[len(new) - k]
                    new, scores = new[near], scores[near]
                best += [(int(s), int(self.ids[i]), int(i)) for s, i in zip(scores, new)]
                best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
            bound = weights @ values[side, self.dims, until - 1]
            if len(best) == k and best[-1][0] > bound or met.all():
                break
            depth, step = until, 2 * step
        return best


def _typed(x: np.ndarray, kind: str) -> np.ndarray:
    if kind != "O":
        return x.astype(kind)
    whole = np.empty(x.shape, object)
    whole[...] = np.vectorize(int, otypes=[object])(x) if x.size else x
    return whole


LONG = 1 << 63
HITS = "place int, query_id long, vec_id long, score long, below boolean, same boolean, block string"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each row of `queries` its k highest inner products with rows of `vectors`.

    Components are floor(scale * x) as integers of any size, sums exact. Candidates are all rows but the query's own with as many
    components; all, if fewer than k. Ties go to the smaller vec_id. The query's own row is one with its id and its vector: another
    row with that id is a candidate, and so is each further repetition of the row. Empty vectors score 0 with each other. Rows
    without an id, with a null vector, or with null or non-finite components take no part. A result that is beyond a long
    raises. Other columns are not read. Vectors are packed into chunks where they lie; each block of queries meets
    each chunk once, and the best of all chunks are merged. Memory of a task: one chunk with its lists, one block.
    """
    spark = vectors.sparkSession
    chunks = keep(pack(quantised(vectors, scale, id_col, vector_col), CHUNK_ROWS), "chunks")
    blocks = keep(pack(quantised(queries, scale, id_col, vector_col), QUERY_ROWS), "blocks").select(
        "dim", F.col("kind").alias("query_kind"), F.col("chunk").alias("block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors")
    )
    names = broadcast_if_small(chunks.select("dim", "chunk"))
    met = blocks.join(names, "dim").drop("dim").join(chunks.hint("merge"), "chunk")

    def unpacked(ids: bytes, vectors: bytes, kind: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.frombuffer(ids, "<i8")
        return numbers, np.frombuffer(vectors, kind).reshape(len(numbers), dim)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, lists = None, None
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if row["chunk"] != name:
                    name, lists = row["chunk"], Lists(*unpacked(row["ids"], row["vectors"], row["kind"], dim))
                found = []
                for place, (query, vector) in enumerate(zip(*unpacked(row["query_ids"], row["query_vectors"], row["query_kind"], dim))):
                    for score, hit, number in lists.top(vector, k + 1):  # one more, in case the own row is among them
                        if score >= LONG:
                            raise ValueError("a score is beyond a long")
                        own = hit == query and np.array_equal(lists.plain[number], vector)
                        found.append((place, int(query), hit, max(score, -LONG), score < -LONG, bool(own), row["block"]))
                if found:
                    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], [x.split()[0] for x in HITS.split(", ")])

    with arrow_batches(spark, 2):  # each row is a chunk and a block
        hits = keep(met.sortWithinPartitions("chunk").mapInArrow(work, HITS), "hits")
    query = Window.partitionBy("block", "place")
    # of the rows equal to the query in id and vector one is the query itself; which one makes no difference
    others = hits.withColumn("nth", F.row_number().over(query.orderBy(F.col("same").desc(), "score"))).filter(~(F.col("same") & (F.col("nth") == 1)))
    ranked = others.select("*", F.row_number().over(query.orderBy(F.col("score").desc(), "vec_id")).alias("rank")).filter(F.col("rank") <= k)
    fits = F.when(F.col("below"), F.raise_error(F.lit("a score is beyond a long")).cast("long")).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", "vec_id", fits.alias("score"))
