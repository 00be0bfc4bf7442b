"""What the operators share: results kept on shared storage, Arrow batches of bounded size, named columns of any table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import materialize, scratch_path

# Rows of one Arrow batch that goes to Python; a batch is all that a task holds there, whatever the table's size.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the batches sent to Python, by rows and by bytes: a few very long texts then travel alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keep(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` written to the shared folder and read back: lineage is cut and a lost executor loses nothing."""
    return materialize(df, label)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(work, schema)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    column = batch.column(name).cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def doc_ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that are read, so that others never leave the scan, under fixed names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def row_key(docs: DataFrame) -> Column:
    """128 bits of hash of all columns, as a struct of two longs: rows that share it are taken for repeated rows."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.struct(F.xxhash64(*columns).alias("x"), F.xxhash64(F.lit("second"), *columns).alias("y"))


ROW_KEY = "struct<x:long,y:long>"


def with_decisions(docs: DataFrame, key: Column, decisions: DataFrame, column: str) -> DataFrame:
    """Each row of `docs` with `column` of the row of `decisions` (key, column; keys distinct) that has its key; others go.

    docs may have any column names; the key and the decision stand beside a struct of the row. Both sides are shuffled at every size:
    there are about as many decisions as rows, so they are never broadcast.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    return rows.join(decisions.select("key", F.col(column).alias("decision")).hint("merge"), "key")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of `rows` rows for what is run inside; then as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def crc_bucket(id_col: Column, buckets: int) -> Column:
    """crc32 of the id's decimal text modulo `buckets`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def crc32(data: bytes) -> int:
    return zlib.crc32(data)


__all__ = ["BATCH_ROWS", "ROW_KEY", "arrow_batches", "crc32", "crc_bucket", "doc_ids_and_text", "keep", "map_arrow", "row_key", "with_decisions", "prepare", "read_table", "scratch_path", "utf8"]
