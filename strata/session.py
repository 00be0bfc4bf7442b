"""Session settings, the shared scratch folder, and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from strata.functions import fixed_time

# A side of a join is broadcast only after counting that it has at most this many rows, and so many bytes in them.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

#: How tables of many rows are written, whatever the session's codec: whole numbers as differences from the row before, pages by zstd.
DENSE = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Spark's own check of what it may broadcast: key pairs of a dimension of a few million rows still fit.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Tables split by a few values are written without sorting every task's rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every column costs several calls to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Rows of a fact, shuffled by month, and of lines, shuffled by order, take two thirds of the bytes that LZ4 leaves of them.
    "spark.io.compression.codec": "zstd",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(name: str = "strata", **extra: str) -> SparkSession:
    """A session with the settings above; the cluster decides master, memory and shuffle partitions."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint folder. Where none is set, a temporary one under a local master, whose
    tasks all run on this machine; under any other master that would be a different disk on each executor, so it is refused."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="strata-")
    return _own_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/strata/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "held") -> DataFrame:
    """Write `df` to the shared folder and read it back: its rows, ids included, are then fixed whatever executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, counts: Mapping[str, Column], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write `df` and return the aggregates `counts` of the rows written, taken on the way: nothing is read again for them.

    They are taken in the tasks that write, after the last shuffle. Spark adds up one successful attempt of each of these, so a task that
    is repeated, or runs twice by speculation, counts once.
    """
    if not counts:
        write(df)
        return {}
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return seen.get


def materialize_counted(
    df: DataFrame, label: str, counts: Mapping[str, Column], options: Mapping[str, str] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """`materialize`, and aggregates of the rows from the write itself. options: of the writer, such as `DENSE`."""
    path = scratch_path(df.sparkSession, label)
    seen = counted(df, counts, lambda rows: rows.write.options(**(options or {})).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


def row_bytes(df: DataFrame) -> Column:
    """About what a row holds: the bytes of its texts and binaries, and the default size of every other column, of an array for each entry."""

    def size(value: Column, kind: DataType) -> Column:
        if isinstance(kind, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(value).cast("long"), F.lit(0)) + 8
        if isinstance(kind, StructType):
            return reduce(Column.__add__, [size(value.getField(f.name), f.dataType) for f in kind.fields], F.lit(8).cast("long"))
        if isinstance(kind, ArrayType):
            entries = F.coalesce(value, F.array().cast(kind))
            return F.aggregate(entries, F.lit(16).cast("long"), lambda total, x: total + size(x, kind.elementType))
        return F.lit(16).cast("long")

    return reduce(Column.__add__, [size(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], F.lit(0).cast("long"))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when counting shows at most `rows` rows that hold at most `size` bytes; otherwise the join shuffles.

    Counts and adds up, a row a task, so pass something cheap: a written table of few columns.
    """
    seen = df.agg(F.count("*").alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return F.broadcast(df) if seen["rows"] <= rows and (seen["bytes"] or 0) <= size else df


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of `schema`, known to be none when a plan is optimized, so that joins with it disappear."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).filter(F.lit(False)).select(*nothing)


def one_row(spark: SparkSession, schema: StructType, **values) -> DataFrame:
    """A single row from literals; columns not given are NULL."""

    def literal(value):
        return fixed_time(value) if isinstance(value, datetime) else F.lit(value)

    return spark.range(1).select(*[literal(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema])
