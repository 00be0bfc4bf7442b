"""Tables that are merged into: Parquet directories that are never changed in place.

A new version goes to a directory of its own and becomes current when one small file listing its parts is added to `_versions`. A crash
before that leaves the old version current; the next attempt overwrites the unfinished directory. Parts (months of a fact, one part for
a dimension) that a merge did not touch are listed again, not rewritten, so a version costs what changed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import session
from strata.operators.spans import narrowed
from strata.schemas import VERSIONS
from strata.session import counted, empty_frame, one_row

class Origin(NamedTuple):
    """A batch of a stream: the stream's own id, which its checkpoint keeps, and the number of the batch."""

    stream: str
    batch: int


class Tally:
    """Aggregates to take of the rows of a write, and what they came to."""

    def __init__(self, wanted: Mapping[str, Column]):
        self.wanted, self.seen = wanted, dict[str, int]()


PART = "_part"
WHOLE = 0  # the part of a table that is not split


def read_or_create(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at `path`, which is made, without rows, if nothing is there."""
    empty_frame(spark, schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def month_part() -> Column:
    """Part of a fact: its month as yyyymm, 0 without a date."""
    return F.coalesce(F.expr("date_key div 100"), F.lit(0)).cast("bigint")


def _current(spark: SparkSession, path: str) -> tuple[int, list[tuple[int, int]]]:
    """The current version and its (data version, part) entries: one row, with at most a few hundred months in it."""
    log = read_or_create(spark, f"{path}/_versions", VERSIONS)
    row = log.agg(F.max("version").alias("version"), F.max_by("entries", "version").alias("entries")).first()
    return (0, []) if row.version is None else (row.version, [tuple(e) for e in row.entries])


def part_versions(spark: SparkSession, path: str) -> dict[int, int]:
    """Each part of the current version with the version that last changed it. Reads the list of versions, no data."""
    latest: dict[int, int] = {}
    for version, part in _current(spark, path)[1]:
        latest[part] = max(version, latest.get(part, 0))
    return latest


def read_table(spark: SparkSession, path: str, schema: StructType, parts: list[int] | None = None) -> DataFrame:
    """The current version (or only some of its parts); no rows before the first."""
    listed = [(v, p) for v, p in _current(spark, path)[1] if parts is None or p in parts]
    if not listed:
        return empty_frame(spark, schema)
    files = [f"{_data_path(path, v)}/{PART}={p}" for v, p in sorted(listed)]
    return spark.read.schema(schema).option("basePath", path).parquet(*files).select(*schema.names)


def _data_path(path: str, version: int) -> str:
    return f"{path}/data_version={version}"


def read_data(spark: SparkSession, path: str, version: int, schema: str | StructType) -> DataFrame:
    """What was written for one version, without the parts it took over. Data may hold more columns than the table's schema."""
    return spark.read.schema(schema).parquet(_data_path(path, version))


def publish(
    spark: SparkSession, path: str, df: DataFrame, now: datetime, part: Column | None = None, replaces: list[int] | None = None,
    tally: Tally | None = None, origin: Origin | None = None, key: Sequence[str] = (),
) -> int:
    """Write `df` as data of a new version and make that current. `replaces` are the old parts it stands for: all of them when None,
    none of them ([]) when `df` only adds rows. tally: what to count of the rows while they are written. origin: the batch of a stream that
    they come from. key: columns by which later batches look rows up; the rows of a file lie in their order, and its row groups carry
    a bloom filter of the first, so that a lookup reads few of them. Returns the version."""
    current, entries = _current(spark, path)
    version = current + 1
    data = _data_path(path, version)
    if part is None:
        parted = df.withColumn(PART, F.lit(WHOLE).cast("bigint"))
    else:
        # Rows of a part come together, so parts are few files each; adaptive execution splits a part that is too large for one task.
        parted = df.withColumn(PART, part).hint("rebalance", PART)

    def write(rows: DataFrame) -> None:
        # After the counting, which would hide from the writer that the rows are in order already.
        ordered = rows.sortWithinPartitions(PART, *key) if key else rows
        writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**session.DENSE, **(_looked_up_by(key[0]) if key else {}))
        writer.partitionBy(PART).parquet(data)

    seen = counted(parted, tally.wanted if tally else {}, write)
    # Reads no data columns, only which part directories there are.
    written = read_data(spark, path, version, f"{PART} LONG").distinct().collect()
    kept = [] if replaces is None else [(v, p) for v, p in entries if p not in replaces]
    listed = [F.struct(F.lit(v), F.lit(p)) for v, p in kept + [(version, r[0]) for r in written]]
    _point(spark, path, version, now, listed, origin)
    if tally:
        tally.seen = seen
    return version


def _looked_up_by(key: str) -> dict[str, str]:
    """What the Parquet writer is told of a key column: a bloom filter as large as the keys of a row group need."""
    return {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _point(spark: SparkSession, path: str, version: int, now: datetime, listed: list[Column], origin: Origin | None) -> None:
    values = {"version": version, "published_at": now} | ({"stream": origin.stream, "stream_batch": origin.batch} if origin else {})
    pointer = one_row(spark, VERSIONS, **values).withColumn("entries", F.array(*listed).cast(VERSIONS["entries"].dataType))
    pointer.write.mode("append").parquet(f"{path}/_versions")


def mark_done(spark: SparkSession, path: str, now: datetime, origin: Origin) -> None:
    """A version of the same content that says that a stream's batch, which added nothing, has been taken in."""
    current, entries = _current(spark, path)
    _point(spark, path, current + 1, now, [F.struct(F.lit(v), F.lit(p)) for v, p in entries], origin)


def taken_in(spark: SparkSession, path: str, origin: Origin) -> bool:
    """Whether a version of the table holds a stream's batch already. Reads the list of versions, no data."""
    log = read_or_create(spark, f"{path}/_versions", VERSIONS)
    return not log.filter((F.col("stream") == origin.stream) & (F.col("stream_batch") == origin.batch)).isEmpty()


def compact(spark: SparkSession, path: str, schema: StructType, now: datetime, part: Column | None = None, key: Sequence[str] = ()) -> int:
    """Write the current rows again as one version. For tables that many small additions have left in many directories."""
    return publish(spark, path, read_table(spark, path, schema), now, part, key=key)


def newest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that the last version with data has written, without what it took over; no rows before the first."""
    entries = _current(spark, path)[1]
    return read_data(spark, path, max(v for v, _ in entries), schema) if entries else empty_frame(spark, schema)


def held_parts(table: DataFrame, updates: DataFrame, keys: list[str], part: Column, updates_rows: int | None = None) -> DataFrame:
    """The part of each row of `table` whose key is one of `updates`. The table's keys are first cut to the spans of the updates',
    in the scan; what is left is joined with them: broadcast where they were counted to be few, otherwise both sides are shuffled."""
    wanted = updates.select(*keys)
    near = narrowed(table, wanted, keys[0], updates_rows)
    if updates_rows is not None and updates_rows <= session.BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return near.join(wanted, keys, "left_semi").select(part.alias(PART))


def touched_parts(table: DataFrame, updates: DataFrame, keys: list[str], part: Column, updates_rows: int | None = None) -> list[int]:
    """Parts of `table` that hold a key of `updates`, and parts the updates fall into. A key does not tell its part, so the table's keys
    are looked up. Only the distinct parts, at most one per month, come to the driver."""
    held = held_parts(table, updates, keys, part, updates_rows)
    return [r[0] for r in held.union(updates.select(part.alias(PART))).distinct().collect()]
