"""Files and tables in and out: CSV leads, access logs, whole-table writes, quarantine."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata import fixed
from strata.operators.numbering import file_position
from strata.schemas import LEADS_CSV, LOG_LINES, QUARANTINE
from strata.session import counted, empty_frame


def read_leads(spark: SparkSession, path: str, located: bool = False) -> DataFrame:
    """Leads as text, from a file or a folder with subfolders. Columns go by the name in each file's header, whatever their order or case.

    A header without one of the columns raises; further columns are left out. Files of one header are read together. located: with
    the columns of `file_position`, for numbering the records. An empty file has no header and no leads.
    """
    groups = []
    for header, paths in sorted(_headers(spark, path).items()):
        names = next(csv.reader([header]))
        own = {name.strip().lower(): k for k, name in reversed(list(enumerate(names)))}
        missing = [c for c in LEADS_CSV.names if c not in own]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header of {paths[0]}")
        given = StructType([StructField(f"_c{k}", StringType()) for k in range(len(names))])
        rows = spark.read.schema(given).option("header", True).csv(paths)
        columns = [F.col(f"_c{own[c]}").alias(c) for c in LEADS_CSV.names]
        groups.append(rows.select(*columns, *(file_position() if located else [])))
    if not groups:
        return empty_frame(spark, StructType([*LEADS_CSV.fields, *(LOCATED if located else [])]))
    return reduce(DataFrame.union, groups)


LOCATED = [StructField("_file", StringType()), StructField("_block", LongType())]


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line to files. Reads each file's first split only; what comes to the driver is as much as a listing of the files."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("value"), *file_position())
    first = lines.filter("_block = 0").select("_file", "value", F.monotonically_increasing_id().alias("at"))
    found: dict[str, list[str]] = {}
    for r in first.groupBy("_file").agg(F.min_by("value", "at").alias("header")).orderBy("_file").collect():
        found.setdefault(r.header.removeprefix("\ufeff"), []).append(r["_file"])
    return found


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_LINES).option("recursiveFileLookup", True).text(path)


def _utc_wall_clock(instant: Column) -> Column:
    # Counted from the epoch, so the session's zone and its clock changes play no part.
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.unix_seconds(instant))


def _log_instant(text: Column) -> Column:
    # The offset may be written +0200 or +02:00 or Z.
    written = [F.try_to_timestamp(text, F.lit(form)) for form in fixed.LOG_TIMES]
    return F.coalesce(*written)


def parse_weblogs(lines: DataFrame) -> DataFrame:
    """Adds address, account, time (UTC) and user agent of each `raw_line`. A line of another form stays, with NULL fields.

    The pattern runs once per line: it rewrites the line to its four fields, one per line of text, which no field can contain.
    """
    line = F.col("raw_line")
    fields = F.regexp_replace(line, fixed.LOG_LINE, "$1\n$2\n$3\n$8")
    part = F.when(fields != line, F.split(fields, "\n"))

    def absent(value: Column) -> Column:
        return F.nullif(value, F.lit("-"))

    return (
        lines.withColumn("_part", part)
        .select(
            *lines.columns,
            F.get("_part", F.lit(0)).alias("client_ip"),
            absent(F.get("_part", F.lit(1))).alias("username"),
            _utc_wall_clock(_log_instant(F.get("_part", F.lit(2)))).alias("request_time"),
            absent(F.get("_part", F.lit(3))).alias("user_agent"),
        )
    )


def write_full(df: DataFrame, path: str, partition_by: str | None = None, counts: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Replace whatever is at `path`. Returns the aggregates `counts` of the rows, from the write itself."""

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)

    return counted(df, counts or {}, write)


def append_quarantine(df: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch's rejects. Repeating a batch replaces its own rows only, so a restarted load leaves no doubles, nor, if it has no
    rejects this time, the old ones."""
    write_full(df.filter(F.col("batch_id") == batch_id).drop("batch_id"), f"{path}/batch_id={batch_id}")


def read_quarantine(spark: SparkSession, path: str, parsed: bool = False) -> DataFrame:
    """Quarantine records. parsed: with `record`, the rejected row as a variant, NULL where the text is no JSON; the text stays either way."""
    records = spark.read.schema(QUARANTINE).parquet(path).select(*QUARANTINE.names)
    return records.withColumn("record", F.try_parse_json("raw_record")) if parsed else records


def table_schema(spark: SparkSession, path: str) -> StructType:
    """A table's schema from one file footer; no rows are read."""
    return spark.read.parquet(path).schema
