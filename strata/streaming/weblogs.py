"""Access logs as a file stream: each run loads the lines not loaded before."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import merged
from strata.operators.numbering import file_position, number_rows, with_line_numbers
from strata.operators.spans import narrowed
from strata.schemas import LOG_FILES, LOG_LINES, WEBLOG_ROWS
from strata.session import broadcast_if_small, materialize
from strata.sources.files import parse_weblogs
from strata.sources.tables import Origin, mark_done, newest, publish, read_or_create, read_table, taken_in

LINE_KEY = ["source_file", "source_line_number"]


def insert_absent_actions(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Parsed lines whose file and line number the target lacks, added; the rest is left alone."""
    return merged(target, rows.select(*target.columns), LINE_KEY, [])


def insert_counts(target: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: lines inserted, and lines skipped because they are there already."""
    known = target.select(*LINE_KEY, F.lit(True).alias("_known"))
    found = rows.select(*LINE_KEY).join(known, LINE_KEY, "left")
    return found.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"), F.count_if(F.col("_known").isNotNull()).alias("skipped")
    )


def load_lines(spark: SparkSession, lines: DataFrame, target: str, now: datetime, origin: Origin | None = None) -> dict[str, int]:
    """Number, parse and add `lines` (read from whole text files) to the table at `target`. Only new rows are written.

    New lines get the next `log_id`s in order of file and line, so the table serves as the weblogs source of a load. origin: the batch of
    a stream, which is committed with the rows; one that the table holds already is left alone, without reading lines or history.
    """
    if origin and taken_in(spark, target, origin):
        return {"inserted": 0, "skipped": 0}
    rows = parse_weblogs(with_line_numbers(lines))
    # Only lines of the same files can be known already; the history is cut to them, in its scan as far as their names tell, before it is joined.
    files = materialize(rows.select("source_file").distinct(), "files")
    near = narrowed(read_table(spark, target, WEBLOG_ROWS), files, "source_file")
    held = near.join(broadcast_if_small(files), "source_file", "left_semi").select(*[c for c in WEBLOG_ROWS.names if c != "log_id"])
    # Ids go on from version to version, so the last one is among the rows added last.
    last = newest(spark, target, WEBLOG_ROWS).agg(F.max("log_id")).first()[0] or 0
    absent = insert_absent_actions(held, rows).filter(F.col("_action") == "insert").drop("_action")
    added = number_rows(absent, [F.col(c) for c in LINE_KEY], "log_id", after=last)  # writes them once, and only them
    inserted = added.count()
    if inserted:
        publish(spark, target, added.select(*WEBLOG_ROWS.names), now, replaces=[], origin=origin, key=LINE_KEY)
    elif origin:
        mark_done(spark, target, now, origin)
    return {"inserted": inserted, "skipped": rows.count() - inserted}


def _file_states() -> list[Column]:
    """File, length and change time of each row's file, as the reader saw them: hidden columns of a frame that reads files."""
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
    ]


def _remember(states: DataFrame, target: str) -> None:
    states.select(*LOG_FILES.names).distinct().write.mode("append").parquet(f"{target}/_log_files")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def changed_files(spark: SparkSession, source_dir: str, target: str) -> list[str]:
    """Files of `source_dir` that are not in the state in which they were loaded. Lists them, reads none."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source_dir).select(*_file_states())
    known = read_or_create(spark, f"{target}/_log_files", LOG_FILES)
    return [r.file for r in listed.join(known, LOG_FILES.names, "left_anti").select("file").distinct().collect()]


def stream_weblogs(
    spark: SparkSession, source_dir: str, target: str, checkpoint: str, now: datetime, batch_bytes: int = 1 << 40
) -> None:
    """Load all lines that came to `source_dir` since the last run, then stop.

    New files come as a stream, a long backlog in batches of about `batch_bytes`, however old a file's modification time is: the
    stream forgets no file, and none is too old for it. Files that were loaded and have grown since are read again after it; their
    known lines are skipped, as in any repeated batch. A file that is still being written is therefore completed by a later run.

    A batch that comes again after a crash is known by its number and the id that the checkpoint gives the stream, so that another
    checkpoint, or one made anew, never passes for it.
    """
    reader = spark.readStream.schema(LOG_LINES).option("recursiveFileLookup", True).option("maxBytesPerTrigger", batch_bytes)
    reader = reader.option("maxFileAge", f"{100 * 365}d")
    files = reader.text(source_dir).select("raw_line", *file_position(), *_file_states())

    def add(batch: DataFrame, number: int) -> None:
        # A batch keeps the listing it was planned with, so states and lines belong together however often it is read.
        states = materialize(batch.select(*LOG_FILES.names).distinct(), "states")
        load_lines(batch.sparkSession, batch.drop(*LOG_FILES.names), target, now, Origin(stream_id(batch.sparkSession, checkpoint), number))
        _remember(states, target)

    query = files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    grown = changed_files(spark, source_dir, target)
    if grown:
        lines = spark.read.schema(LOG_LINES).text(grown).select("raw_line", *file_position(), *_file_states())
        states = materialize(lines.select(*LOG_FILES.names).distinct(), "states")
        load_lines(spark, lines.drop(*LOG_FILES.names), target, now)
        _remember(states, target)
