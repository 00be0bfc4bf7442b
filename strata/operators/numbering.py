"""Consecutive numbers without a single-task sort.

A global `row_number` puts every row into one task. Here rows are range-partitioned (or already lie in file order), each row gets its
position inside its partition, the rows are written once to the shared folder so that the positions cannot change, and only the
per-partition counts (one row per partition) are summed up into offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import broadcast_if_small, materialize

# monotonically_increasing_id keeps the partition number above this bit and the position in the partition below it.
_POSITION_BITS = 33


def _rows_before(count: str, *order: str, within: str | None = None) -> Column:
    window = Window.partitionBy(within).orderBy(*order) if within else Window.orderBy(*order)
    earlier = F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(earlier, F.lit(0))


def number_rows(df: DataFrame, order_by: list[Column], name: str, after: int = 0) -> DataFrame:
    """Adds `name` = after + 1, after + 2, ... in the order of `order_by`, which should be a total order for repeatable numbers."""
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    held = materialize(ordered.withColumn("_position", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_position", _POSITION_BITS)
    index = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    # One row per shuffle partition: a bound set by the partition count, not by the data.
    sizes = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    offsets = sizes.select("_part", _rows_before("_rows", "_part").alias("_offset"))
    return (
        held.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + index + F.lit(after + 1)).alias(name))
    )


def file_position() -> list[Column]:
    """File and start of the split of each row: hidden columns of a frame that reads files, to be selected before it is transformed."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]


def with_line_numbers(df: DataFrame, file_col: str = "source_file", line_col: str = "source_line_number") -> DataFrame:
    """Adds the file of each row and its 1-based number inside that file. `df` reads text or CSV files (for CSV: record number, header
    not counted), or already has the columns of `file_position`, without a shuffle in between. Big files are many splits; a split's rows stay
    contiguous, so counts per split give each split's first number.

    Only a row a split is written, not the rows: a scan deals the files it has listed to its partitions in the same way each time, so a row's
    position is the same when the files are read again, on whatever executor."""
    located = df if "_block" in df.columns else df.select(*df.columns, *file_position())
    columns = [c for c in located.columns if c not in ("_file", "_block")]
    landed = located.withColumn("_position", F.monotonically_increasing_id())
    splits = materialize(landed.groupBy("_file", "_block").agg(F.min("_position").alias("_first"), F.count("*").alias("_rows")), "splits")
    # A window over the splits of one file, not over its lines.
    shift = _rows_before("_rows", "_block", within="_file") - F.col("_first") + 1
    starts = broadcast_if_small(splits.select("_file", "_block", shift.alias("_shift")))
    return landed.join(starts, ["_file", "_block"]).select(
        *columns, F.col("_file").alias(file_col), (F.col("_position") + F.col("_shift")).alias(line_col)
    )
