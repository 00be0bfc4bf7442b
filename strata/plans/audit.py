"""Load history as append-only events; the current state is a query over all loads and batches at once.

`seq` orders events. All states are aggregates (largest `seq` wins), so one load with most of the events is reduced before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import fixed


def job_runs(job_events: DataFrame) -> DataFrame:
    """One row per job run: latest status, first start, end of the latest closing event, and the error text if it failed."""
    closing = F.when(F.col("status") != fixed.RUNNING, F.col("seq"))
    return job_events.groupBy("job_run_id").agg(
        F.max_by("batch_id", "seq").alias("batch_id"),
        F.max_by("job_name", "seq").alias("job_name"),
        F.max_by("status", "seq").alias("status"),
        F.min(F.when(F.col("status") == fixed.RUNNING, F.col("event_time"))).alias("started_at"),
        F.max_by("event_time", closing).alias("finished_at"),
        F.max_by("error_message", "seq").alias("error_message"),
    )


def layer_state(layer_events: DataFrame) -> DataFrame:
    """Current state per load and layer. Every load has all three layers, PENDING in batch 0 until their first event; an event without
    a watermark leaves the old one standing."""
    layers = F.array(*[F.lit(name) for name in fixed.LAYERS])
    seeds = layer_events.select("pipeline_name").distinct().select(
        F.lit(-1).cast("bigint").alias("seq"),
        "pipeline_name",
        F.explode(layers).alias("layer_name"),
        F.lit(None).cast("timestamp_ntz").alias("last_watermark"),
        F.lit(0).cast("bigint").alias("batch_id"),
        F.lit(fixed.PENDING).alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("event_time"),
    )
    watermarked = F.when(F.col("last_watermark").isNotNull(), F.col("seq"))
    return layer_events.unionByName(seeds).groupBy("pipeline_name", "layer_name").agg(
        F.max_by("last_watermark", watermarked).alias("last_watermark"),
        F.max_by("batch_id", "seq").alias("last_batch_id"),
        F.max_by("status", "seq").alias("status"),
        F.max_by("event_time", "seq").alias("updated_at"),
    )


def batch_status(batch_events: DataFrame) -> DataFrame:
    """One row per batch. A restart clears end and error; the error of a failure is cut to what the table holds."""
    closed = F.col("last.status") != fixed.RUNNING
    return (
        batch_events.groupBy("batch_id")
        .agg(
            F.max_by(F.struct("pipeline_name", "status", "event_time", "error_message"), "seq").alias("last"),
            F.min("event_time").alias("started_at"),
        )
        .select(
            "batch_id",
            "last.pipeline_name",
            "last.status",
            "started_at",
            F.when(closed, F.col("last.event_time")).alias("finished_at"),
            F.when(
                F.col("last.status") == fixed.FAILED, F.substring("last.error_message", 1, fixed.ERROR_LENGTH)
            ).alias("error_message"),
        )
    )


def resume_point(batches: DataFrame, layers: DataFrame) -> DataFrame:
    """Where each load goes on. Only a latest batch that FAILED is taken up again, after its last finished layer; if all its layers are
    finished, or in any other case, a new batch starts from bronze (`restart_batch_id` NULL)."""
    latest = batches.groupBy("pipeline_name").agg(
        F.max("batch_id").alias("last_batch_id"), F.max_by("status", "batch_id").alias("batch_status")
    )
    done = [F.max((F.col("layer_name") == name) & (F.col("status") == fixed.SUCCESS)) for name in fixed.LAYERS]
    bronze, silver, gold = (F.coalesce(F.col(c), F.lit(False)) for c in ("bronze_done", "silver_done", "gold_done"))
    finished = layers.groupBy("pipeline_name", "last_batch_id").agg(
        done[0].alias("bronze_done"), done[1].alias("silver_done"), done[2].alias("gold_done")
    )
    resumable = (F.col("batch_status") == fixed.FAILED) & ~gold
    return latest.join(finished, ["pipeline_name", "last_batch_id"], "left").select(
        "pipeline_name",
        "last_batch_id",
        F.when(resumable, F.col("last_batch_id")).alias("restart_batch_id"),
        F.when(resumable & silver, "gold").when(resumable & bronze, "silver").otherwise("bronze").alias("resume_from_layer"),
    )
