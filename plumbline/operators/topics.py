"""Reports on message tables: counts, lag, replay, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROGRESS_BLOCK = 10_000


def message_counts(messages: DataFrame) -> DataFrame:
    """Messages and offset range per topic and partition."""
    return messages.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def consumer_lag(messages: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages behind per group and partition.

    ``committed`` has ``group_id, topic, partition, current_offset`` (the next
    offset to read). The end of a partition is its last offset plus one; a group
    without commits is behind from the start. A row with partition -1 per group
    and topic holds the total.
    """
    ends = messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("log_end_offset"))
    groups = committed.select("group_id", "topic").distinct()
    # both sides hold one row per group or partition, not per message
    lag = (
        groups.join(ends, "topic")
        .join(committed, ["group_id", "topic", "partition"], "left")
        .select(
            "group_id",
            "topic",
            F.col("partition").cast("int").alias("partition"),
            F.coalesce("current_offset", F.lit(0)).cast("bigint").alias("current_offset"),
            F.col("log_end_offset").cast("bigint").alias("log_end_offset"),
        )
        .withColumn("lag", F.greatest(F.col("log_end_offset") - F.col("current_offset"), F.lit(0)).cast("bigint"))
    )
    total = lag.groupBy("group_id", "topic").agg(
        F.lit(-1).alias("partition"),
        F.sum("current_offset").alias("current_offset"),
        F.sum("log_end_offset").alias("log_end_offset"),
        F.sum("lag").alias("lag"),
    )
    return lag.unionByName(total)


def replay_range(messages: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Messages with ``start <= offset < end`` in every partition, for reprocessing."""
    out = messages
    if start is not None:
        out = out.filter(F.col("offset") >= start)
    if end is not None:
        out = out.filter(F.col("offset") < end)
    return out


def batch_progress(scored: DataFrame, batch: str = "batch_id", ok: str = "ok") -> DataFrame:
    """Total, processed and failed rows per batch number, with the running number processed.

    Batches are summed in blocks of PROGRESS_BLOCK first: a window covers one
    block, or one row for each block.
    """
    per_batch = scored.groupBy(batch).agg(
        F.count("*").alias("total"),
        F.count_if(F.col(ok)).alias("processed"),
        F.count_if(~F.col(ok)).alias("failed"),
    )
    blocked = per_batch.withColumn("_block", F.floor(F.col(batch) / PROGRESS_BLOCK))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy("_block").agg(F.sum("processed").alias("_sum"))
    before = blocks.select("_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    running = Window.partitionBy("_block").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(before, "_block")
        .withColumn("running_processed", F.col("_before") + F.sum("processed").over(running))
        .drop("_block", "_before")
    )
