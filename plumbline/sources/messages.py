"""Message streams and keyed JSON messages.

A message table has the columns of a broker topic: ``key, value, topic,
partition, offset, timestamp``. The same functions read a topic or a folder of
files and write to either.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

POLL_SECONDS = 3
BATCH_MESSAGES = 1_000


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_messages: int = BATCH_MESSAGES,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """Subscribe to a topic; ``max_messages`` bounds each micro-batch.

    Needs the connector package on the cluster's class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", max_messages)
        .load()
        .select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "parquet",
    max_files: int | None = None,
    **options: Any,
) -> DataFrame:
    """Stream the files of a folder; ``max_files`` bounds each micro-batch."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Origin of each row of a file source: file name and modification time."""
    return df.withColumns({
        "_file": F.col("_metadata.file_name"),
        "_file_time": F.col("_metadata.file_modification_time"),
    })


def encode_envelope(df: DataFrame, key: str, *columns: str, timestamp: str | None = None) -> DataFrame:
    """Rows as keyed messages ``{"timestamp": .., "data": {..}}``.

    The timestamp is the named column, or the current time in ISO form. A null
    field is written as null: a reader must be able to tell it from an absent one.
    """
    fields = [F.col(c) for c in (columns or df.columns)]
    time = (
        F.col(timestamp).cast("string")
        if timestamp
        else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    body = F.struct(time.alias("timestamp"), F.struct(*fields).alias("data"))
    return df.select(F.col(f"`{key}`").cast("string").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_messages(df: DataFrame, target: str, format: str = "parquet", **options: Any) -> None:
    """Write keyed messages in one batch; with format ``kafka`` the target is the topic."""
    writer = df.write.format(format).options(**options)
    if format == "kafka":
        writer.option("topic", target).save()
    else:
        writer.mode("append").save(target)


def message_writer(
    df: DataFrame, checkpoint: str, continuous: bool = False, poll_seconds: int = POLL_SECONDS
) -> DataStreamWriter:
    """Append writer: drain what is there and stop, or poll for ever."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=f"{poll_seconds} seconds")
    return writer.trigger(availableNow=True)


def run_to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    partition_by: tuple[str, ...] = (),
    options: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Drain the stream into files, each row exactly once, and wait for the end.

    The checkpoint holds the position: the same call later continues after the
    last committed file or offset.
    """
    writer = message_writer(df, checkpoint).format(format).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(path)
    query.awaitTermination()
    return query
