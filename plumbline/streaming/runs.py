"""Runs of message streams: scored and rejected rows from one decode, bounded runs, start positions, progress.

Every micro-batch writes its rows under its own number and then a commit record.
A batch that is tried again after a crash replaces what it had written, and
readers see the batches that have a record, so both sinks show the same batches.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from plumbline.operators.model import score
from plumbline.sources.messages import file_stream, message_writer
from plumbline.spec import CHURN_FIELDS, CHURN_REQUIRED
from plumbline.streaming.decode import decode_records
from plumbline.streaming.scoring import shape_scored, with_original

COMMITS = "batch_id bigint, total bigint, scored bigint, rejected bigint"
PROGRESS = "run_id string, batch_id bigint, input_rows bigint, seconds double"


@dataclass
class Bounds:
    """A run ends between micro-batches once it has seen so many messages or taken so many seconds."""

    messages: int | None = None
    seconds: float | None = None
    seen: int = 0
    reached: bool = False
    began: float = field(default_factory=time.monotonic)

    def check(self) -> None:
        late = self.seconds is not None and time.monotonic() - self.began >= self.seconds
        self.reached = self.reached or late or (self.messages is not None and self.seen >= self.messages)


class BoundsReached(Exception):
    """Raised at the start of the batch after the last one, which therefore is not committed and comes again."""


def sink(rows: DataFrame, path: str, batch_id: int) -> int:
    """Writes one batch of a sink, replacing an earlier attempt; the number of rows comes from the write itself."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return int(seen.get["n"])


def run_batches_within(stream: DataFrame, write: Callable[[DataFrame, int], int], checkpoint: str, bounds: Bounds | None = None, continuous: bool = False) -> Bounds:
    """Runs ``write(batch, batch_id) -> rows`` on every micro-batch until the stream is drained or the bounds are reached.

    A drained stream ends the run unless it is ``continuous``; then only the bounds do.
    """
    limits = bounds or Bounds()
    if continuous and limits.messages is None and limits.seconds is None:
        raise ValueError("a continuous run needs bounds")

    def each(batch: DataFrame, batch_id: int) -> None:
        limits.check()
        if limits.reached:
            raise BoundsReached
        limits.seen += write(batch, batch_id)
        limits.check()

    query = message_writer(stream, checkpoint, continuous, poll_seconds=1).foreachBatch(each).start()
    try:
        while not query.awaitTermination(0.2):
            limits.check()
            if limits.reached and not query.status["isTriggerActive"]:
                break
    except StreamingQueryException:
        if not limits.reached:
            raise
    finally:
        query.stop()
    return limits


def run_sinks(
    messages: DataFrame, model: PipelineModel, scored_path: str, rejected_path: str, commits_path: str, checkpoint: str,
    key: str = "customerID", labels: Sequence[str] = ("No", "Yes"), fields: Mapping[str, tuple[str, object]] = CHURN_FIELDS,
    required: Sequence[str] = CHURN_REQUIRED, value: str = "value", bounds: Bounds | None = None, continuous: bool = False,
) -> Bounds:
    """Scores what decodes and keeps aside what does not, from one decode of every micro-batch.

    A batch writes its scored rows, its rejected rows (``value, status``) and last
    its commit record with the counts. Read the sinks with :func:`committed`.
    """
    decoded = decode_records(messages, fields, required, value, keep=[value])

    def write(batch: DataFrame, batch_id: int) -> int:
        rows = batch.persist()
        try:
            usable = with_original(rows.filter("status = 'ok'").drop(value), list(fields))
            shaped = shape_scored(score(model, usable), key, F.col("_original"), labels, F.lit(batch_id)).drop("batch_id")
            scored = sink(shaped, scored_path, batch_id)
            rejected = sink(rows.filter("status <> 'ok'").select(value, "status"), rejected_path, batch_id)
            record = [(batch_id, scored + rejected, scored, rejected)]
            one = batch.sparkSession.createDataFrame(record, COMMITS).drop("batch_id").coalesce(1)
            one.write.mode("overwrite").parquet(f"{commits_path}/batch_id={batch_id}")
            return scored + rejected
        finally:
            rows.unpersist()

    return run_batches_within(decoded, write, checkpoint, bounds, continuous)


def committed(spark: SparkSession, path: str, commits_path: str) -> DataFrame:
    """Rows of a sink of the batches that are committed, with ``batch_id``."""
    return spark.read.parquet(path).join(batch_records(spark, commits_path).select("batch_id"), "batch_id", "left_semi")


def batch_records(spark: SparkSession, commits_path: str) -> DataFrame:
    """Messages in total, scored and rejected per committed batch, over all runs of the stream."""
    return spark.read.schema(COMMITS).parquet(commits_path)


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of every micro-batch of the watched queries as a table ``run_id, batch_id, input_rows, seconds``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return  # a poll that found nothing
        row = [(str(p.runId), p.batchId, p.numInputRows, p.batchDuration / 1000)]
        table = self.spark.createDataFrame(row, PROGRESS).drop("run_id", "batch_id").coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/run_id={p.runId}/batch_id={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def position_of(spark: SparkSession, path: str, start: str, position_path: str, glob: str = "*") -> str:
    """The instant from which files of a folder are read, fixed by the first run and kept at ``position_path``.

    ``start`` is ``earliest``, ``latest`` (files that are newer than all that are
    there now) or a timestamp (UTC).
    """
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{position_path}/_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        if start == "earliest":
            instant = F.lit("1970-01-01 00:00:00").cast("timestamp")
        elif start == "latest":
            # everything that is there now lies before the millisecond after the newest file
            instant = F.expr("coalesce(max(modificationTime), timestamp '1970-01-01 00:00:00') + interval 1 millisecond")
        else:
            instant = F.lit(start).cast("timestamp")
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("modificationTime")
        one = files.agg(instant.alias("instant")) if start == "latest" else spark.range(1).select(instant.alias("instant"))
        one.select(F.col("instant").cast("string").alias("instant")).coalesce(1).write.mode("overwrite").parquet(position_path)
    return spark.read.schema("instant string").parquet(position_path).first()[0]


def file_stream_from(spark: SparkSession, path: str, schema: T.StructType | str, position_path: str, start: str = "earliest", **options) -> DataFrame:
    """A folder as a stream from a start position that later runs keep."""
    instant = position_of(spark, path, start, position_path, options.get("pathGlobFilter", "*"))
    return file_stream(spark, path, schema, **options).where(F.col("_metadata.file_modification_time") >= F.lit(instant).cast("timestamp"))


def replay_stream(spark: SparkSession, path: str, schema: T.StructType | str, first: int | None = None, last: int | None = None, offset: str = "offset", **options) -> DataFrame:
    """Messages with ``first <= offset < last`` of a folder as a stream of its own; its position is that of its checkpoint."""
    out = file_stream(spark, path, schema, **options)
    if first is not None:
        out = out.where(F.col(offset) >= first)
    return out.where(F.col(offset) < last) if last is not None else out


def drain(stream: DataFrame, path: str, checkpoint: str, bounds: Bounds | None = None, continuous: bool = False) -> Bounds:
    """Writes the stream to ``path`` by micro-batches, each replacing an earlier attempt of its own."""
    return run_batches_within(stream, lambda batch, batch_id: sink(batch, path, batch_id), checkpoint, bounds, continuous)

