"""Scoring of message streams with the fitted preparation and model.

Source, decoding, preparation, model and output shape are one streaming query.
The batch job and the stream use the same functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.clean import lookup
from plumbline.operators.evaluate import format_probability, risk_summary
from plumbline.operators.model import score
from plumbline.sources.messages import message_writer, run_to_files
from plumbline.spec import CHURN_FIELDS, CHURN_REQUIRED
from plumbline.streaming.decode import decode_records


def shape_scored(
    scored: DataFrame, key: str, original: Column, labels: Sequence[str], batch_id: Column
) -> DataFrame:
    """Rows as ``customer_id, original_data, prediction, processed_at, batch_id``.

    A row that the model cannot score has the prediction ``Unknown`` and no
    probability.
    """
    names = {float(i): v for i, v in enumerate(labels)}
    return scored.select(
        F.col(f"`{key}`").cast("string").alias("customer_id"),
        original.alias("original_data"),
        F.struct(
            lookup(F.col("prediction"), names, "Unknown").alias("prediction"),
            format_probability(F.col("confidence")).alias("probability"),
        ).alias("prediction"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
        batch_id.cast("string").alias("batch_id"),
    )


def score_records(
    records: DataFrame,
    model: PipelineModel,
    key: str,
    labels: Sequence[str],
    fields: Sequence[str],
    batch_id: Column | None = None,
) -> DataFrame:
    """Score typed records, one output row each; the input fields travel along as ``original_data``."""
    scored = score(model, with_original(records, fields))
    return shape_scored(scored, key, F.col("_original"), labels, batch_id if batch_id is not None else F.lit(None))


def with_original(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    return records.withColumn("_original", F.struct(*[F.col(f"`{f}`") for f in fields]))


def score_ok_messages(
    messages: DataFrame,
    model: PipelineModel,
    fields: Mapping[str, tuple[str, object]] = CHURN_FIELDS,
    required: Sequence[str] = CHURN_REQUIRED,
    value: str = "value",
) -> DataFrame:
    """Scores and ``_original`` of the messages that decode, before they are shaped."""
    records = decode_records(messages, fields, required, value).filter(F.col("status") == "ok")
    return score(model, with_original(records, list(fields)))


def score_messages(
    messages: DataFrame,
    model: PipelineModel,
    key: str = "customerID",
    labels: Sequence[str] = ("No", "Yes"),
    fields: Mapping[str, tuple[str, object]] = CHURN_FIELDS,
    required: Sequence[str] = CHURN_REQUIRED,
    value: str = "value",
) -> DataFrame:
    """Messages to scored records; messages that cannot be scored are left to
    :func:`rejected_messages`."""
    records = decode_records(messages, fields, required, value).filter(F.col("status") == "ok")
    return score_records(records, model, key, labels, list(fields))


def rejected_messages(
    messages: DataFrame,
    fields: Mapping[str, tuple[str, object]] = CHURN_FIELDS,
    required: Sequence[str] = CHURN_REQUIRED,
    value: str = "value",
) -> DataFrame:
    """Messages that cannot be scored, with the reason."""
    marked = decode_records(messages, fields, required, value, keep=[value])
    return marked.filter(F.col("status") != "ok").select(value, "status")


def encode_scored(scored: DataFrame) -> DataFrame:
    """Scored records as keyed JSON messages for a topic or text sink."""
    return scored.select(
        F.col("customer_id").alias("key"), F.to_json(F.struct(*scored.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def run_scoring(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Score what has arrived since the last run and stop."""
    return run_to_files(scored, path, checkpoint)


def run_batches(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    summary_path: str | None = None,
    continuous: bool = False,
    key: str = "customerID",
    labels: Sequence[str] = ("No", "Yes"),
) -> StreamingQuery:
    """Write each micro-batch as its own folder ``batch_id=..``, overwriting on retry,
    and optionally its risk summary.

    ``scored`` comes from :func:`score_ok_messages`. A batch is shaped with its
    own id; the summary is taken from the same rows before they are shaped. A
    batch that is tried again after a failure replaces its own folder, so the
    output has no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        shaped = shape_scored(rows, key, F.col("_original"), labels, F.lit(batch_id))
        shaped.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if summary_path:
            summary = risk_summary(rows, "prediction", "positive_probability")
            summary.write.mode("overwrite").parquet(f"{summary_path}/batch_id={batch_id}")
        rows.unpersist()

    query = message_writer(scored, checkpoint, continuous).foreachBatch(write).start()
    if not continuous:
        query.awaitTermination()
    return query
