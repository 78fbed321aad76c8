"""Message tables and streams built from the events and documents tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import catalogue, table
from catalogue.modelling import document_features, feature_names
from plumbline.operators import model, topics
from plumbline.sources.messages import encode_envelope, file_stream, run_to_files, with_file_metadata, write_messages
from plumbline.sources.scratch import new_path
from plumbline.streaming import decode, runs
from plumbline.streaming.scoring import run_scoring, score_messages


@catalogue.add("SELECT event_id, user_id, event_type, value, 'events.parquet' AS _file FROM events")
def stream_source(spark: SparkSession, folder: str) -> DataFrame:
    """The events file as a stream, drained into a table."""
    schema = table(spark, folder, "events").schema
    events = file_stream(spark, folder, schema, max_files=1, pathGlobFilter="events.parquet")
    rows = with_file_metadata(events).select("event_id", "user_id", "event_type", "value", "_file")
    path = new_path(spark, "events-drained")
    run_to_files(rows, path, new_path(spark, "events-position"))
    return spark.read.schema(rows.schema).parquet(path)


@catalogue.add("""
SELECT CAST(event_id AS VARCHAR) AS key, CAST(json_object('timestamp', CAST(ts AS VARCHAR),
  'data', json_object('event_id', event_id, 'user_id', user_id, 'event_type', nullif(event_type, 'error'))) AS VARCHAR) AS value
FROM events
""")
def envelope_encode(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return encode_envelope(
        events, "event_id", "event_id", "user_id", "event_type", timestamp="ts"
    )


def message_text(spark: SparkSession, folder: str, forms: dict[str, str]) -> DataFrame:
    """Events as messages whose form depends on the event type; ``{}`` marks the props."""
    text = F.col("props")
    for kind, form in forms.items():
        before, _, after = form.partition("{}")
        wrapped = F.concat(F.lit(before), "props", F.lit(after)) if "{}" in form else F.lit(form)
        text = F.when(F.col("event_type") == kind, wrapped).otherwise(text)
    return table(spark, folder, "events").select("event_id", text.alias("value"))


ENVELOPE = '{"timestamp": "2024-01-01T00:00:00", "data": {}}'
K = {"k": ("bigint", -1)}


@catalogue.add("""
SELECT event_id, event_type <> 'error' AS decoded,
  CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events
""")
def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    decoded = decode.decode_json(message_text(spark, folder, {"error": "broken {}"}))
    m = F.col("message")
    return decoded.select(
        "event_id", m.isNotNull().alias("decoded"), F.try_variant_get(F.element_at(m, "k"), "$", "bigint").alias("k")
    )


@catalogue.add("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_unwrap(spark: SparkSession, folder: str) -> DataFrame:
    messages = message_text(spark, folder, {"view": ENVELOPE, "purchase": ENVELOPE})
    unwrapped = decode.unwrap_envelope(decode.decode_json(messages))
    payload = F.element_at(F.col("payload"), "k")
    return unwrapped.select("event_id", F.try_variant_get(payload, "$", "bigint").alias("k"))


@catalogue.add("""
SELECT event_id,
  CASE event_type WHEN 'click' THEN -1 WHEN 'purchase' THEN NULL WHEN 'error' THEN NULL
    ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE event_type WHEN 'purchase' THEN 'invalid' WHEN 'error' THEN 'malformed' ELSE 'ok' END AS status
FROM events
""")
def json_defaults(spark: SparkSession, folder: str) -> DataFrame:
    forms = {"view": ENVELOPE, "click": '{"other": 1}', "purchase": '{"data": {"k": null}}', "error": "[1"}
    return decode.decode_records(message_text(spark, folder, forms), K, ["k"], keep=["event_id"])


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the log of a topic with four partitions."""
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod("event_id", F.lit(4)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
        "event_type",
    )


LOG = """
WITH log AS (
  SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset", event_id, props, event_type
  FROM events
)
"""


@catalogue.add(LOG + """
SELECT topic, partition, count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset
FROM log GROUP BY 1, 2
""")
def message_counts(spark: SparkSession, folder: str) -> DataFrame:
    return topics.message_counts(event_log(spark, folder))


@catalogue.add(LOG + """, ends AS (
  SELECT topic, partition, max("offset") + 1 AS log_end_offset FROM log GROUP BY 1, 2
), committed AS (
  SELECT event_type AS group_id, topic, partition, max("offset") + 1 AS current_offset FROM log GROUP BY 1, 2, 3
), lag AS (
  SELECT g.group_id, ends.topic, ends.partition, CAST(coalesce(current_offset, 0) AS BIGINT) AS current_offset,
    CAST(log_end_offset AS BIGINT) AS log_end_offset,
    CAST(greatest(log_end_offset - coalesce(current_offset, 0), 0) AS BIGINT) AS lag
  FROM (SELECT DISTINCT group_id, topic FROM committed) g JOIN ends ON ends.topic = g.topic
  LEFT JOIN committed c ON c.group_id = g.group_id AND c.topic = ends.topic AND c.partition = ends.partition
)
SELECT group_id, topic, partition, current_offset, log_end_offset, lag FROM lag
UNION ALL
SELECT group_id, topic, -1, CAST(sum(current_offset) AS BIGINT), CAST(sum(log_end_offset) AS BIGINT), CAST(sum(lag) AS BIGINT)
FROM lag GROUP BY 1, 2
""")
def consumer_lag(spark: SparkSession, folder: str) -> DataFrame:
    """One group per event type, which has read up to its last event."""
    log = event_log(spark, folder)
    committed = log.groupBy(F.col("event_type").alias("group_id"), "topic", "partition").agg(
        (F.max("offset") + 1).alias("current_offset")
    )
    return topics.consumer_lag(log, committed)


@catalogue.add(LOG + """
SELECT CAST(event_id AS VARCHAR) AS key, partition, "offset" FROM log WHERE "offset" >= 100 AND "offset" < 2000
""")
def replay_range(spark: SparkSession, folder: str) -> DataFrame:
    return topics.replay_range(event_log(spark, folder), 100, 2000).select("key", "partition", "offset")


@catalogue.add("""
WITH b AS (
  SELECT CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS batch_id, count(*) AS total,
    count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'error') AS failed
  FROM events GROUP BY 1
)
SELECT *, CAST(sum(processed) OVER (ORDER BY batch_id) AS BIGINT) AS running_processed FROM b
""")
def batch_progress(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "events").select(
        F.date_format("ts", "yyyyMMddHH").cast("bigint").alias("batch_id"), (F.col("event_type") != "error").alias("ok")
    )
    return topics.batch_progress(scored)


@catalogue.add("SELECT CAST(doc_id AS VARCHAR) AS customer_id, true AS prediction_fits, true AS probability_fits FROM documents")
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as enveloped messages, scored by one streaming query."""
    rows = document_features(spark, folder)
    names = feature_names(rows)
    fitted = model.BalancedClassifier(
        classifier=model.decision_tree(maxDepth=8, minInstancesPerNode=5), features=names, label="label", key="doc_id"
    ).fit(rows.filter("split = 'train'"))
    inbox = new_path(spark, "inbox")
    write_messages(encode_envelope(rows, "doc_id", "doc_id", *names), inbox)
    fields = {"doc_id": ("bigint", 0), **{n: ("double", 0.0) for n in names}}
    messages = file_stream(spark, inbox, "key string, value string")
    scored = score_messages(messages, fitted, "doc_id", ["bad", "good"], fields, names)
    path = new_path(spark, "scored")
    run_scoring(scored, path, new_path(spark, "scored-position"))
    return spark.read.parquet(path).select(
        "customer_id",
        F.col("prediction.prediction").isin("bad", "good").alias("prediction_fits"),
        F.col("prediction.probability").endswith("%").alias("probability_fits"),
    )


def scoring_inbox(spark: SparkSession, folder: str):
    """A fitted model, its fields, and all documents as messages: some are no JSON, some lack a number."""
    rows = document_features(spark, folder)
    names = feature_names(rows)
    fitted = model.BalancedClassifier(
        classifier=model.decision_tree(maxDepth=4), features=names, label="label", key="doc_id", balance=False
    ).fit(rows.filter("split = 'train'"))
    kind = F.col("doc_id") % 10
    sent = rows.withColumn("chars", F.when(kind != 7, F.col("chars")))
    encoded = encode_envelope(sent, "doc_id", "doc_id", *names)
    broken = F.when(F.col("key").cast("bigint") % 10 == 3, F.concat(F.lit("oops "), "key")).otherwise(F.col("value"))
    fields = {"doc_id": ("bigint", 0), **{n: ("double", 0.0) for n in names}}
    return fitted, names, fields, encoded.withColumn("value", broken)


@catalogue.add("""
SELECT doc_id, CASE doc_id % 10 WHEN 3 THEN 'malformed' WHEN 7 THEN 'invalid' ELSE 'ok' END AS status,
  (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents WHERE doc_id % 10 IN (3, 7)) AS rejected
FROM documents
""")
def stream_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """Scored and rejected messages from one decode, in two runs of one stream; totals from its commit records."""
    fitted, names, fields, sent = scoring_inbox(spark, folder)
    inbox, scored, rejected, commits, position = (new_path(spark, n) for n in ("inbox", "scored", "rejected", "commits", "position"))
    for half in (0, 1):
        write_messages(sent.filter(F.col("key").cast("bigint") % 2 == half), inbox)
        messages = file_stream(spark, inbox, "key string, value string")
        runs.run_sinks(messages, fitted, scored, rejected, commits, position, "doc_id", ["bad", "good"], fields, names)
    ok = runs.committed(spark, scored, commits).where("prediction.prediction IN ('bad', 'good')")
    bad = runs.committed(spark, rejected, commits)
    envelope = F.when(F.col("status") == "malformed", F.split("value", " ")[1]).otherwise(F.get_json_object("value", "$.data.doc_id"))
    rows = ok.select(F.col("customer_id").cast("bigint").alias("doc_id"), F.lit("ok").alias("status")).unionByName(
        bad.select(envelope.cast("bigint").alias("doc_id"), "status")
    )
    sums = runs.batch_records(spark, commits).agg(F.sum("total").alias("total"), F.sum("rejected").alias("rejected")).first()
    return rows.select("doc_id", "status", F.lit(sums["total"]).alias("total"), F.lit(sums["rejected"]).alias("rejected"))


@catalogue.add("SELECT event_id, event_type, true AS stopped_early, true AS kept_position FROM events")
def stream_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Events in four files: a run that ends after the first messages, then one by the clock's trigger for the rest."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    inbox, path, position = (new_path(spark, n) for n in ("inbox", "drained", "position"))
    events.repartition(4, "event_id").write.parquet(inbox)
    stream = file_stream(spark, inbox, events.schema, max_files=1)
    total = events.count()
    first = runs.drain(stream, path, position, runs.Bounds(messages=1))
    rest = runs.drain(stream, path, position, runs.Bounds(messages=total - first.seen, seconds=120), continuous=True)
    early, kept = 0 < first.seen < total, first.seen + rest.seen == total
    return spark.read.parquet(path).select("event_id", "event_type", F.lit(early).alias("stopped_early"), F.lit(kept).alias("kept_position"))


@catalogue.add(LOG + """
SELECT CAST(event_id AS VARCHAR) AS key, partition, "offset" FROM log WHERE "offset" >= 100 AND "offset" < 2000
""")
def replay_by_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same range as ``replay_range``, from a stream with a position of its own."""
    log = event_log(spark, folder).select("key", "partition", "offset")
    inbox, path = new_path(spark, "log"), new_path(spark, "replayed")
    log.write.parquet(inbox)
    stream = runs.replay_stream(spark, inbox, log.schema, 100, 2000)
    runs.drain(stream, path, new_path(spark, "position"))
    return spark.read.parquet(path).drop("batch_id")


@catalogue.add("SELECT event_id, event_type FROM events WHERE event_id % 2 = 1")
def stream_from_latest(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that starts behind what is there: only later files are read, over two runs."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    inbox, path, start, position = (new_path(spark, n) for n in ("inbox", "drained", "start", "position"))
    events.filter("event_id % 2 = 0").write.parquet(inbox)
    for part in (None, "event_id % 4 = 1", "event_id % 4 = 3"):
        if part:
            time.sleep(0.05)  # file times have milliseconds
            events.filter(part).write.mode("append").parquet(inbox)
        stream = runs.file_stream_from(spark, inbox, events.schema, start, "latest", pathGlobFilter="*.parquet")
        runs.drain(stream, path, position)
    return spark.read.parquet(path).drop("batch_id")
