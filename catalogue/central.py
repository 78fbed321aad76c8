"""The whole path: raw records, fitted preparation, trained model, scored records."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import catalogue, table
from catalogue.encoding import RAW, RAW_SPEC, SQL_TRAIN, raw_records
from plumbline.operators import model
from plumbline.operators.clean import drop_columns, split_features_target
from plumbline.plans.prepare import Preparation, apply_preparation, fit_preparation
from plumbline.plans.train import scoring_model, train_and_evaluate
from plumbline.sources.messages import encode_envelope, file_stream, write_messages
from plumbline.sources.scratch import materialize_once, new_path
from plumbline.streaming.runs import committed, run_sinks
from plumbline.streaming.scoring import rejected_messages, score_messages

FIELDS: dict[str, tuple[str, object]] = {
    "order_id": ("bigint", 0),
    "segment": ("string", "BUILDING"),
    "priority": ("string", "5-LOW"),
    "months": ("int", 0),
    "nation": ("int", 0),
    "spend": ("double", 0.0),
    "charge": ("double", 0.0),
}
REQUIRED = ("spend", "charge")


def tree():
    return model.decision_tree(maxDepth=4, minInstancesPerNode=5)


def trained(raw: DataFrame) -> tuple[Preparation, PipelineModel]:
    prep = fit_preparation(raw, RAW_SPEC)
    train = apply_preparation(raw, prep).filter("split = 'train'")
    fitted, _ = model.fit_directly(train, tree(), prep.feature_columns, RAW_SPEC.target, RAW_SPEC.key)
    return prep, scoring_model(prep, fitted)


@catalogue.add(SQL_TRAIN + """
SELECT count(*) FILTER (split = 'test') AS test_rows, true AS metrics_fit, true AS score_fits FROM kept
""")
def train_on_prepared(spark: SparkSession, folder: str) -> DataFrame:
    """Prepare, train on the training rows, evaluate on the test rows."""
    raw = raw_records(spark, folder)
    prep = fit_preparation(raw, RAW_SPEC)
    prepared = materialize_once(apply_preparation(raw, prep), "prepared")
    found = train_and_evaluate(prepared, prep.feature_columns, RAW_SPEC.target, RAW_SPEC.key, tree())
    rates = [F.col(c).between(0.0, 1.0) for c in ("accuracy", "precision", "recall", "f1")]
    return found.metrics.select(
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("test_rows"),
        (rates[0] & rates[1] & rates[2] & rates[3]).alias("metrics_fit"),
        F.lit(0.5 <= found.score <= 1.0).alias("score_fits"),
    )


@catalogue.add(SQL_TRAIN + """
SELECT CAST(done = 'Yes' AS DOUBLE) AS done, count(*) AS n FROM kept GROUP BY 1
""")
def features_and_target(spark: SparkSession, folder: str) -> DataFrame:
    """The prepared table without its key, cut into features and target."""
    raw = raw_records(spark, folder)
    prepared = drop_columns(apply_preparation(raw, fit_preparation(raw, RAW_SPEC)), RAW_SPEC.key, "split")
    _, target = split_features_target(prepared, RAW_SPEC.target)
    return target.groupBy(RAW_SPEC.target).agg(F.count("*").alias("n"))


STATUS = RAW + """
SELECT CAST(order_id AS VARCHAR) AS order_id, CASE WHEN charge IS NULL THEN 'invalid' ELSE 'scored' END AS status FROM raw
"""


def raw_messages(raw: DataFrame) -> DataFrame:
    """Raw records as messages; some have an explicit null, some a blank instead of a number."""
    return encode_envelope(drop_columns(raw, RAW_SPEC.target), RAW_SPEC.key)


def rejected(messages: DataFrame) -> DataFrame:
    key = F.get_json_object("value", "$.data.order_id")
    return rejected_messages(messages, FIELDS, REQUIRED).select(key.alias("order_id"), "status")


def status_of(scored: DataFrame) -> DataFrame:
    """Every scored record with a prediction and a percentage, under its key."""
    fits = F.col("prediction.prediction").isin("No", "Yes") & F.col("prediction.probability").endswith("%")
    return scored.select(F.col("customer_id").alias("order_id"), F.when(fits, "scored").otherwise("unscored").alias("status"))


@catalogue.add(STATUS)
def score_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages in one batch: every one comes out, scored or rejected."""
    raw = raw_records(spark, folder)
    prep, whole = trained(raw)
    messages = raw_messages(raw)
    scored = score_messages(messages, whole, RAW_SPEC.key, prep.labels, FIELDS, REQUIRED)
    return status_of(scored).unionByName(rejected(messages))


@catalogue.add(STATUS)
def stream_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages as a stream that reads its inbox once: scored and rejected rows from one decode of every micro-batch."""
    raw = raw_records(spark, folder)
    prep, whole = trained(raw)
    inbox, scored, kept_aside, commits = (new_path(spark, f"raw-{n}") for n in ("inbox", "scored", "rejected", "commits"))
    write_messages(raw_messages(raw), inbox)
    source = file_stream(spark, inbox, "key string, value string")
    run_sinks(source, whole, scored, kept_aside, commits, new_path(spark, "raw-position"), RAW_SPEC.key, prep.labels, FIELDS, REQUIRED)
    aside = committed(spark, kept_aside, commits).select(F.get_json_object("value", "$.data.order_id").alias("order_id"), "status")
    return status_of(committed(spark, scored, commits)).unionByName(aside)


@catalogue.add("""
SELECT o_orderkey, true AS by_tree, o_orderpriority <> '5-LOW' AS by_logistic FROM orders
""")
def score_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a missing feature come back from every model, with a prediction where the model can give one."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 100000).alias("price"),
        F.month("o_orderdate").cast("double").alias("month"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
    )
    rows = materialize_once(orders, "gappy-orders")
    names = ["price", "month"]
    by_tree, _ = model.fit_directly(rows, tree(), names, "label", "o_orderkey")
    logistic = model.logistic_regression(C=1.0, maxIter=5)
    by_logistic, _ = model.fit_directly(rows, logistic, names, "label", "o_orderkey")
    one = model.score(by_tree, rows).select("o_orderkey", F.col("prediction").isNotNull().alias("by_tree"))
    two = model.score(by_logistic, rows).select("o_orderkey", F.col("prediction").isNotNull().alias("by_logistic"))
    return one.join(two, "o_orderkey")
