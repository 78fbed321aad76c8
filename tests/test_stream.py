from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import model
from plumbline.plans import prepare as plan
from plumbline.plans.train import scoring_model
from plumbline.sources import messages
from plumbline.spec import CHURN, CHURN_FIELDS
from plumbline.streaming import decode, scoring

SAMPLE = {"customerID": "7590", "gender": "Female", "SeniorCitizen": 0, "tenure": 12, "MonthlyCharges": 29.85, "TotalCharges": "29.85"}


def rows_of(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")


def test_decoding_rules(spark):
    texts = [
        json.dumps({"timestamp": "2024-01-01T00:00:00", "data": SAMPLE}),
        json.dumps(SAMPLE),
        "not json",
        json.dumps({**SAMPLE, "TotalCharges": None}),
        json.dumps({**SAMPLE, "MonthlyCharges": "many"}),
        json.dumps({"data": None}),
        "{}",
        "[1, 2]",
        json.dumps({**SAMPLE, "gender": None}),
    ]
    got = {r.i: r for r in decode.decode_records(rows_of(spark, *texts), keep=["i"]).collect()}
    assert [got[i].status for i in range(9)] == [
        "ok", "ok", "malformed", "invalid", "invalid", "malformed", "ok", "malformed", "ok",
    ]
    assert got[0].gender == got[1].gender == "Female" and got[0].TotalCharges == 29.85
    assert got[6].customerID == "0" and got[6].PaymentMethod == "Electronic check" and got[6].MonthlyCharges == 0.0
    assert got[8].gender is None and got[8].Partner == "No"


def test_every_field_has_its_default(spark):
    r = decode.decode_records(rows_of(spark, "{}")).first()
    assert {k: r[k] for k in CHURN_FIELDS} == {k: d for k, (_, d) in CHURN_FIELDS.items()}


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    encoded = messages.encode_envelope(df, "id")
    assert [r.key for r in encoded.collect()] == ["1", "2"]
    back = decode.decode_records(encoded, {"id": ("int", None), "s": ("string", None)}, ["id"], keep=["key"])
    assert sorted((r.key, r.id, r.s, r.status) for r in back.collect()) == [("1", 1, "a", "ok"), ("2", 2, "b", "ok")]
    timed = decode.with_envelope_time(decode.decode_json(encoded)).first()
    assert timed["_envelope_timestamp"].startswith("20")


@pytest.fixture(scope="module")
def fitted(customers):
    prep = plan.fit_preparation(customers, CHURN)
    rows = plan.apply_preparation(customers, prep)
    trained, _ = model.fit_directly(rows, model.decision_tree(maxDepth=4), prep.feature_columns, "Churn", "customerID")
    return prep, scoring_model(prep, trained)


def customer_messages(customers):
    return messages.encode_envelope(plan.clean_rows(customers, CHURN).drop("Churn"), "customerID")


def test_stream_scores_equal_batch_scores_and_bad_messages_are_kept_aside(spark, customers, fitted, tmp_path):
    prep, whole = fitted
    inbox = str(tmp_path / "inbox")
    good = customer_messages(customers)
    bad = spark.createDataFrame([("x", "oops"), ("y", '{"TotalCharges": null}')], "key string, value string")
    messages.write_messages(good, inbox)
    messages.write_messages(bad, inbox)
    source = messages.file_stream(spark, inbox, "key string, value string", max_files=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    scored = scoring.score_messages(source, whole, labels=prep.labels)
    scoring.run_scoring(scored, out, checkpoint)
    got = spark.read.parquet(out)
    want = scoring.score_messages(good, whole, labels=prep.labels)
    columns = ["customer_id", "original_data", "prediction"]
    assert got.count() == good.count()
    assert got.select(columns).exceptAll(want.select(columns)).count() == 0
    assert got.filter("prediction.prediction NOT IN ('No', 'Yes') OR prediction.probability NOT LIKE '%\\%'").count() == 0
    rejected = {r.value: r.status for r in scoring.rejected_messages(good.unionByName(bad)).collect()}
    assert rejected == {"oops": "malformed", '{"TotalCharges": null}': "invalid"}

    # the position survives: a second run only sees what is new
    messages.write_messages(good.limit(3), inbox)
    query = scoring.run_scoring(scored, out, checkpoint)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    assert spark.read.parquet(out).count() == good.count() + 3


def test_scored_records_as_messages(customers, fitted):
    prep, whole = fitted
    scored = scoring.score_messages(customer_messages(customers), whole, labels=prep.labels)
    row = scoring.encode_scored(scored).first()
    body = json.loads(row.value)
    assert set(body) == {"customer_id", "original_data", "prediction", "processed_at"} | ({"batch_id"} & set(body))
    assert body["customer_id"] == row.key and set(body["prediction"]) == {"prediction", "probability"}


def test_micro_batches_write_folders_and_summaries(spark, customers, fitted, tmp_path):
    prep, whole = fitted
    inbox = str(tmp_path / "inbox")
    good = customer_messages(customers)
    messages.write_messages(good.repartition(2), inbox)
    source = messages.file_stream(spark, inbox, "key string, value string", max_files=1)
    scored = scoring.score_ok_messages(source, whole)
    out, summary = str(tmp_path / "out"), str(tmp_path / "summary")
    scoring.run_batches(scored, out, str(tmp_path / "cp"), summary, labels=prep.labels)
    written, summed = spark.read.parquet(out), spark.read.parquet(summary)
    assert written.count() == good.count()
    assert written.select("batch_id").distinct().count() == summed.count() == 2
    assert summed.agg(F.sum("num_predictions")).first()[0] == good.count()
    assert set(written.columns) == {"customer_id", "original_data", "prediction", "processed_at", "batch_id"}


def test_null_fields_are_written_and_rejected(spark, fitted):
    rows = spark.createDataFrame([(1, None, "x")], "id int, MonthlyCharges double, note string")
    sent = messages.encode_envelope(rows, "id").first().value
    assert json.loads(sent)["data"] == {"id": 1, "MonthlyCharges": None, "note": "x"}
    got = decode.decode_records(spark.createDataFrame([(sent,)], "value string")).first()
    assert got.status == "invalid"


def test_values_unseen_in_training_are_scored(spark, customers, fitted):
    prep, whole = fitted
    sent = customer_messages(customers.limit(20)).withColumn(
        "value", F.regexp_replace("value", '"Contract":"[^"]*"', '"Contract":"Never seen"')
    )
    scored = scoring.score_messages(sent, whole, labels=prep.labels)
    assert scored.count() + scoring.rejected_messages(sent).count() == sent.count()
    assert scored.filter("prediction.prediction NOT IN ('No', 'Yes')").count() == 0
