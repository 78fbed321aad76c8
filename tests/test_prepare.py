from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from plumbline.functions.columns import clean_double
from plumbline.operators.clean import drop_blank, drop_missing
from plumbline.plans import prepare as plan
from plumbline.sources import files
from plumbline.spec import CHURN

# Names of the 45 prepared feature columns.
FEATURES = {
    "SeniorCitizen", "MonthlyCharges", "TotalCharges", "gender_Female", "gender_Male", "Partner_No", "Partner_Yes",
    "Dependents_No", "Dependents_Yes", "PhoneService_No", "PhoneService_Yes", "MultipleLines_No",
    "MultipleLines_No phone service", "MultipleLines_Yes", "InternetService_DSL", "InternetService_Fiber optic",
    "InternetService_No", "Contract_Month-to-month", "Contract_One year", "Contract_Two year", "PaperlessBilling_No",
    "PaperlessBilling_Yes", "PaymentMethod_Bank transfer (automatic)", "PaymentMethod_Credit card (automatic)",
    "PaymentMethod_Electronic check", "PaymentMethod_Mailed check", "tenure_bins",
} | {
    f"{c}_{v}"
    for c in ("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies")
    for v in ("No", "No internet service", "Yes")
}


@pytest.mark.parametrize("scope", plan.FIT_SCOPES)
def test_churn_preparation(customers, scope):
    out = plan.prepare(customers, CHURN, scope).cache()
    assert set(out.columns) == FEATURES | {"customerID", "Churn", "split"}
    assert len(FEATURES) == 45
    blank = customers.filter(F.trim("TotalCharges") == "").count()
    assert 0 < blank and out.count() <= customers.count() - blank
    assert {r[0] for r in out.select("Churn").distinct().collect()} == {0.0, 1.0}
    one_hot = [f"PaymentMethod_{v}" for v in ("Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check")]
    sums = out.select(sum((F.col(f"`{c}`") for c in one_hot), F.lit(0)).alias("s")).distinct().collect()
    assert [r.s for r in sums] == [1]
    learned = out if scope == "all" else out.filter("split = 'train'")
    low, high = learned.agg(F.min("MonthlyCharges"), F.max("MonthlyCharges")).first()
    assert low == 0.0 and high == 1.0
    n, test = out.count(), out.filter("split = 'test'").count()
    assert abs(test - 0.2 * n) <= 2


def test_splits_cover_and_do_not_overlap(customers):
    out = plan.prepare(customers, CHURN, "all")
    assert out.select("customerID").distinct().count() == out.count()


def test_repartitioning_changes_nothing(customers):
    one = plan.prepare(customers.repartition(1), CHURN)
    many = plan.prepare(customers.repartition(11), CHURN)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_metrics_match_the_written_table(customers, tmp_path):
    path = str(tmp_path / "prepared")
    m = plan.prepare_with_metrics(customers, CHURN, path).first()
    written = customers.sparkSession.read.parquet(path)
    clean = drop_blank(drop_missing(customers))
    clean = clean.withColumn("TotalCharges", clean_double(clean, "TotalCharges"))
    assert m.raw_rows == 600 and m.missing_rows == 600 - clean.count()
    assert m.dataset_rows == written.count() == m.training_rows + m.test_rows
    assert m.outliers_removed == clean.count() - written.count() and m.num_features == 45


def test_prepared_table_is_reused_until_settings_change(customers, tmp_path, monkeypatch):
    spark, folder, raw = customers.sparkSession, str(tmp_path / "prepared"), str(tmp_path / "raw")
    customers.write.parquet(raw)
    first = plan.prepare_to_table(spark, spark.read.parquet(raw), CHURN, folder).count()
    with monkeypatch.context() as m:
        m.setattr(plan, "prepare", None)
        assert plan.prepare_to_table(spark, spark.read.parquet(raw), CHURN, folder).count() == first
    customers.limit(100).write.mode("append").parquet(raw)
    assert plan.prepare_to_table(spark, spark.read.parquet(raw), CHURN, folder).count() > first
    other = dataclasses.replace(CHURN, max_outlier_columns=0)
    assert other.fingerprint() != CHURN.fingerprint()
    plan.prepare_to_table(spark, customers, other, folder)


def test_reading_one_split_prunes_the_other(customers, tmp_path):
    path = str(tmp_path / "t")
    files.write_split(plan.prepare(customers, CHURN), path)
    plan_text = customers.sparkSession.read.parquet(path).filter("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan_text


def test_bad_scope(customers):
    with pytest.raises(ValueError):
        plan.fit_preparation(customers, CHURN, "test")


@pytest.mark.parametrize("form", ["csv", "json", "parquet", "orc"])
def test_table_round_trip(spark, tmp_path, form):
    df = spark.createDataFrame([(1, 'say "hi", you', 1.5), (2, "x", None)], "id int, s string, v double")
    files.save_table(df, str(tmp_path / form), form)
    back = files.load_table(spark, str(tmp_path / form), form, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    files.save_table(df, str(tmp_path / form), form, mode="append")
    assert files.load_table(spark, str(tmp_path / form), form, df.schema).count() == 4
    files.save_table(df, str(tmp_path / form), form, mode="ignore")
    with pytest.raises(Exception, match="(?i)already exists"):
        files.save_table(df, str(tmp_path / form), form, mode="error")


def test_csv_inference_is_opt_in_and_trims(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,TotalCharges\n1, 2.5\n2, \n")
    typed = files.scan_csv(spark, str(tmp_path / "c.csv"), "id int, TotalCharges string")
    assert dict(typed.dtypes)["TotalCharges"] == "string"
    assert dict(files.scan_csv(spark, str(tmp_path / "c.csv")).dtypes)["TotalCharges"] == "string"
    assert dict(files.load_table(spark, str(tmp_path / "c.csv"), "csv").dtypes)["TotalCharges"] == "double"


def test_partition_target():
    assert [files.partition_target(n) for n in (0, 9_999, 25_000, 10**9)] == [1, 1, 2, 200]
