from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from catalogue import modelling
from plumbline.operators import gate, model
from plumbline.plans import prepare as plan
from plumbline.plans.score import batch_score
from plumbline.plans.train import compare_models, scoring_model, train_and_evaluate
from plumbline.spec import CHURN


@pytest.fixture(scope="module")
def prepared(customers):
    prep = plan.fit_preparation(customers, CHURN)
    return prep, plan.apply_preparation(customers, prep).cache()


# Quality floors on the held-out rows.
FLOORS = {
    "random_forest": (dict(numTrees=20, maxDepth=6), 0.85),
    "boosted_trees": (dict(maxIter=5, maxDepth=4), 0.85),
    "decision_tree": (dict(maxDepth=6), 0.70),
    "logistic_regression": (dict(C=1.0, maxIter=50), 0.80),
}


@pytest.mark.parametrize("name", FLOORS)
def test_quality_floors(prepared, name):
    prep, rows = prepared
    settings, floor = FLOORS[name]
    fitted, accuracy = model.fit_directly(
        rows.filter("split = 'train'"), model.BUILDERS[name](**settings), prep.feature_columns, "Churn", "customerID"
    )
    scored = fitted.transform(rows.filter("split = 'test'"))
    assert BinaryClassificationEvaluator(labelCol="Churn").evaluate(scored) >= floor
    assert 0.7 <= accuracy <= 1.0


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression"])
def test_models_score_in_a_session_that_observed_metrics(spark, name):
    seen = Observation()
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 7 > 3)) for i in range(60)], "id bigint, a double, label double")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 60
    settings = {"numTrees": 2, "maxDepth": 2} if name == "random_forest" else {"maxIter": 5}
    fitted, accuracy = model.fit_directly(rows, model.BUILDERS[name](**settings), ["a"], "label", "id")
    assert accuracy == 1.0
    assert model.score(fitted, rows).filter("prediction = label").count() == 60


def test_balanced_rows_are_made_once(spark):
    rows = spark.createDataFrame([(i, float(i % 7), float(i), float(i % 5 == 0)) for i in range(60)], "id bigint, a double, b double, label double")
    estimator = model.BalancedClassifier(classifier=model.decision_tree(maxDepth=2), features=["a", "b"], label="label", key="id")
    made = estimator.training_rows(rows)
    assert made.count() == 96
    assert made.inputFiles() and all("/balanced-" in f for f in made.inputFiles())


def test_default_settings():
    forest, booster = model.random_forest(), model.boosted_trees()
    assert (forest.getMaxDepth(), forest.getNumTrees(), forest.getMinInstancesPerNode(), forest.getSeed()) == (10, 100, 1, 42)
    assert (booster.getMaxDepth(), booster.getMaxIter(), booster.getSeed()) == (10, 100, 42)
    assert len(model.param_grid(booster, model.BOOSTER_GRID)) == 48
    assert len(model.param_grid(model.decision_tree(), model.TREE_GRID)) == 18


def test_gbt_score_trains_the_whole_booster(spark, tmp_path, monkeypatch):
    rows = [(i, 10 * i, " ".join(["w"] * (i % 5 + 1)), "en", int(i > 40)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, n_chars int, text string, lang string, quality int")
    df.drop("quality").write.parquet(str(tmp_path / "documents.parquet"))
    df.select("doc_id", "quality").write.parquet(str(tmp_path / "labels.parquet"))
    fitted, score = [], model.score
    monkeypatch.setattr(model, "score", lambda m, df: fitted.append(m.stages[-1]) or score(m, df))
    out = modelling.gbt_score(spark, str(tmp_path)).collect()
    assert out and all(r.prediction_fits and r.confidence_fits for r in out)
    assert (fitted[0].getNumTrees, fitted[0].getMaxIter(), fitted[0].getMaxDepth()) == (100, 100, 10)


def test_balancing_touches_training_rows_only(prepared):
    prep, rows = prepared
    estimator = model.BalancedClassifier(
        classifier=model.decision_tree(maxDepth=3), features=list(prep.feature_columns), label="Churn", key="customerID"
    )
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    counts = {r["count"] for r in estimator.training_rows(train).groupBy("Churn").count().collect()}
    assert len(counts) == 1
    assert estimator.fit(train).transform(test).count() == test.count()


def test_grid_search_and_comparison(prepared):
    prep, rows = prepared
    small = ["MonthlyCharges", "TotalCharges", "tenure_bins"]
    candidates = {
        "forest": (model.random_forest(numTrees=2, maxDepth=3), {"classWeight": ["balanced", "balanced_subsample", None]}),
        "logistic": (model.logistic_regression(maxIter=5), {"C": [0.1, 1.0]}),
    }
    table = {r.model: r for r in compare_models(rows, candidates, small, "Churn", "customerID", folds=2).collect()}
    assert set(table) == {"forest", "logistic"}
    assert all(0.0 <= r.cv_score <= 1.0 and 0.0 <= r.f1 <= 1.0 for r in table.values())
    assert "regParam=" in table["logistic"].params and "weightCol=" in table["forest"].params


def test_training_without_grid(prepared):
    prep, rows = prepared
    result = train_and_evaluate(rows, prep.feature_columns, "Churn", "customerID", model.decision_tree(maxDepth=3))
    assert result.searched is None and 0.5 < result.score <= 1.0
    m = result.metrics.first()
    assert m.tp + m.fp + m.fn + m.tn == rows.filter("split = 'test'").count()


def test_saved_model_scores_raw_records_alike(customers, prepared, tmp_path):
    prep, rows = prepared
    fitted, _ = model.fit_directly(
        rows.filter("split = 'train'"), model.decision_tree(maxDepth=4), prep.feature_columns, "Churn", "customerID"
    )
    whole, path = scoring_model(prep, fitted), str(tmp_path / "m")
    assert not gate.model_gate(customers.sparkSession, path)
    model.save_model(whole, path)
    assert gate.model_gate(customers.sparkSession, path)
    raw = plan.clean_rows(customers, CHURN).drop("Churn")
    want = batch_score(raw, whole, "customerID").select("customerID", "prediction", "confidence")
    got = batch_score(raw, model.load_model(path), "customerID", path=str(tmp_path / "out"))
    assert want.exceptAll(got.select(want.columns)).count() == 0
    assert batch_score(raw, whole, "customerID", sample_size=50).count() == 50
    assert "confidence" not in batch_score(raw, whole, "customerID", with_probability=False).columns
    direct = {r.customerID: r.prediction for r in model.score(fitted, rows).collect()}
    assert all(direct[r.customerID] == r.prediction for r in want.collect() if r.customerID in direct)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r.y: r.class_weight for r in model.add_class_weight(df, "y").collect()}
    assert got == pytest.approx({0: 4 / 6, 1: 2.0})


def test_feature_alignment(customers, prepared):
    prep, _ = prepared
    aligned = plan.align_features(prep, "customerID").transform(customers.select("customerID", "MonthlyCharges", "gender"))
    assert aligned.columns == ["customerID", *prep.feature_columns]
    assert aligned.agg(F.max("gender_Male")).first()[0] == 0


def test_every_row_is_scored_once(spark):
    rows = [(i, float(i % 7), float(i % 3), float(i % 7 > 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    holes = spark.createDataFrame([(100, None, 1.0), (101, float("nan"), 2.0), (102, 5.0, None)], "id long, a double, b double")
    for classifier, filled in ((model.decision_tree(), 3), (model.logistic_regression(), 0)):
        fitted, _ = model.fit_directly(df, classifier, ["a", "b"], "y", "id")
        got = model.score(fitted, holes).collect()
        assert sorted(r.id for r in got) == [100, 101, 102]
        assert sum(r.prediction is not None and r.confidence is not None for r in got) == filled


def penalised(x, y, C):
    """Newton steps on sum of log losses + w^2 / (2 C), intercept free."""
    w = b = 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(w * x + b)))
        g = np.array([((p - y) * x).sum() + w / C, (p - y).sum()])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1 / C, (v * x).sum()], [(v * x).sum(), v.sum()]])
        w, b = np.array([w, b]) - np.linalg.solve(h, g)
    return w


@pytest.mark.parametrize("n", [40, 400])
@pytest.mark.parametrize("C", [0.05, 2.0])
def test_penalty_follows_the_fitted_rows(spark, n, C):
    rows = [(i, (i % 10) / 3.0, float((i % 10) + (i % 3) > 6)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    fitted, _ = model.fit_directly(df, model.logistic_regression(C=C, maxIter=500, tol=1e-10), ["x"], "y", "id")
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    assert fitted.stages[-1].coefficients[0] == pytest.approx(penalised(x, y, C), rel=1e-3)


def test_all_grids_name_real_settings():
    for build, grid, n in (
        (model.random_forest, model.FOREST_GRID, 54), (model.logistic_regression, model.LOGISTIC_GRID, 6),
        (model.boosted_trees, model.BOOSTER_GRID, 48), (model.decision_tree, model.TREE_GRID, 18),
    ):
        assert len(model.param_grid(build(), grid)) == n


def test_balanced_subsample_forest(spark, prepared, tmp_path):
    prep, rows = prepared
    small = ["MonthlyCharges", "TotalCharges", "tenure_bins"]
    forest = model.random_forest(numTrees=4, maxDepth=4, weightCol=model.SUBSAMPLE_WEIGHT)
    estimator = model.BalancedClassifier(classifier=forest, features=small, label="Churn", key="customerID", balance=False, weighted=True)
    train = rows.filter("split = 'train'")
    fitted = estimator.fit(train)
    assert fitted.stages[-1].getNumTrees == 4
    drawn, weights = model.subsample_weights(estimator.training_rows(train), "Churn", 4)
    for t, classes in enumerate(weights):
        sums = {r.Churn: r.n for r in drawn.groupBy("Churn").agg(F.sum(F.get("draws", F.lit(t))).alias("n")).collect()}
        assert len({round(classes[c] * n, 6) for c, n in sums.items()}) == 1
        assert 0.7 < sum(sums.values()) / train.count() < 1.3
    path = str(tmp_path / "forest")
    model.save_model(fitted, path)
    scored = model.score(fitted, rows)
    again = model.score(model.load_model(path), rows)
    assert scored.select("customerID", "prediction").exceptAll(again.select("customerID", "prediction")).count() == 0
    assert BinaryClassificationEvaluator(labelCol="Churn", rawPredictionCol="positive_probability").evaluate(scored) > 0.7
