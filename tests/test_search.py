from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from plumbline.operators import model, search

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=400), rng.normal(5, 10, size=400), rng.integers(0, 4, 400)])
    y = (x[:, 0] + 0.1 * x[:, 1] + (x[:, 2] == 2) + rng.normal(size=400) * 0.7 > 1.2).astype(int)
    rows = [(i, *map(float, v), int(label)) for i, (v, label) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int")
    return df, search.fold_table(df, FEATURES, "label", "id", 2)


def training(pdf, fold):
    use = np.where(pdf.draw == 0, pdf.fold != fold, pdf.made_for == fold).astype(bool)
    return np.stack(pdf.x[use]), pdf.y[use].to_numpy(float)


def test_every_fold_learns_from_balanced_rows(folded):
    df, table = folded
    pdf = table.toPandas()
    assert (pdf.draw == 0).sum() == df.count()
    for fold in (0, 1, search.ALL_ROWS):
        _, y = training(pdf, fold)
        assert (y == 0).sum() == (y == 1).sum()


def test_logistic_block_is_stationary_and_equals_single_fits(spark, folded):
    _, table = folded
    settings = search.settings_of({"C": [0.01, 1.0, 100.0], "maxIter": [2, 200]})
    block = search.fit_logistic(table, settings, [0, 1])
    assert block.passes < 60
    one = search.fit_logistic(table, settings[1:2], [0])
    assert block.passes <= one.passes + 25  # passes follow the longest run, not the number of runs
    pdf = table.toPandas()
    for r, fold in enumerate(block.runs.fold):
        s = settings[block.runs.setting[r]]
        x, y = training(pdf, fold)
        w = block.weights[r]
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        slope = np.append(x.T @ (p - y) + w[:-1] / s["C"], (p - y).sum())
        assert (np.abs(slope).max() < 0.01) == (s["maxIter"] > 2)
    x, y = training(pdf, 0)
    rows = spark.createDataFrame([(float(q), *map(float, v)) for q, v in zip(y, x, strict=True)], "label double, a double, b double, c double")
    single = model.logistic_regression(C=1.0, maxIter=200, tol=1e-10).fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    r = next(i for i, f in enumerate(block.runs.fold) if f == 0 and settings[block.runs.setting[i]] == {"C": 1.0, "maxIter": 200})
    assert np.allclose(block.weights[r], [*single.coefficients, single.intercept], atol=1e-4)


def grow(bins, y, kind, least, depth, node=1):
    """(node, feature, cut) of a tree grown by trying every split."""
    def loss(v):
        n, k = len(v), v.sum()
        if kind == "gini":
            return 2 * k * (n - k) / n
        return sum(-q * np.log2(q / n) for q in (k, n - k) if q)

    best = None
    for i in range(bins.shape[1]) if depth else ():
        for cut in range(int(bins[:, i].max())):
            left = bins[:, i] <= cut
            if min(left.sum(), (~left).sum()) < max(least, 1):
                continue
            gain = loss(y) - loss(y[left]) - loss(y[~left])
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = (gain, i, cut)
    if best is None:
        return {}
    left = bins[:, best[1]] <= best[2]
    return {node: best[1:], **grow(bins[left], y[left], kind, least, depth - 1, 2 * node), **grow(bins[~left], y[~left], kind, least, depth - 1, 2 * node + 1)}


def test_trees_equal_all_splits(folded):
    _, table = folded
    settings = search.settings_of({"maxDepth": [1, 3], "minInstancesPerNode": [1, 15], "impurity": ["gini", "entropy"]})
    block = search.fit_trees(table, settings, [0, 1])
    assert block.passes == 4  # depth and leaves, whatever the settings
    pdf = table.toPandas()
    for k, (kind, least, fold) in enumerate(block.families):
        x, y = training(pdf, fold)
        want = grow(block.binned(x), y, kind, least, 3)
        found = {n: (block.feature[k, n], block.cut[k, n]) for n in np.flatnonzero(block.feature[k] >= 0)}
        assert found == want
        at = block.descend(k, block.binned(x), 2)
        for node in np.unique(at):
            assert block.positive[k, node] == pytest.approx(y[at == node].mean())


def test_scores_come_from_rows_a_run_did_not_learn_from(folded):
    _, table = folded
    settings = search.settings_of({"maxDepth": [1, 3]})
    found = search.fold_predictions(table, search.TREE, settings, 2)
    rows = found.toPandas()
    assert len(rows) == 2 * 400 and rows.groupby(["key", "setting"]).size().max() == 1
    for scoring in ("accuracy", "f1"):
        got = {r.setting: r.score for r in search.setting_scores(found, scoring).collect()}
        for s, part in rows.groupby("setting"):
            each = []
            for _, fold in part.groupby("fold"):
                hit = ((fold.y == 1) & (fold.prediction == 1)).sum()
                each.append((fold.y == fold.prediction).mean() if scoring == "accuracy" else 2 * hit / ((fold.y == 1).sum() + (fold.prediction == 1).sum()))
            assert got[s] == pytest.approx(np.mean(each))
    with pytest.raises(ValueError):
        search.setting_scores(found, "recall")


def test_grid_search_takes_the_shared_way(folded):
    df, table = folded
    found = model.grid_search(df, model.decision_tree(), {"maxDepth": [1, 3], "impurity": ["gini"]}, FEATURES, "label", "id", folds=2, table=table)
    assert found.params == ["impurity=gini, maxDepth=1", "impurity=gini, maxDepth=3"] and len(found.avgMetrics) == 2
    assert found.bestModel.stages[-1].getMaxDepth() == (1 if found.avgMetrics[0] >= found.avgMetrics[1] else 3)
    assert found.bestModel.transform(df.withColumn("label", F.col("label").cast("double"))).count() == df.count()
    assert model.shared_family(model.random_forest(), {"maxDepth": [3]}) is None
    assert model.shared_family(model.decision_tree(), {"maxBins": [3]}) is None
    with pytest.raises(ValueError):
        search.shared_search(df, search.TREE, {"maxBins": [3]}, FEATURES, "label", "id")
