from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import evaluate, profile, stats, topics


def test_missing_counts(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("", float("nan"), None), (" ", None, 3), (None, 2.0, 4)], "s string, x double, i int"
    )
    got = {r["column"]: (r.missing, r.missing_or_blank) for r in profile.missing_counts(df).collect()}
    assert got == {"s": (2, 3), "x": (2, 2), "i": (1, 1)}


def test_column_stats_decimal_and_smallint_count_as_numeric(spark):
    df = spark.range(1, 6).select(F.col("id").cast("decimal(9,2)").alias("d"), F.col("id").cast("smallint").alias("s"))
    rows = {r["column"]: r for r in profile.column_stats(df, ["d", "s"]).collect()}
    assert rows["d"]["median"] == 3.0 and rows["s"]["q1"] == 2.0
    assert {r["column"] for r in profile.table_profile(df).collect()} == {"*", "d", "s"}


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in profile.top_values(df, "v", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_value_counts_percent(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert {r.value: r.percent for r in profile.value_counts(df, ["v"]).collect()} == {"a": 66.67, "b": 33.33}


def test_corr_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "a")] == 1.0
    assert got[("a", "c")] is None or math.isnan(got[("a", "c")])
    assert got[("c", "c")] is None


def test_kde_integrates_to_one(spark):
    df = spark.range(500).select((F.col("id") % 37).cast("double").alias("v"))
    rows = profile.kde_grid(df, "v").orderBy("grid_id").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.density for r in rows])
    assert np.trapezoid(y, x) == pytest.approx(1.0, abs=5e-3)
    assert profile.kde_grid(df.filter("v < 0"), "v").count() == 0


def cells(spark, table):
    rows = [(a, b) for (a, b), n in table.items() for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b string")


def test_chi2_with_continuity_correction(spark):
    df = cells(spark, {("x", "0"): 10, ("x", "1"): 20, ("y", "0"): 30, ("y", "1"): 15})
    r = stats.chi2_test(df, "a", "b").first()
    n, det = 75, abs(10 * 15 - 20 * 30)
    assert r.stat == pytest.approx(n * (det - n / 2) ** 2 / (30 * 45 * 40 * 35))
    assert r.dof == 1 and 0 < r.p_value < 0.05


def test_chi2_with_an_empty_cell_and_more_classes(spark):
    table = {("x", "0"): 8, ("x", "1"): 4, ("y", "1"): 6, ("z", "0"): 5, ("z", "1"): 5}
    r = stats.chi2_test(cells(spark, table), "a", "b").first()
    rows, cols, n = {"x": 12, "y": 6, "z": 10}, {"0": 13, "1": 15}, 28
    want = sum((table.get((a, b), 0) - ra * cb / n) ** 2 / (ra * cb / n) for a, ra in rows.items() for b, cb in cols.items())
    assert r.stat == pytest.approx(want) and r.dof == 2


def test_t_test_omits_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1), (None, 1), (2.0, 0), (4.0, 0), (6.0, 0), (float("nan"), 0)], "v double, y int")
    r = stats.t_test(df, "v", "y").first()
    assert r.t == pytest.approx(-2 / math.sqrt(2.5 * (2 / 3))) and r.dof == 4
    assert r.p_value == pytest.approx(0.196, abs=1e-3)


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    r = evaluate.binary_metrics(df).first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.0, 0.0, 0.0)
    report = {x.row: x for x in evaluate.classification_report(df).collect()}
    assert report["1"].precision == 0.0 and report["0"].recall == 1.0 and report["macro avg"].support == 2


def test_risk_tier_edges(spark):
    df = spark.createDataFrame([(0.0, 0.5), (1.0, 0.7), (1.0, 0.71), (0.0, 0.1)], "prediction double, probability double")
    r = evaluate.risk_summary(df).first()
    assert (r.high_risk, r.medium_risk, r.low_risk, r.churn, r.retain) == (1, 1, 2, 2, 2)


def test_probability_text(spark):
    df = spark.createDataFrame([(0.875,), (1.0,), (0.123456,)], "p double")
    assert [r[0] for r in df.select(evaluate.format_probability(F.col("p"))).collect()] == ["87.5%", "100.0%", "12.35%"]


def test_lag_and_replay(spark):
    log = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(5)], "topic string, partition int, offset bigint")
    committed = spark.createDataFrame([("g", "t", 0, 3)], "group_id string, topic string, partition int, current_offset bigint")
    lag = {r.partition: r.lag for r in topics.consumer_lag(log, committed).collect()}
    assert lag == {0: 2, 1: 5, -1: 7}
    assert topics.replay_range(log, 1, 3).count() == 4
    assert topics.replay_range(log).count() == 10


def test_density_equals_the_plain_sum_of_kernels(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate((rng.normal(size=600), rng.normal(50, 3, 300), [1e4, -500.0]))
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double")
    rows = profile.kde_grid(df, "v", points=60).orderBy("grid_id").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    want = [np.exp(-0.5 * ((r.x - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi)) for r in rows]
    assert len(rows) == 60 and np.abs(np.array([r.density for r in rows]) - want).max() < 1e-12 * max(want)


def test_wide_correlations_equal_the_plain_ones(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 7)) + np.arange(7) * 1e5
    x[:, 5] = 4.0
    rows = [[None if rng.random() < 0.2 else float(c) for c in r] for r in x]
    names = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    plain = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix(df, names).collect()}
    wide = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix_wide(df, names, block=3).collect()}
    assert set(plain) == set(wide)
    for k, v in plain.items():
        assert wide[k] is None if v is None else wide[k] == pytest.approx(v, abs=1e-9)
    empty = profile.corr_matrix_wide(df.where("false"), names)
    assert empty.collect() == []


def test_two_thousand_columns_plan_at_once(spark):
    names = [f"c{i}" for i in range(2000)]
    df = spark.range(40).select(F.col("id"), *[(F.col("id") * (i % 7 + 1) % (i % 11 + 2)).cast("double").alias(f"c{i}") for i in range(2000)])
    assert profile.corr_matrix_wide(df, names).count() == 2000 * 2000
