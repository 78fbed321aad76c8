from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import binning, clean, gate, outliers
from plumbline.spec import BinSpec


def test_drop_missing_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, s string")
    assert [r.s for r in clean.drop_missing(df).collect()] == ["a"]


def test_drop_blank(spark):
    df = spark.createDataFrame([("1",), (" ",), ("",), (None,), ("0",)], "TotalCharges string")
    assert sorted(r[0] for r in clean.drop_blank(df).collect()) == ["0", "1"]
    with pytest.raises(ValueError):
        clean.drop_blank(df, "absent")


def test_cast_columns_skips_absent_and_keeps_bad_values_null(spark):
    df = spark.createDataFrame([("1.5",), (" ",), ("x",)], "v string")
    got = [r.v for r in clean.cast_columns(df, {"v": "double", "w": "int"}).collect()]
    assert got == [1.5, None, None]


def test_map_values_and_lookup_default(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("?",), (None,)], "v string")
    assert [r.v for r in clean.map_values(df, "v", {"Yes": 1, "No": 0}).collect()] == [1, 0, None, None]
    named = df.select(clean.lookup(F.col("v"), {"Yes": "y"}, "Unknown"))
    assert [r[0] for r in named.collect()] == ["y", "Unknown", "Unknown", "Unknown"]


def test_align_columns_fills_and_drops(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b c` int, d int")
    out = clean.align_columns(df, ["d", "new", "b c"])
    assert out.columns == ["d", "new", "b c"]
    assert tuple(out.first()) == (3, 0, 2)


def test_impute_median_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (10.0,)], "x double")
    assert sorted(r.x for r in clean.impute_median(df, ["x"]).collect()) == [1.0, 3.0, 3.0, 3.0, 10.0]


def test_bins_at_the_edges(spark):
    df = spark.createDataFrame([(12,), (13,), (48,), (49,), (None,)], "tenure int")
    out = binning.bin_fixed(df, "tenure")
    assert out.columns == ["tenure_bins"]
    assert [r[0] for r in out.collect()] == ["Newer", "Medium", "Medium", "Long-term", "Long-term"]
    kept = binning.bin_fixed(df, "tenure", BinSpec((12, 48), ("a", "b", "c"), None))
    assert [r[0] for r in kept.collect()][-1] is None
    with pytest.raises(KeyError):
        binning.bin_fixed(df, "absent")


def test_outlier_rules(spark):
    rows = [(float(v), float(v)) for v in range(1, 21)] + [(1000.0, 1000.0), (1000.0, 5.0), (None, 1000.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    bounds = outliers.fit_iqr(df, ["a", "b"])
    counted = outliers.outlier_count(df, bounds).filter("outlier_count > 0").collect()
    assert sorted(r.outlier_count for r in counted) == [1, 1, 2]
    assert outliers.remove_outliers(df, bounds).count() == len(rows) - 1
    assert outliers.outlier_count(df, {}).select("outlier_count").distinct().collect()[0][0] == 0


def test_outliers_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a double")
    bounds = outliers.fit_iqr(df, ["a"])
    assert bounds["a"].low is None
    assert outliers.remove_outliers(df, bounds).count() == 0
    assert outliers.outlier_report(df, bounds).first()["fraction"] is None


def test_approximate_bounds_stay_within_rank_error(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    b = outliers.fit_iqr(df, ["v"], relative_error=0.01)["v"]
    assert abs(b.q1 - 2500) <= 101 and abs(b.q3 - 7500) <= 101


def test_filter_runs_in_the_scan_stage(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    kept = outliers.remove_outliers(df, outliers.fit_iqr(df, ["v"]), min_outliers=1)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_gate(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert {r.status for r in gate.table_gate(df, ["a"], 2).collect()} == {"pass"}
    checks = gate.table_gate(df, ["a", "b"], 3)
    assert {r["check"]: r.status for r in checks.collect()} == {"columns": "fail", "rows": "fail"}
    with pytest.raises(ValueError, match="missing: b"):
        gate.assert_gate(checks)
