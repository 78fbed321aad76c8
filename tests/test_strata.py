from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.functions import ranks, selection, strata
from plumbline.operators import sample


def assigned(df, column):
    return {r.id: r[column] for r in df.select("id", column).collect()}


@pytest.fixture(scope="module")
def rows(spark):
    # a third of the rows in one stratum, many small ones, and a null one
    s = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 31 == 0, F.lit(None)).otherwise((F.col("id") % 11).cast("string"))
    return spark.range(6000).withColumn("y", s)


@pytest.mark.parametrize("leaf", [strata.LEAF_ROWS, 1])
def test_table_and_literals_agree(rows, monkeypatch, leaf):
    monkeypatch.setattr(strata, "LEAF_ROWS", leaf)
    assert assigned(sample.split_by_table(rows, "id", "y"), "split") == assigned(sample.split_train_test(rows, "id", "y"), "split")
    assert assigned(sample.folds_by_table(rows, "id", "y", 4), "fold") == assigned(sample.assign_folds(rows, "id", "y", 4), "fold")


def test_many_strata_take_the_table(rows, monkeypatch):
    monkeypatch.setattr(selection, "MAX_STRATA", 0)
    out = sample.split_train_test(rows, "id", "y")
    assert "Exchange" in out._jdf.queryExecution().executedPlan().toString()
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    want = sample.stratified_sizes(sizes, 0.2)
    got = {r.y: r.n for r in out.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {k: v for k, v in want.items() if v}
    folds = sample.assign_folds(rows, "id", "y", 4).groupBy("y", "fold").count().collect()
    for y in sizes:
        each = [r["count"] for r in folds if r.y == y]
        assert max(each) - min(each) <= 1


def test_a_stratum_for_every_row(spark):
    df = spark.range(3000).withColumn("y", F.col("id"))
    out = sample.split_by_table(df, "id", "y")
    assert out.where("split = 'test'").count() == 600 and out.columns == ["id", "y", "split"]


def test_shared_keys_stay_together_and_empty_tables(spark):
    df = spark.range(40).withColumn("key", F.col("id") % 4).withColumn("y", F.lit(1))
    parts = sample.split_by_table(df, "key", "y").groupBy("key").agg(F.count_distinct("split").alias("n")).collect()
    assert {r.n for r in parts} == {1}
    empty = df.where("false")
    assert sample.split_by_table(empty, "key", "y").collect() == [] == sample.folds_by_table(empty, "key", "y").collect()


def test_ranks_over_ranges(spark):
    df = spark.range(500).withColumn("v", F.concat(F.lit("v"), F.col("id").cast("string"))).withColumn("g", F.col("id") % 3)
    got = {r.id: r.r for r in ranks.rank_rows(df, ["v"], "r").collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(range(500), key=lambda i: f"v{i}")
    for g in range(3):
        got = {r.id: r.r for r in ranks.rank_rows(df, ["v"], "r", by="g").where(F.col("g") == g).collect()}
        assert [i for i, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(range(g, 500, 3), key=lambda i: f"v{i}")
