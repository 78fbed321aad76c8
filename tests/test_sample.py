from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import sample


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_stratified_sizes_follow_the_known_split():
    assert sample.stratified_sizes({"No": 5163, "Yes": 1869}, 0.2) == {"No": 1033, "Yes": 374}


@pytest.mark.parametrize("counts", [{"a": 5}, {"a": 1, "b": 1}, {"a": 7, "b": 3, "c": 3}, {}])
def test_stratified_sizes_add_up(counts):
    sizes = sample.stratified_sizes(counts, 0.25)
    assert sum(sizes.values()) == -(-sum(counts.values()) // 4)
    assert all(sizes[s] <= counts[s] for s in sizes)


def test_stratified_split_counts_and_reproducibility(spark):
    df = spark.range(7032).withColumn("y", F.when(F.col("id") < 5163, "No").otherwise("Yes"))
    out = sample.split_train_test(df, "id", "y")
    counts = {(r.split, r.y): r["count"] for r in out.groupBy("split", "y").count().collect()}
    assert counts == {("test", "No"): 1033, ("test", "Yes"): 374, ("train", "No"): 4130, ("train", "Yes"): 1495}
    again = sample.split_train_test(df.repartition(17), "id", "y")
    assert pairs(out, "id", "split") == pairs(again, "id", "split")
    assert sample.split_train_test(df, "id", "y", seed=7).exceptAll(out).count() > 0


def test_assigning_a_split_needs_no_shuffle(spark, tmp_path):
    spark.range(1000).withColumn("y", F.col("id") % 2).write.parquet(str(tmp_path / "t"))
    out = sample.split_train_test(spark.read.parquet(str(tmp_path / "t")), "id", "y")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_folds_are_even_within_classes(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    sizes = {}
    for r in sample.assign_folds(df, "id", "y", k=5).groupBy("y", "fold").count().collect():
        sizes.setdefault(r.y, []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())


def test_folds_with_fewer_rows_than_folds(spark):
    df = spark.range(3).withColumn("y", F.lit(1))
    assert sample.assign_folds(df, "id", "y", k=5).select("fold").distinct().count() == 3


def test_sample_sizes(spark):
    df = spark.range(5000)
    assert sample.sample_rows(df, "id", n=100).count() == 100
    assert sample.sample_rows(df, "id", n=10_000).count() == 5000
    assert sample.sample_rows(df, "id", n=0).count() == 0
    assert abs(sample.sample_rows(df, "id", fraction=0.3).count() - 1500) < 150
    with pytest.raises(ValueError):
        sample.sample_rows(df, "id")


def test_sampling_an_empty_table(spark):
    empty = spark.range(0).withColumn("y", F.lit(1))
    assert sample.sample_n(empty, 5, "id").count() == 0
    assert sample.split_train_test(empty, "id", "y").count() == 0
    assert sample.split_train_test(empty, "id").count() == 0
