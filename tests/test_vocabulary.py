from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plumbline.operators import stages, vocabulary


@pytest.fixture(scope="module")
def rows(spark):
    # one value on a third of the rows, missing values, and many that occur once
    word = F.when(F.col("id") % 3 == 0, "often").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("w"), F.col("id").cast("string")))
    return spark.range(1500).select("id", word.alias("a b"), (F.col("id") % 7).alias("c"))


def test_same_indexes_as_the_literal_indexer(rows):
    for mode in ("drop", "keep_null"):
        table = vocabulary.VocabularyIndexer(inputCols=["a b", "c", "absent"], onInvalid=mode).fit(rows).transform(rows)
        plain = stages.CategoryIndexer(inputCols=["a b", "c", "absent"], onInvalid=mode).fit(rows).transform(rows)
        assert table.columns == plain.columns
        assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_unseen_values(spark, rows):
    model = vocabulary.VocabularyIndexer(inputCols=["c"], onInvalid="error").fit(rows)
    unseen = spark.createDataFrame([(1, "x", 99)], "id long, `a b` string, c long")
    with pytest.raises(Exception, match="unseen value in c: 99"):
        model.transform(unseen).collect()
    assert model.copy({model.onInvalid: "drop"}).transform(unseen).collect() == []
    with pytest.raises(ValueError):
        model.copy({model.onInvalid: "maybe"}).transform(unseen)


def test_decode_and_sparse_dummies(rows):
    model = vocabulary.VocabularyIndexer(inputCols=["a b"], onInvalid="keep_null").fit(rows)
    indexed = model.transform(rows.withColumn("word", F.col("a b")))
    decoded = model.decode(indexed, "a b", "back", "a b")
    assert decoded.where("coalesce(word, 'Unknown') != back").count() == 0 and decoded.count() == 1500
    for r in vocabulary.SparseDummies(model).transform(indexed).where("id < 60").collect():
        vector = r["a b_vec"]
        assert vector.size == model.sizes(rows.sparkSession)["a b"]
        assert list(vector.indices) == ([] if r["a b"] is None else [int(r["a b"])])


def test_saved_and_loaded(rows, tmp_path):
    model = PipelineModel([vocabulary.VocabularyIndexer(inputCols=["c"], path=str(tmp_path / "words")).fit(rows)])
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.transform(rows).exceptAll(model.transform(rows)).count() == 0


def test_nothing_to_index(spark):
    empty = spark.createDataFrame([], "id long, c string")
    assert vocabulary.index_values(empty, ["c"]).collect() == []
    nulls = spark.createDataFrame([(1, None)], "id long, c string")
    assert [tuple(r) for r in vocabulary.index_values(nulls, ["c"], "keep_null").collect()] == [(1, None)]
