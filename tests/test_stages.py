from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plumbline.operators import features, stages
from plumbline.spec import FeatureSpec


def test_dummies_are_sorted_and_null_is_all_zero(spark):
    df = spark.createDataFrame([(1, "it's"), (2, "a b"), (3, None), (4, "a\\b")], "id int, c string")
    model = stages.DummyEncoder(inputCols=["c", "absent"]).fit(df)
    assert model.output_columns() == ["c_a b", "c_a\\b", "c_it's"]
    rows = [tuple(r) for r in model.transform(df).orderBy("id").collect()]
    assert rows == [(1, 0, 0, 1), (2, 1, 0, 0), (3, 0, 0, 0), (4, 0, 1, 0)]


def test_dummies_reject_unbounded_columns(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 10 categories"):
        stages.DummyEncoder(inputCols=["c"], maxDummies=10).fit(df)


def test_indexer_takes_any_number_of_labels(spark):
    df = spark.range(20_000).select(F.format_string("v%06d", "id").alias("c"), "id")
    got = stages.CategoryIndexer(inputCols=["c"]).fit(df).transform(df)
    assert got.filter("c != id").count() == 0 and got.count() == 20_000


def test_stages_without_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, c string")
    for stage in (stages.MedianImputer(inputCols=[]), stages.StandardScale(inputCols=[]), stages.MinMaxScale(inputCols=[]), stages.DummyEncoder(inputCols=[])):
        assert stage.fit(df).transform(df).collect() == df.collect()


def test_indexer_modes(spark):
    train = spark.createDataFrame([("b",), ("a",)], "c string")
    seen = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, c string")

    def run(mode):
        model = stages.CategoryIndexer(inputCols=["c"], onInvalid=mode).fit(train)
        return [tuple(r) for r in model.transform(seen).orderBy("id").collect()]

    assert run("drop") == [(1, 0.0)]
    assert run("keep_null") == [(1, 0.0), (2, None), (3, None)]
    with pytest.raises(Exception, match="unseen value in c"):
        run("error")
    with pytest.raises(ValueError):
        run("other")


def test_alphabetical_bins(spark):
    df = spark.createDataFrame([("Newer",), ("Medium",), ("Long-term",)], "b string")
    out = stages.CategoryIndexer(inputCols=["b"]).fit(df).transform(df)
    assert [r.b for r in out.collect()] == [2.0, 1.0, 0.0]


def test_decoder(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (-1.0,), (None,)], "p double")
    out = stages.LabelDecoder(inputCol="p", outputCol="v", values=["No", "Yes"]).transform(df)
    assert [r.v for r in out.collect()] == ["No", "Yes", "Unknown", "Unknown", "Unknown"]


def test_minmax_rules(spark):
    df = spark.createDataFrame([(0.0, 3.0), (5.0, 3.0), (10.0, 3.0), (None, 3.0), (99.0, float("nan"))], "a double, b double")
    model = stages.MinMaxScale(inputCols=["a", "b"]).fit(df)
    assert [tuple(r) for r in model.transform(df).orderBy("a").collect()] == [(0.0, 0.5), (0.5, 0.5), (1.0, 0.5)]
    zero = stages.MinMaxScale(inputCols=["b"], constantValue=0.0).fit(df).transform(df.limit(1))
    assert zero.first().b == 0.0
    with pytest.raises(ValueError, match="columns not found"):
        stages.MinMaxScale(inputCols=["x"]).fit(df)
    assert stages.MinMaxScale(inputCols=[]).fit(df).transform(df).columns == ["a", "b"]


def test_standard_scale_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    out = stages.StandardScale(inputCols=["a"]).fit(df).transform(df)
    assert [r.a for r in out.collect()] == [-1.0, 1.0]


def test_vectors_skip_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (None, 1.0, 1), (3.0, float("nan"), 1)], "a double, b double, y int")
    vec = features.assemble_features(df, ["a", "b"], "y")
    assert vec.columns == ["features", "y"]
    back = features.vector_to_columns(vec, "features", ["a", "b"])
    assert [tuple(r) for r in back.collect()] == [(1.0, 2.0, 0)]


def test_preprocessor_names_dummies_by_their_value(spark):
    rows = [("k1", "z", 1.0, 3, 0, "No"), ("k2", "a", None, 20, 1, "Yes"), ("k3", None, 3.0, 60, 0, "No")]
    df = spark.createDataFrame(rows, "k string, c string, x double, tenure int, s int, y string")
    df = stages.FixedBinner(inputCol="tenure").transform(df)
    spec = FeatureSpec(key="k", target="y", nominal=("c",), numerical=("x",), binned="tenure", remainder=("s",))
    out = features.column_preprocessor(df, spec).transform(df).orderBy("k")
    assert out.columns == ["k", "y", "x", "c_a", "c_missing", "c_z", "tenure_bins", "s"]
    assert tuple(out.first())[:2] == ("k1", 0.0) and out.first()["c_z"] == 1
    assert out.collect()[1]["x"] == 0.0 and out.collect()[2]["c_missing"] == 1


def test_stages_survive_saving_and_run_on_streams(spark, tmp_path):
    df = spark.createDataFrame([("a", 5, 1.0, "No"), ("b", 30, 2.0, "Yes"), ("a", 70, 4.0, "No")], "c string, tenure int, x double, y string")
    binner = stages.FixedBinner(inputCol="tenure")
    model = PipelineModel([
        stages.RowFilter(inputCols=["x"], criticalCol="c"),
        binner,
        stages.DummyEncoder(inputCols=["c"]).fit(df),
        stages.CategoryIndexer(inputCols=["tenure_bins"]).fit(binner.transform(df)),
        stages.CategoryIndexer(inputCols=["y"], onInvalid="error").fit(df),
        stages.MedianImputer(inputCols=["x"]).fit(df),
        stages.MinMaxScale(inputCols=["x"]).fit(df),
    ])
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    want = sorted(tuple(r) for r in model.transform(df).collect())
    assert sorted(tuple(r) for r in loaded.transform(df).collect()) == want
    df.write.parquet(str(tmp_path / "in"))
    stream = loaded.transform(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    query = (
        stream.writeStream.format("memory").queryName("stage_stream")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("stage_stream").collect()) == want
