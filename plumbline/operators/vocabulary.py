"""Category indexes of columns with many values: the fitted dictionary is a table.

The indexers of :mod:`plumbline.operators.stages` hold their labels as literals,
which suits some thousands. Here the labels are ranked by Spark, stay in a table
in the shared folder, and are applied by a join whose frequent values are served
by broadcast, so neither the driver nor a task ever holds a vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import keep_present, require_columns, to_long
from plumbline.functions.joins import join_back
from plumbline.functions.ranks import rank_rows
from plumbline.operators.stages import ON_INVALID
from plumbline.sources.scratch import materialize_once, new_path

SCHEMA = "column string, value string, index double, n bigint"


def fit_vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, index, n``: alphabetical index from 0 and row count of every non-null value, all columns in one job."""
    require_columns(df, columns)
    counted = (
        to_long(df, columns).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    ranked = rank_rows(counted, ["value"], "rank", by="column")
    return ranked.select("column", "value", F.col("rank").cast("double").alias("index"), "n")


class _Settings(Params, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "columns to index")
    onInvalid = Param(Params._dummy(), "onInvalid", "drop, keep_null or error for unseen values")
    path = Param(Params._dummy(), "path", "table of the fitted dictionary")

    def __init__(self, **values) -> None:
        super().__init__()
        self._setDefault(onInvalid="drop")
        self._set(**values)

    def _get(self, name: str):
        return self.getOrDefault(name)


class VocabularyIndexer(_Settings, Estimator):
    """Index values alphabetically, however many there are; the dictionary is written to ``path`` (a new shared path by default)."""

    def _fit(self, dataset: DataFrame) -> "VocabularyIndexerModel":
        present = [c for c in self._get("inputCols") if c in dataset.columns]
        path = self._get("path") if self.isDefined("path") else new_path(dataset.sparkSession, "vocabulary")
        fit_vocabulary(dataset, present).write.parquet(path)
        return VocabularyIndexerModel(inputCols=present, onInvalid=self._get("onInvalid"), path=path)


class VocabularyIndexerModel(_Settings, Model):
    """Replaces values by their index as double, by a join with the dictionary.

    ``drop`` removes rows with unseen or missing values, ``keep_null`` keeps them
    with null, ``error`` fails on them. The order of rows is not kept.
    """

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(self._get("path"))

    def sizes(self, spark: SparkSession) -> dict[str, int]:
        """Number of values per column."""
        found = {r[0]: r[1] for r in self.vocabulary(spark).groupBy("column").count().collect()}
        return {c: found.get(c, 0) for c in self._get("inputCols")}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mode = self._get("onInvalid")
        if mode not in ON_INVALID:
            raise ValueError(f"onInvalid must be one of {ON_INVALID}")
        known = self.vocabulary(dataset.sparkSession)
        totals = {r[0]: r[1] for r in known.groupBy("column").agg(F.sum("n")).collect()}
        out, names = dataset, dataset.columns
        for c in [c for c in self._get("inputCols") if c in names]:
            text = F.col(f"`{c}`").cast("string")
            # a missing value is no key; it is marked so that it meets nothing
            keyed = out.withColumns({"__value": F.coalesce(text, F.lit("")), "__missing": text.isNull()})
            words = known.where(F.col("column") == c).select(F.col("value").alias("__value"), F.lit(False).alias("__missing"), F.col("index").alias("__index"), "n")
            spread = F.struct(*[F.col(f"`{x}`").cast("string") for x in names])
            found = join_back(keyed, words, ["__value", "__missing"], ["__index"], F.col("n"), totals.get(c, 0), spread)
            index: Column = F.col("__index")
            if mode == "error":
                message = F.concat(F.lit(f"unseen value in {c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")))
                index = F.when(index.isNull(), F.raise_error(message).cast("double")).otherwise(index)
            out = found.select(*[index.alias(c) if x == c else F.col(f"`{x}`") for x in names])
        return keep_present(out, [c for c in self._get("inputCols") if c in names]) if mode == "drop" else out

    def decode(self, df: DataFrame, index_col: str, output_col: str, column: str, unknown: str = "Unknown") -> DataFrame:
        """Index of ``column`` back to its value; unknown indexes give ``unknown``."""
        known = self.vocabulary(df.sparkSession).where(F.col("column") == column)
        total = known.agg(F.sum("n")).first()[0] or 0
        keyed = df.withColumn("__index", F.coalesce(F.col(f"`{index_col}`").cast("double"), F.lit(-1.0)))
        words = known.select(F.col("index").alias("__index"), F.col("value").alias("__value"), "n")
        spread = F.struct(*[F.col(f"`{x}`").cast("string") for x in df.columns])
        found = join_back(keyed, words, ["__index"], ["__value"], F.col("n"), total, spread)
        return found.withColumn(output_col, F.coalesce("__value", F.lit(unknown))).drop("__index", "__value")


class SparseDummies(_Settings, Transformer):
    """A sparse 0/1 vector ``{column}_vec`` for every indexed column, as wide as its vocabulary; a null index gives no entry."""

    def __init__(self, model: VocabularyIndexerModel | None = None, **values) -> None:
        super().__init__(**values)
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, n in self.model.sizes(dataset.sparkSession).items():
            # the encoder reads the width from the column's metadata, so that it needs no pass over the rows
            attribute = {"ml_attr": {"type": "nominal", "num_vals": max(n, 1)}}
            marked = out.withColumn("__at", F.coalesce(F.col(f"`{c}`"), F.lit(float(n))))
            marked = marked.withMetadata("__at", attribute)
            encoder = OneHotEncoder(inputCols=["__at"], outputCols=[f"{c}_vec"], dropLast=True, handleInvalid="keep")
            out = encoder.fit(marked).transform(marked).drop("__at")
        return out


def index_values(df: DataFrame, columns: Sequence[str], on_invalid: str = "drop") -> DataFrame:
    """Fit on the table and apply to it."""
    rows = materialize_once(df, "to-index")
    return VocabularyIndexer(inputCols=list(columns), onInvalid=on_invalid).fit(rows).transform(rows)
