"""Feature vectors and the column-wise preprocessor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import keep_present, require_columns
from plumbline.operators.clean import replace_in_place
from plumbline.operators.stages import (
    CategoryIndexer,
    ColumnAligner,
    DummyEncoder,
    FillModel,
    MedianImputer,
    StandardScale,
)
from plumbline.spec import FeatureSpec


def assemble_features(
    df: DataFrame, features: Sequence[str], label: str, output: str = "features"
) -> DataFrame:
    """Vector and label; rows with a missing feature are skipped."""
    require_columns(df, [*features, label])
    assembler = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")
    return assembler.transform(keep_present(df, features)).select(output, label)


def vector_to_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Unpack a vector into double columns where the vector stood."""
    values = vector_to_array(F.col(f"`{vector}`"))
    return replace_in_place(df, {vector: [values[i].alias(n) for i, n in enumerate(names)]})


def column_preprocessor(df: DataFrame, spec: FeatureSpec, fill: str = "missing") -> PipelineModel:
    """Median and z-score for numbers, fill and encode for categories.

    Remainder columns and the key pass through and the target is indexed
    alphabetically. Dummies carry the sorted value they stand for.
    """
    texts = {c: fill for c in (*spec.nominal, *spec.ordinal)}
    fitted = Pipeline(stages=[
        MedianImputer(inputCols=list(spec.numerical)),
        StandardScale(inputCols=list(spec.numerical)),
        FillModel(texts=texts),
        DummyEncoder(inputCols=list(spec.nominal)),
        CategoryIndexer(inputCols=list(spec.ordinal), onInvalid="keep_null"),
        CategoryIndexer(inputCols=[spec.target], onInvalid="error"),
    ]).fit(df)
    dummies = fitted.stages[3].output_columns()
    expected = [*spec.numerical, *dummies, *spec.ordinal, *spec.remainder]
    aligner = ColumnAligner(expected=expected, keep=[spec.key, spec.target])
    return PipelineModel([*fitted.stages, aligner])
