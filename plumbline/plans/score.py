"""Batch scoring job."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from plumbline.operators.model import score
from plumbline.operators.sample import sample_n


def batch_score(
    df: DataFrame,
    model: PipelineModel,
    key: str,
    sample_size: int | None = None,
    with_probability: bool = True,
    path: str | None = None,
) -> DataFrame:
    """Score a table (or a sample of it, when a size is given) and optionally write the result."""
    rows = sample_n(df, sample_size, key) if sample_size else df
    scored = score(model, rows)
    if not with_probability:
        scored = scored.drop("positive_probability", "confidence")
    if path:
        scored.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    return scored
