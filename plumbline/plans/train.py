"""Training on the prepared table, evaluation, and the scoring model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.evaluate import binary_metrics
from plumbline.operators.model import boosted_trees, fit_directly, grid_search, score, search_table, shared_family
from plumbline.operators.search import fold_table
from plumbline.plans.prepare import Preparation


@dataclass(frozen=True)
class Training:
    """Fitted model, its selection score, test metrics and (after a search) the score table."""

    model: PipelineModel
    score: float
    metrics: DataFrame
    searched: DataFrame | None = None


def train_and_evaluate(
    prepared: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    classifier: Estimator | None = None,
    grid: Mapping[str, Sequence[Any]] | None = None,
    folds: int = 5,
    scoring: str = "accuracy",
    table: DataFrame | None = None,
) -> Training:
    """Train on ``split = train``, evaluate on ``split = test``.

    With a grid: search with balancing inside each fold. Without: direct fit.
    """
    classifier = classifier if classifier is not None else boosted_trees()
    train = prepared.filter(F.col("split") == "train")
    test = prepared.filter(F.col("split") == "test").withColumn(target, F.col(target).cast("double"))
    searched = None
    if grid:
        search = grid_search(train, classifier, grid, features, target, key, folds, scoring, table=table)
        model, best = search.bestModel, max(search.avgMetrics)
        searched = search_table(prepared, type(classifier).__name__, search)
    else:
        model, best = fit_directly(train, classifier, features, target, key)
    return Training(model, best, binary_metrics(score(model, test), target), searched)


def compare_models(
    prepared: DataFrame,
    candidates: Mapping[str, tuple[Estimator, Mapping[str, Sequence[Any]]]],
    features: Sequence[str],
    target: str,
    key: str,
    folds: int = 6,
    scoring: str = "f1",
) -> DataFrame:
    """Best settings, cross-validation score and test metrics of each candidate."""
    out = table = None
    if any(shared_family(classifier, grid) for classifier, grid in candidates.values()):
        # one table of balanced folds for all families that are searched in shared passes
        table = fold_table(prepared.filter(F.col("split") == "train"), features, target, key, folds)
    for name, (classifier, grid) in candidates.items():
        result = train_and_evaluate(prepared, features, target, key, classifier, grid, folds, scoring, table)
        best = result.searched.filter("best").select("params", "cv_score").first()
        row = result.metrics.select(
            F.lit(name).alias("model"),
            F.lit(best["params"]).alias("params"),
            F.lit(best["cv_score"]).alias("cv_score"),
            "accuracy",
            "precision",
            "recall",
            "f1",
        )
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no candidates")
    return out


def scoring_model(prep: Preparation, model: PipelineModel) -> PipelineModel:
    """Preparation and model in one, for raw records without target."""
    return PipelineModel([*prep.features.stages, *model.stages])
