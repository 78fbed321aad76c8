"""Classifiers, balanced training, grid search and model comparison."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Any

from pyspark import SparkContext, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import keep_present
from plumbline.functions.hashing import DRAW_DIGITS, DRAW_SPAN, digest, hex_number
from plumbline.operators.balance import NEIGHBOURS, class_counts, smote
from plumbline.operators.sample import assign_folds
from plumbline.operators.search import LOGISTIC, SUPPORTED, TREE, all_rows, fold_table, shared_search
from plumbline.sources.scratch import materialize_once

SEED = 42

# Default settings of the two tree ensembles.
FOREST_DEFAULTS = {"maxDepth": 10, "numTrees": 100, "minInstancesPerNode": 1, "seed": SEED}
BOOSTER_DEFAULTS = {"maxDepth": 10, "maxIter": 100, "seed": SEED}

# Search grids.
BOOSTER_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [5, 10],
    "stepSize": [0.01, 0.1, 0.2],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "1.0"],
    "seed": [42],
}
LOGISTIC_GRID = {"maxIter": [1000, 5000], "C": [0.1, 1.0, 10.0]}
TREE_GRID = {
    "maxDepth": [5, 8, 10],
    "minInstancesPerNode": [2, 5, 10],
    "impurity": ["gini", "entropy"],
}
FOREST_GRID = {
    "numTrees": [100, 200],
    "maxDepth": [8, 10, 12],
    "minInstancesPerNode": [2, 5, 10],
    "classWeight": ["balanced", "balanced_subsample", None],
}


def random_forest(**settings: Any) -> RandomForestClassifier:
    return RandomForestClassifier(**{**FOREST_DEFAULTS, **settings})


def boosted_trees(**settings: Any) -> GBTClassifier:
    return GBTClassifier(**{**BOOSTER_DEFAULTS, **settings})


def decision_tree(**settings: Any) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**{"seed": SEED, **settings})


class LogisticOnSums(LogisticRegression):
    """Logistic regression whose ``regParam`` weighs against the sum of the losses.

    Spark penalises their mean, so the penalty is divided by the number (or the
    weights) of the rows that are fitted, whatever they are.
    """

    def _fit(self, dataset: DataFrame) -> Model:
        weighted = self.isDefined(self.weightCol) and self.getWeightCol()
        rows = dataset.agg(F.sum(self.getWeightCol()) if weighted else F.count("*")).first()[0] or 1
        return LogisticRegression._fit(self.copy({self.regParam: self.getRegParam() / rows}), dataset)


def logistic_regression(C: float = 1.0, **settings: Any) -> LogisticRegression:
    """L2 penalty given as inverse strength ``C`` on the sum of losses."""
    return LogisticOnSums(**{"regParam": 1.0 / C, "elasticNetParam": 0.0, "standardization": False, **settings})


BUILDERS: dict[str, Callable[..., Estimator]] = {
    "random_forest": random_forest,
    "boosted_trees": boosted_trees,
    "decision_tree": decision_tree,
    "logistic_regression": logistic_regression,
}


CLASS_WEIGHT = "class_weight"
UNIT_WEIGHT = "unit_weight"
SUBSAMPLE_WEIGHT = "balanced_subsample"
ROW_KEY = "row_key"
TREE_WEIGHT = "tree_weight"
# chances that a Poisson number of mean 1 is 0, 1 at most, 2 at most ...
POISSON = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(13)))


def add_class_weight(df: DataFrame, label: str) -> DataFrame:
    """``class_weight`` = ``n / (classes * n_class)`` and ``unit_weight`` = 1."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    weight: Column = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == F.lit(value), total / (len(counts) * n)).otherwise(weight)
    return df.withColumns({CLASS_WEIGHT: weight, UNIT_WEIGHT: F.lit(1.0)})


def poisson_draws(key: Column, trees: int, seed: int = SEED) -> Column:
    """How often each tree's bootstrap takes the row: Poisson numbers of mean 1 from the digest of seed, key and tree."""
    cumulated = F.array(*[F.lit(c) for c in POISSON])

    def draw(tree: Column) -> Column:
        u = hex_number(digest(seed, [key], tree), 1, DRAW_DIGITS) / F.lit(float(DRAW_SPAN))
        return F.size(F.filter(cumulated, lambda c: u >= c))

    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), draw)


def subsample_weights(rows: DataFrame, label: str, trees: int, seed: int = SEED) -> tuple[DataFrame, list[dict[Any, float]]]:
    """Rows with their ``draws``, and for every tree the weight of each class: ``n / (classes * n_class)`` in the tree's own sample.

    One aggregate serves all trees.
    """
    drawn = materialize_once(rows.withColumn("draws", poisson_draws(F.col(ROW_KEY), trees, seed)), "draws")
    sums = drawn.groupBy(label).agg(F.array(*[F.sum(F.get("draws", F.lit(t))) for t in range(trees)]).alias("n")).collect()
    weights = []
    for t in range(trees):
        n = {r[label]: r["n"][t] for r in sums if r["n"][t]}
        weights.append({value: sum(n.values()) / (len(n) * k) for value, k in n.items()})
    return drawn, weights


def subsample_forest(classifier: RandomForestClassifier, rows: DataFrame, label: str, parallelism: int = 4) -> RandomForestClassificationModel:
    """A forest whose classes are balanced anew in the bootstrap sample of every tree."""
    trees, seed = classifier.getNumTrees(), classifier.getSeed()
    drawn, weights = subsample_weights(rows, label, trees, seed)
    subset = classifier.getFeatureSubsetStrategy()
    single = classifier.copy({
        classifier.numTrees: 1, classifier.bootstrap: False, classifier.weightCol: TREE_WEIGHT, classifier.labelCol: label,
        classifier.featureSubsetStrategy: "sqrt" if subset == "auto" else subset,
    })

    def grow(t: int) -> RandomForestClassificationModel:
        weight = F.lit(0.0)
        for value, w in weights[t].items():
            weight = F.when(F.col(label) == F.lit(value), F.get("draws", F.lit(t)) * F.lit(w)).otherwise(weight)
        sample = drawn.withColumn(TREE_WEIGHT, weight).filter(F.col(TREE_WEIGHT) > 0)
        return single.copy({single.seed: seed + t}).fit(sample)

    with ThreadPool(parallelism) as pool:
        grown = pool.map(inheritable_thread_target(rows.sparkSession)(grow), range(trees))
    context = rows.sparkSession.sparkContext
    package = context._jvm.org.apache.spark.ml.classification
    array = context._gateway.new_array(package.DecisionTreeClassificationModel, trees)
    for t, one in enumerate(grown):
        array[t] = one._java_obj.trees()[0]
    name = RandomForestClassifier._randomUID()
    whole = package.RandomForestClassificationModel(name, array, grown[0].numFeatures, max(m.numClasses for m in grown))
    whole.set(whole.getParam("numTrees"), trees)
    return RandomForestClassificationModel(whole).setFeaturesCol(classifier.getFeaturesCol())


def without_summary(fitted: Model) -> Model:
    """The fitted model without the summary of its training.

    The summary holds the session, which goes to the tasks with the model that
    scores; a session that has observed metrics cannot be sent.
    """
    if getattr(fitted, "hasSummary", False):
        fitted._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return fitted


class _Fits:
    """Thread-safe iterator of ``(index, model)``; ``done`` runs after the last fit."""

    def __init__(self, fit: Callable[[int], Any], n: int, done: Callable[[], Any]) -> None:
        self._fit, self._n, self._done = fit, n, done
        self._next = self._finished = 0
        self._lock = Lock()

    def __iter__(self) -> "_Fits":
        return self

    def __next__(self) -> tuple[int, Any]:
        with self._lock:
            if self._next >= self._n:
                raise StopIteration
            i, self._next = self._next, self._next + 1
        try:
            return i, self._fit(i)
        finally:
            with self._lock:
                self._finished += 1
                if self._finished == self._n:
                    self._done()


class BalancedClassifier(Estimator):
    """Balance the training rows, then fit the classifier on them.

    Balancing happens in ``fit`` only, so in cross validation the held-out fold
    and later the scored rows keep their own distribution. All settings of a
    grid share one balanced table per fold.
    """

    @keyword_only
    def __init__(
        self,
        *,
        classifier: Estimator,
        features: Sequence[str],
        label: str,
        key: str,
        balance: bool = True,
        weighted: bool = False,
        k: int = NEIGHBOURS,
        seed: int = SEED,
    ) -> None:
        super().__init__()
        self.settings = dict(self._input_kwargs)
        self.classifier = classifier
        self.features = list(features)
        self.label = label
        self.key = key
        self.balance = balance
        self.weighted = weighted
        self.k = k
        self.seed = seed

    def copy(self, extra: Mapping | None = None) -> "BalancedClassifier":
        return BalancedClassifier(**{**self.settings, "classifier": self.classifier.copy(extra or {})})

    def _assembler(self) -> VectorAssembler:
        return VectorAssembler(inputCols=self.features, outputCol="features", handleInvalid="keep")

    def training_rows(self, dataset: DataFrame) -> DataFrame:
        rows = keep_present(dataset, self.features)
        if self.balance:
            # a fit reads its rows many times
            rows = materialize_once(smote(rows, self.features, self.label, self.key, self.k, self.seed), "balanced")
        if self.weighted:
            draw = F.col("draw") if self.balance else F.lit(0)
            rows = rows.withColumn(ROW_KEY, F.concat_ws("|", F.col(f"`{self.key}`").cast("string"), draw.cast("string")))
            rows = add_class_weight(rows.select(ROW_KEY, *self.features, self.label), self.label)
        else:
            rows = rows.select(*self.features, self.label)
        assembled = self._assembler().transform(rows).drop(*self.features)
        return assembled.withColumn(self.label, F.col(self.label).cast("double"))

    def _train(self, classifier: Estimator, rows: DataFrame) -> PipelineModel:
        weighted = classifier.hasParam("weightCol") and classifier.isDefined("weightCol") and classifier.getWeightCol()
        if weighted == SUBSAMPLE_WEIGHT:
            fitted = subsample_forest(classifier, rows, self.label)
        else:
            fitted = without_summary(classifier.copy({classifier.labelCol: self.label}).fit(rows))
        return PipelineModel([self._assembler(), fitted])

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return self._train(self.classifier, self.training_rows(dataset))

    def fit_balanced(self, rows: DataFrame) -> PipelineModel:
        """Fit on rows that are balanced already."""
        return self._train(self.classifier, self._assembler().transform(rows).drop(*self.features))

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> _Fits:
        rows = self.training_rows(dataset).persist()
        maps = list(paramMaps)
        return _Fits(lambda i: self._train(self.classifier.copy(maps[i]), rows), len(maps), rows.unpersist)


def param_grid(classifier: Estimator, grid: Mapping[str, Sequence[Any]]) -> list[dict]:
    """Every combination of the grid as parameter maps of the classifier.

    ``C`` becomes the matching penalty, ``classWeight`` chooses the weight
    column; ``balanced_subsample`` balances in every tree's own sample.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        if name == "C":
            builder.addGrid(classifier.regParam, [1.0 / c for c in values])
        elif name == "classWeight":
            columns = [{None: UNIT_WEIGHT, "balanced": CLASS_WEIGHT, "balanced_subsample": SUBSAMPLE_WEIGHT}[v] for v in values]
            builder.addGrid(classifier.weightCol, list(dict.fromkeys(columns)))
        else:
            builder.addGrid(classifier.getParam(name), list(values))
    return builder.build()


def evaluator(scoring: str, label: str) -> MulticlassClassificationEvaluator:
    """``accuracy``, or ``f1`` of class 1."""
    if scoring == "f1":
        return MulticlassClassificationEvaluator(
            labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0
        )
    return MulticlassClassificationEvaluator(labelCol=label, metricName=scoring)


@dataclass(frozen=True)
class Search:
    """Settings of a grid with their cross-validated scores, and the best one fitted on all rows."""

    params: list[str]
    avgMetrics: list[float]
    bestModel: PipelineModel


def shared_family(classifier: Estimator, grid: Mapping[str, Sequence[Any]]) -> str | None:
    """The family whose settings advance in shared passes, if this classifier and grid belong to one."""
    if isinstance(classifier, LogisticOnSums):
        plain = not classifier.getStandardization() and not classifier.getElasticNetParam() and classifier.getFitIntercept()
        return LOGISTIC if plain and set(grid) <= SUPPORTED[LOGISTIC] else None
    if isinstance(classifier, DecisionTreeClassifier) and set(grid) <= SUPPORTED[TREE]:
        return TREE
    return None


def grid_search(
    df: DataFrame,
    classifier: Estimator,
    grid: Mapping[str, Sequence[Any]],
    features: Sequence[str],
    label: str,
    key: str,
    folds: int = 5,
    scoring: str = "accuracy",
    balance: bool = True,
    parallelism: int = 4,
    seed: int = SEED,
    table: DataFrame | None = None,
) -> Search:
    """Exhaustive search with stratified folds, balancing inside each training
    fold, and a final fit of the best settings on all rows.

    Logistic regressions and decision trees advance all settings and folds in
    the same passes over one table, which a caller may share between them
    (``table`` from :func:`fold_table` with the same arguments); other models
    fit one by one."""
    family = shared_family(classifier, grid)
    estimator = BalancedClassifier(
        classifier=classifier,
        features=list(features),
        label=label,
        key=key,
        balance=balance,
        weighted="classWeight" in grid,
        seed=seed,
    )
    if family:
        own = {"C": 1.0 / classifier.getRegParam(), "maxIter": classifier.getMaxIter()} if family == LOGISTIC else {
            "maxDepth": classifier.getMaxDepth(), "minInstancesPerNode": classifier.getMinInstancesPerNode(), "impurity": classifier.getImpurity(),
        }
        table = fold_table(df, features, label, key, folds, balance, seed=seed) if table is None else table
        grid_of_all = {**{k: [v] for k, v in own.items()}, **grid}
        settings, scores = shared_search(df, family, grid_of_all, features, label, key, folds, scoring, balance, seed, table)
        best = settings[scores.index(max(scores))]
        chosen = {classifier.regParam if k == "C" else classifier.getParam(k): 1.0 / v if k == "C" else v for k, v in best.items()}
        model = estimator.copy(chosen).fit_balanced(all_rows(table, features, label))
        names = [", ".join(f"{'regParam' if k == 'C' else k}={1.0 / s[k] if k == 'C' else s[k]}" for k in sorted(grid, key=lambda k: "regParam" if k == "C" else k)) for s in settings]
        return Search(names, scores, model)
    folded = assign_folds(keep_present(df, features), key, label, folds, seed)
    folded = folded.withColumn(label, F.col(label).cast("double"))
    found = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_grid(classifier, grid),
        evaluator=evaluator(scoring, label),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(folded)
    names = [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)) for m in found.getEstimatorParamMaps()]
    return Search(names, list(found.avgMetrics), found.bestModel)


def search_table(df: DataFrame, name: str, search: Search) -> DataFrame:
    """One row per setting: model, parameters, mean score, and the best mark."""
    best = search.avgMetrics.index(max(search.avgMetrics))
    rows = [(name, text, float(s), i == best) for i, (text, s) in enumerate(zip(search.params, search.avgMetrics, strict=True))]
    return df.sparkSession.createDataFrame(rows, "model string, params string, cv_score double, best boolean")


def fit_directly(
    df: DataFrame, classifier: Estimator, features: Sequence[str], label: str, key: str
) -> tuple[PipelineModel, float]:
    """Fit without balancing; the score is the accuracy on the training rows."""
    model = BalancedClassifier(
        classifier=classifier, features=features, label=label, key=key, balance=False
    ).fit(df)
    scored = model.transform(df.withColumn(label, F.col(label).cast("double")))
    return model, evaluator("accuracy", label).evaluate(scored)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``, ``positive_probability`` and ``confidence`` (largest class probability).

    Every row comes back once. Trees take missing features; where a model's
    probability is no number, all three are null.
    """
    probabilities = vector_to_array(F.col("probability"))
    usable = ~F.exists(probabilities, F.isnan)
    return (
        model.transform(df)
        .withColumn("prediction", F.when(usable, F.col("prediction")))
        .withColumn("positive_probability", F.when(usable, F.get(probabilities, F.lit(1))))
        .withColumn("confidence", F.when(usable, F.array_max(probabilities)))
        .drop("features", "rawPrediction", "probability")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
