"""Preparation of a raw table: clean, remove outliers, encode, scale, split, write.

Fitting takes a handful of aggregations whatever the number of columns; all
fitted values end up in one ``PipelineModel`` that later scores batches and
streams with the same rules.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import clean_double, is_missing, keep_present, require_columns
from plumbline.functions.hashing import row_hash
from plumbline.functions.selection import below_cut, rank_cuts
from plumbline.operators.binning import bin_fixed
from plumbline.operators.clean import drop_blank, drop_missing
from plumbline.operators.outliers import Bounds, count_expression, fit_iqr
from plumbline.operators.sample import stratified_sizes
from plumbline.operators.stages import (
    MAX_DUMMIES,
    CategoryIndexerModel,
    ColumnAligner,
    DummyEncoderModel,
    FixedBinner,
    MinMaxScale,
    fit_categories,
)
from plumbline.sources.files import input_version, materialize, write_split
from plumbline.spec import FeatureSpec

FIT_SCOPES = ("train", "all")
METRICS = (
    "raw_rows bigint, missing_rows bigint, outliers_removed bigint, dataset_rows bigint, training_rows bigint, "
    "test_rows bigint, num_features int"
)


@dataclass(frozen=True)
class Preparation:
    """Everything learned from the raw table."""

    spec: FeatureSpec
    bounds: Mapping[str, Bounds]
    split: Column
    features: PipelineModel
    target: CategoryIndexerModel
    feature_columns: tuple[str, ...]
    labels: tuple[str, ...]


def clean_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Declared columns of rows without missing or blank values; numbers as double."""
    require_columns(df, spec.raw_columns)
    kept = drop_missing(df.select(*spec.raw_columns))
    if spec.critical:
        kept = drop_blank(kept, spec.critical)
    numbers = kept.withColumns({c: clean_double(kept, c) for c in spec.numerical})
    return keep_present(numbers, spec.numerical)


def _split_expression(df: DataFrame, spec: FeatureSpec) -> Column:
    h = row_hash([spec.key], spec.split.seed)
    stratum = F.col(f"`{spec.target}`") if spec.split.stratify else None

    def wanted(counts: Mapping) -> dict:
        return {s: [k] for s, k in stratified_sizes(counts, spec.split.test_size).items()}

    _, cuts = rank_cuts(df, h, wanted, stratum)
    in_test = below_cut(h, {s: c[0] for s, c in cuts.items()} or {None: 0}, stratum)
    return F.when(in_test, "test").otherwise("train")


def within_bounds(df: DataFrame, prep_bounds: Mapping[str, Bounds], spec: FeatureSpec) -> Column:
    return count_expression(df, prep_bounds) <= spec.max_outlier_columns


def fit_preparation(df: DataFrame, spec: FeatureSpec, fit_scope: str = "train") -> Preparation:
    """Learn bounds, split, categories and ranges.

    ``train`` splits first and learns from training rows only; ``all`` learns
    from every row and splits last, so test rows influence the fitted values.
    """
    if fit_scope not in FIT_SCOPES:
        raise ValueError(f"fit_scope must be one of {FIT_SCOPES}")
    clean = clean_rows(df, spec)
    if fit_scope == "train":
        split = _split_expression(clean, spec)
        learn = clean.filter(split == "train")
        bounds = fit_iqr(learn, spec.numerical)
        learn = learn.filter(within_bounds(learn, bounds, spec))
    else:
        bounds = fit_iqr(clean, spec.numerical)
        learn = clean.filter(within_bounds(clean, bounds, spec))
        split = _split_expression(learn, spec)

    stages = [FixedBinner(
        inputCol=spec.binned,
        edges=list(spec.bins.edges),
        labels=list(spec.bins.labels),
        nullLabel=spec.bins.null_label,
    )] if spec.binned else []
    binned = bin_fixed(learn, spec.binned, spec.bins) if spec.binned else learn
    found = fit_categories(binned, [*spec.nominal, *spec.ordinal, spec.target], MAX_DUMMIES)
    values = {c: [v for v, _ in counted] for c, counted in found.items()}
    dummies = DummyEncoderModel(categories=[[c, values[c]] for c in spec.nominal])
    ordinal = CategoryIndexerModel(labels=[[c, values[c]] for c in spec.ordinal], onInvalid="keep_null")
    scaler = MinMaxScale(inputCols=list(spec.numerical), dropInvalid=False).fit(learn)
    feature_columns = (*spec.remainder, *spec.numerical, *dummies.output_columns(), *spec.ordinal)
    return Preparation(
        spec=spec,
        bounds=bounds,
        split=split,
        features=PipelineModel([*stages, dummies, ordinal, scaler]),
        target=CategoryIndexerModel(labels=[[spec.target, values[spec.target]]], onInvalid="error"),
        feature_columns=feature_columns,
        labels=tuple(values[spec.target]),
    )


def align_features(prep: Preparation, *keep: str) -> ColumnAligner:
    return ColumnAligner(expected=list(prep.feature_columns), keep=list(keep))


def apply_preparation(df: DataFrame, prep: Preparation) -> DataFrame:
    """Key, features, target index and split of the rows that pass the filters."""
    spec = prep.spec
    clean = clean_rows(df, spec).withColumn("split", prep.split)
    kept = clean.filter(within_bounds(clean, prep.bounds, spec))
    prepared = prep.target.transform(prep.features.transform(kept))
    return prepared.select(
        spec.key, *[F.col(f"`{c}`") for c in prep.feature_columns], spec.target, "split"
    )


def prepare(df: DataFrame, spec: FeatureSpec, fit_scope: str = "train") -> DataFrame:
    """Fit and apply."""
    return apply_preparation(df, fit_preparation(df, spec, fit_scope))


def prepare_to_table(
    spark: SparkSession,
    df: DataFrame,
    spec: FeatureSpec,
    folder: str,
    fit_scope: str = "train",
    version: str | None = None,
) -> DataFrame:
    """Prepared table below ``folder``, one folder per split, rebuilt when settings or input change.

    The input is known by its files with their sizes and times, or by the
    ``version`` a caller gives. An input of neither is prepared anew each time.
    """
    known = version or input_version(df) or uuid.uuid4().hex
    path = f"{folder}/{spec.fingerprint()}-{fit_scope}-{known}"
    return materialize(spark, path, lambda: prepare(df, spec, fit_scope), "split")


def prepare_with_metrics(df: DataFrame, spec: FeatureSpec, path: str, fit_scope: str = "train") -> DataFrame:
    """Write the prepared table and return its metrics in one row.

    All counts are observed on the one pass that writes: raw and missing rows
    where the rows enter, rows per split where they leave.
    """
    prep = fit_preparation(df, spec, fit_scope)
    missing = F.lit(False)
    for c in spec.raw_columns:
        missing = missing | is_missing(df, c, blank=c == spec.critical)
    for c in spec.numerical:
        missing = missing | clean_double(df, c).isNull()
    entering, leaving = Observation(), Observation()
    raw = df.observe(entering, F.count(F.lit(1)).alias("raw_rows"), F.count_if(missing).alias("missing_rows"))
    prepared = apply_preparation(raw, prep).observe(
        leaving,
        F.count(F.lit(1)).alias("dataset_rows"),
        F.count_if(F.col("split") == "train").alias("training_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    write_split(prepared, path)
    seen = {k: int(v) for k, v in {**entering.get, **leaving.get}.items()}
    row = (
        seen["raw_rows"], seen["missing_rows"], seen["raw_rows"] - seen["missing_rows"] - seen["dataset_rows"],
        seen["dataset_rows"], seen["training_rows"], seen["test_rows"], len(prep.feature_columns),
    )
    return df.sparkSession.createDataFrame([row], METRICS)
