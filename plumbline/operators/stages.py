"""Fitted preparation steps as ML stages made of plain column expressions.

Fitted values live in stage parameters, so a stage is saved and loaded with
the standard ML writer, inside a ``PipelineModel`` or alone, and transforms
batch tables and streams with the same expressions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import clean_double, keep_present, require_columns, to_long
from plumbline.operators.binning import bin_fixed
from plumbline.operators.clean import (
    align_columns,
    drop_blank,
    fill_values,
    median_fills,
    replace_in_place,
)
from plumbline.spec import TENURE_BINS, BinSpec

MAX_DUMMIES = 10_000
ON_INVALID = ("drop", "keep_null", "error")


class _Stage(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Parameters by keyword; defaults from the class attribute ``defaults``."""

    defaults: dict[str, Any] = {}

    def __init__(self, **values: Any) -> None:
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**values)

    def _get(self, name: str) -> Any:
        return self.getOrDefault(name)


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc)


def sql_text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def fit_categories(
    df: DataFrame, columns: Sequence[str], most: int | None = None
) -> dict[str, list[tuple[str, int]]]:
    """Sorted distinct non-null values with row counts, all columns in one job.

    The distinct set is built by a distributed aggregation. The values become
    part of a fitted stage, so the driver reads them; with ``most``, a column
    with more values is an error and nothing beyond that is read.
    """
    require_columns(df, columns)
    if not columns:
        return {}
    counted = (
        to_long(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    found = (counted if most is None else counted.limit(most * len(columns) + 1)).collect()
    out: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for row in found:
        out[row["column"]].append((row["value"], row["n"]))
    too_many = [c for c, values in out.items() if most is not None and len(values) > most]
    if too_many:
        raise ValueError(f"more than {most} categories in {too_many}")
    return {c: sorted(values) for c, values in out.items()}


def text_array(values: Sequence[str]) -> Column:
    """The values as one array literal, however many there are."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


class FixedBinner(_Stage, Transformer):
    """Replace a numeric column by its bin label."""

    inputCol = _param("inputCol", "column to bin")
    edges = _param("edges", "inclusive upper edges")
    labels = _param("labels", "one label more than edges")
    nullLabel = _param("nullLabel", "label of missing values")
    defaults = {
        "edges": list(TENURE_BINS.edges),
        "labels": list(TENURE_BINS.labels),
        "nullLabel": TENURE_BINS.null_label,
    }

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bins = BinSpec(tuple(self._get("edges")), tuple(self._get("labels")), self._get("nullLabel"))
        return bin_fixed(dataset, self._get("inputCol"), bins)


class DummyEncoder(_Stage, Estimator):
    """Learn the values of nominal columns; absent columns are skipped.

    Each value becomes a column, so more than ``maxDummies`` of one column are
    an error.
    """

    inputCols = _param("inputCols", "nominal columns")
    maxDummies = _param("maxDummies", "most values of one column")
    defaults = {"maxDummies": MAX_DUMMIES}

    def _fit(self, dataset: DataFrame) -> "DummyEncoderModel":
        present = [c for c in self._get("inputCols") if c in dataset.columns]
        found = fit_categories(dataset, present, self._get("maxDummies"))
        return DummyEncoderModel(categories=[[c, [v for v, _ in found[c]]] for c in present])


class DummyEncoderModel(_Stage, Model):
    """0/1 column ``{column}_{value}`` per learned value, sorted; source dropped."""

    categories = _param("categories", "[column, sorted values] pairs")
    defaults = {"categories": []}

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self._get("categories") for v in values]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dummies: dict[str, list[Column]] = {}
        for c, values in self._get("categories"):
            if c in dataset.columns:
                dummies[c] = [
                    F.expr(f"CAST(coalesce(CAST(`{c}` AS STRING) = {sql_text(v)}, false) AS INT)").alias(f"{c}_{v}")
                    for v in values
                ]
        return replace_in_place(dataset, dummies)


class CategoryIndexer(_Stage, Estimator):
    """Index values alphabetically, or in a given order."""

    inputCols = _param("inputCols", "columns to index")
    orders = _param("orders", "{column: values in order}; others are alphabetical")
    onInvalid = _param("onInvalid", "drop, keep_null or error for unseen values")
    defaults = {"orders": {}, "onInvalid": "drop"}

    def _fit(self, dataset: DataFrame) -> "CategoryIndexerModel":
        present = [c for c in self._get("inputCols") if c in dataset.columns]
        orders = self._get("orders")
        learned = [c for c in present if c not in orders]
        found = fit_categories(dataset, learned) if learned else {}
        labels = [[c, list(orders[c]) if c in orders else [v for v, _ in found[c]]] for c in present]
        return CategoryIndexerModel(labels=labels, onInvalid=self._get("onInvalid"))


class CategoryIndexerModel(_Stage, Model):
    """Replace values by their index as double.

    ``drop`` removes rows with unseen or missing values, ``keep_null`` keeps
    them with null, ``error`` fails on them.
    """

    labels = _param("labels", "[column, values in index order] pairs")
    onInvalid = _param("onInvalid", "drop, keep_null or error for unseen values")
    defaults = {"labels": [], "onInvalid": "drop"}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mode = self._get("onInvalid")
        if mode not in ON_INVALID:
            raise ValueError(f"onInvalid must be one of {ON_INVALID}")
        indexed: dict[str, list[Column]] = {}
        for c, values in self._get("labels"):
            if c not in dataset.columns:
                continue
            text = F.col(f"`{c}`").cast("string")
            position = F.array_position(text_array(values), text)
            index = F.when(position > 0, (position - 1).cast("double"))
            if mode == "error":
                message = F.concat(F.lit(f"unseen value in {c}: "), F.coalesce(text, F.lit("null")))
                index = F.when(index.isNull(), F.raise_error(message).cast("double")).otherwise(index)
            indexed[c] = [index.alias(c)]
        out = replace_in_place(dataset, indexed)
        return keep_present(out, list(indexed)) if mode == "drop" else out


class LabelDecoder(_Stage, Transformer):
    """Index back to value; unknown indexes give ``unknown``."""

    inputCol = _param("inputCol", "index column")
    outputCol = _param("outputCol", "value column")
    values = _param("values", "values in index order")
    unknown = _param("unknown", "value of unknown indexes")
    defaults = {"unknown": "Unknown"}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        index = F.col(f"`{self._get('inputCol')}`").cast("int")
        known = text_array(self._get("values"))
        found = F.when(index >= 0, F.get(known, index))
        return dataset.withColumn(self._get("outputCol"), F.coalesce(found, F.lit(self._get("unknown"))))


class _ScaleModel(_Stage, Model):
    """(value - shift) / scale for every column, in place."""

    columns = _param("columns", "[column, shift, scale] triples; scale 0 marks a constant column")
    constantValue = _param("constantValue", "result for constant columns")
    dropInvalid = _param("dropInvalid", "drop rows with a missing input")
    defaults = {"columns": [], "constantValue": 0.5, "dropInvalid": True}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        triples = self._get("columns")
        require_columns(dataset, [c for c, _, _ in triples])
        scaled = {}
        for c, shift, scale in triples:
            v = clean_double(dataset, c)
            if scale:
                scaled[c] = [((v - F.lit(shift)) / F.lit(scale)).alias(c)]
            else:
                scaled[c] = [F.when(v.isNotNull(), F.lit(self._get("constantValue"))).alias(c)]
        out = replace_in_place(dataset, scaled)
        return keep_present(out, list(scaled)) if self._get("dropInvalid") else out


class MinMaxModel(_ScaleModel):
    """Fitted min-max scaling to [0, 1]."""


class StandardModel(_ScaleModel):
    """Fitted z-score with the population standard deviation."""

    defaults = {**_ScaleModel.defaults, "constantValue": 0.0, "dropInvalid": False}


def _complete_rows(dataset: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = dataset.select(*[clean_double(dataset, c).alias(c) for c in columns])
    return keep_present(values, columns)


class MinMaxScale(_Stage, Estimator):
    """Learn minimum and maximum of complete rows, all columns in one job."""

    inputCols = _param("inputCols", "columns to scale")
    constantValue = _param("constantValue", "result for constant columns")
    dropInvalid = _param("dropInvalid", "drop rows with a missing input")
    defaults = {"constantValue": 0.5, "dropInvalid": True}

    def _fit(self, dataset: DataFrame) -> MinMaxModel:
        columns = list(self._get("inputCols"))
        require_columns(dataset, columns)
        triples = []
        if columns:
            row = _complete_rows(dataset, columns).agg(*[
                f(f"`{c}`").alias(f"{c}|{s}") for c in columns for f, s in ((F.min, "min"), (F.max, "max"))
            ]).first()
            for c in columns:
                low, high = row[f"{c}|min"], row[f"{c}|max"]
                triples.append([c, low or 0.0, (high - low) if low is not None else 0.0])
        return MinMaxModel(
            columns=triples,
            constantValue=self._get("constantValue"),
            dropInvalid=self._get("dropInvalid"),
        )


class StandardScale(_Stage, Estimator):
    """Learn mean and population standard deviation, all columns in one job."""

    inputCols = _param("inputCols", "columns to scale")

    def _fit(self, dataset: DataFrame) -> StandardModel:
        columns = list(self._get("inputCols"))
        require_columns(dataset, columns)
        if not columns:
            return StandardModel()
        row = dataset.agg(*[
            f(clean_double(dataset, c)).alias(f"{c}|{s}")
            for c in columns
            for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))
        ]).first()
        return StandardModel(columns=[
            [c, row[f"{c}|mean"] or 0.0, row[f"{c}|std"] or 0.0] for c in columns
        ])


class MedianImputer(_Stage, Estimator):
    """Learn exact medians."""

    inputCols = _param("inputCols", "numeric columns")

    def _fit(self, dataset: DataFrame) -> "FillModel":
        return FillModel(numbers=median_fills(dataset, self._get("inputCols")))


class FillModel(_Stage, Model):
    """Fill missing numbers and missing text with learned or given values."""

    numbers = _param("numbers", "{column: number}")
    texts = _param("texts", "{column: text}")
    defaults = {"numbers": {}, "texts": {}}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers: Mapping[str, float] = self._get("numbers")
        texts: Mapping[str, str] = self._get("texts")
        out = fill_values(dataset, {c: v for c, v in numbers.items() if c in dataset.columns})
        return out.fillna({c: v for c, v in texts.items() if c in out.columns}) if texts else out


class RowFilter(_Stage, Transformer):
    """Drop rows with missing values, and rows whose critical column is blank."""

    inputCols = _param("inputCols", "columns that must be present")
    criticalCol = _param("criticalCol", "column that must not be blank")
    defaults = {"inputCols": [], "criticalCol": None}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = keep_present(dataset, self._get("inputCols"))
        critical = self._get("criticalCol")
        return drop_blank(out, critical) if critical else out


class ColumnAligner(_Stage, Transformer):
    """Exactly the expected columns, absent ones filled with 0, plus kept columns."""

    expected = _param("expected", "feature columns in model order")
    keep = _param("keep", "further columns to keep when present")
    fill = _param("fill", "value of absent columns")
    defaults = {"expected": [], "keep": [], "fill": 0}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in self._get("keep") if c in dataset.columns]
        return align_columns(dataset, [*kept, *self._get("expected")], self._get("fill"))
