"""Outlier bounds, flags, filters and reports.

Bounds are fitted once into a handful of numbers; flags and filters are then
plain comparisons with literals, so they stay in the scan's codegen stage and
work on streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import clean_double, one_row_to_long, require_columns
from plumbline.functions.quantiles import exact_quantiles

IQR_FACTOR = 1.5
SIGMAS = 3.0


@dataclass(frozen=True)
class Bounds:
    """Fences of one column; ``None`` fences flag nothing."""

    low: float | None
    high: float | None
    q1: float | None = None
    q3: float | None = None


def fit_iqr(
    df: DataFrame,
    columns: Sequence[str],
    factor: float = IQR_FACTOR,
    relative_error: float = 0.0,
) -> dict[str, Bounds]:
    """Quartile fences per column, exact or with a rank error from one sketch pass."""
    require_columns(df, columns)
    if not columns:
        return {}
    if relative_error > 0:
        accuracy = F.lit(max(1, round(1.0 / relative_error)))
        row = df.agg(*[
            F.percentile_approx(clean_double(df, c), F.array(F.lit(0.25), F.lit(0.75)), accuracy).alias(c)
            for c in columns
        ]).first()
        quartiles = {c: row[c] or [None, None] for c in columns}
    else:
        quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    out = {}
    for c, (q1, q3) in quartiles.items():
        if q1 is None:
            out[c] = Bounds(None, None)
        else:
            reach = factor * (q3 - q1)
            out[c] = Bounds(q1 - reach, q3 + reach, q1, q3)
    return out


def fit_sigma(df: DataFrame, columns: Sequence[str], sigmas: float = SIGMAS) -> dict[str, Bounds]:
    """Mean plus/minus ``sigmas`` sample standard deviations per column."""
    require_columns(df, columns)
    if not columns:
        return {}
    row = df.agg(*[
        f(clean_double(df, c)).alias(f"{c}|{s}")
        for c in columns
        for f, s in ((F.avg, "mean"), (F.stddev_samp, "std"))
    ]).first()
    out = {}
    for c in columns:
        mean, std = row[f"{c}|mean"], row[f"{c}|std"]
        out[c] = Bounds(None, None) if std is None else Bounds(mean - sigmas * std, mean + sigmas * std)
    return out


def bounds_table(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    """The fitted numbers as a table, one row per column."""
    return df.sparkSession.createDataFrame(
        [(c, b.q1, b.q3, b.low, b.high) for c, b in bounds.items()],
        "column string, q1 double, q3 double, lower_bound double, upper_bound double",
    )


def is_outlier(value: Column, bounds: Bounds) -> Column:
    """Strictly outside the fences; null and open fences are never outliers."""
    if bounds.low is None:
        return F.lit(False)
    outside = (value < F.lit(bounds.low)) | (value > F.lit(bounds.high))
    return F.coalesce(outside, F.lit(False))


def count_expression(df: DataFrame, bounds: Mapping[str, Bounds]) -> Column:
    flags = [is_outlier(clean_double(df, c), b).cast("int") for c, b in bounds.items()]
    return reduce(lambda a, b: a + b, flags, F.lit(0))


def outlier_count(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    """Add ``outlier_count``: how many columns of the row lie outside."""
    return df.withColumn("outlier_count", count_expression(df, bounds))


def remove_outliers(df: DataFrame, bounds: Mapping[str, Bounds], min_outliers: int = 2) -> DataFrame:
    """Keep rows with fewer than ``min_outliers`` outlying columns."""
    return df.filter(count_expression(df, bounds) < min_outliers)


def outlier_report(df: DataFrame, bounds: Mapping[str, Bounds], digits: int = 3) -> DataFrame:
    """Per column: number of outliers and their fraction of all rows."""
    columns = list(bounds)
    row = df.agg(*[
        expr
        for c in columns
        for expr in (
            F.count_if(is_outlier(clean_double(df, c), bounds[c])).alias(f"{c}|n_outliers"),
            F.count(F.lit(1)).alias(f"{c}|n_rows"),
        )
    ])
    long = one_row_to_long(row, columns, ["n_outliers", "n_rows"])
    share = F.round(F.try_divide(F.col("n_outliers"), F.col("n_rows")), digits)
    return long.withColumn("fraction", share)
