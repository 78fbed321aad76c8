"""Profiles: missing values, column statistics, frequencies, correlation, shapes.

Every profile is one aggregation over all columns, not one job per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import (
    clean_double,
    is_absent,
    is_missing,
    numeric_columns,
    one_row_to_long,
    require_columns,
    to_long,
)
from plumbline.functions.quantiles import exact_quantiles
from plumbline.operators.outliers import IQR_FACTOR


TOP_BLOCKS = 64


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, without and with white-space-only text."""
    names = list(columns or df.columns)
    require_columns(df, names)
    row = df.agg(*[
        F.count_if(is_missing(df, c, blank)).alias(f"{c}|{s}")
        for c in names
        for blank, s in ((False, "missing"), (True, "missing_or_blank"))
    ])
    return one_row_to_long(row, names, ["missing", "missing_or_blank"])


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, moments, range and exact quartiles of numeric columns."""
    require_columns(df, columns)
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    stats = ["null_count", "null_percentage", "mean", "stddev", "min", "max", "q1", "median", "q3"]
    aggs = []
    for c in columns:
        v = clean_double(df, c)
        nulls = F.count_if(is_absent(df, c))
        aggs += [
            nulls.alias(f"{c}|null_count"),
            (F.try_divide(nulls, F.count(F.lit(1))) * 100).alias(f"{c}|null_percentage"),
            F.avg(v).alias(f"{c}|mean"),
            F.stddev_samp(v).alias(f"{c}|stddev"),
            F.min(v).alias(f"{c}|min"),
            F.max(v).alias(f"{c}|max"),
            *[
                F.lit(q).cast("double").alias(f"{c}|{s}")
                for q, s in zip(quartiles[c], ("q1", "median", "q3"))
            ],
        ]
    return one_row_to_long(df.agg(*aggs), list(columns), stats)


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value); null is a value of its own."""
    return to_long(df, columns).groupBy("column", "value").agg(F.count("*").alias("count"))


def categorical_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, null share and number of distinct values (null counts as one)."""
    counts = category_counts(df, columns)
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("count")).otherwise(0))
    return counts.groupBy("column").agg(
        nulls.alias("null_count"),
        (nulls / F.sum("count") * 100).alias("null_percentage"),
        F.count("*").alias("unique_values"),
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    counts = category_counts(df, [column]).select("value", "count")
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n)


def top_values_of_all(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """``column, value, count, rank``: the ``n`` most frequent values of every column in one job, ties by value.

    Each of TOP_BLOCKS parts of a column's values keeps its own first ``n``, so
    the values of a column are never ordered in one task.
    """
    order = [F.desc("count"), F.asc_nulls_last("value")]
    counts = category_counts(df, columns).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(TOP_BLOCKS)))
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    few = counts.withColumn("rank", rank("column", "part")).filter(F.col("rank") <= n)
    return few.withColumn("rank", rank("column")).filter(F.col("rank") <= n).select("column", "value", "count", "rank")


def table_profile(df: DataFrame) -> DataFrame:
    """Row count and describe-style statistics of every numeric column, long form."""
    names = numeric_columns(df)
    aggs = [F.count(F.lit(1)).cast("double").alias("*|rows")]
    stats = ["count", "mean", "stddev", "min", "max"]
    for c in names:
        v = clean_double(df, c)
        aggs += [
            F.count(v).cast("double").alias(f"{c}|count"),
            F.avg(v).alias(f"{c}|mean"),
            F.stddev_samp(v).alias(f"{c}|stddev"),
            F.min(v).alias(f"{c}|min"),
            F.max(v).alias(f"{c}|max"),
        ]
    cells = [("*", "rows"), *[(c, s) for c in names for s in stats]]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.col(f"`{c}|{s}`").alias("value"))
        for c, s in cells
    ])))


def table_info(df: DataFrame) -> dict[str, Any]:
    """Names, types, schema and planned partitions; no job runs."""
    return {
        "columns": df.columns,
        "dtypes": df.dtypes,
        "num_columns": len(df.columns),
        "schema": df.schema.json(),
        "partitions": df.rdd.getNumPartitions(),
    }


def value_counts(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Frequency and percent of each non-null value per column."""
    counts = category_counts(df, columns).filter(F.col("value").isNotNull())
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    # one row per column name: the broadcast side is as small as the schema
    return counts.join(F.broadcast(totals), "column").select(
        "column",
        "value",
        "count",
        F.round(F.col("count") / F.col("total") * 100, digits).alias("percent"),
    )


def rate_by_category(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Mean of a 0/1 label times 100 for each value of each column."""
    long = to_long(df, columns, label).filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg((F.avg(label) * 100).alias("rate"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[Any]) -> DataFrame:
    """Contingency table: one row per value of ``row``, one count column per value."""
    counts = df.filter(F.col(f"`{row}`").isNotNull()).groupBy(row).agg(*[
        F.count_if(F.col(f"`{column}`").eqNullSafe(F.lit(v))).alias(str(v)) for v in values
    ])
    return counts


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, in long form and symmetric."""
    require_columns(df, columns)
    pairs = list(combinations(columns, 2))

    def pair_corr(a: str, b: str) -> Column:
        """Over rows with both values; null when a column does not vary."""
        x, y = clean_double(df, a), clean_double(df, b)
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    row = df.agg(
        *[pair_corr(a, b).alias(f"{a}|{b}") for a, b in pairs],
        *[
            F.when(F.stddev_pop(clean_double(df, c)) > 0, F.lit(1.0)).alias(f"{c}|{c}")
            for c in columns
        ],
    )
    cells = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs]
    cells += [(c, c, f"{c}|{c}") for c in columns]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{f}`").alias("corr"))
        for a, b, f in cells
    ])))


def box_summary(df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and fliers per column."""
    require_columns(df, columns)
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    stats = ["whisker_low", "q1", "median", "q3", "whisker_high", "n_fliers"]
    aggs = []
    for c in columns:
        v = clean_double(df, c)
        q1, median, q3 = (F.lit(q).cast("double") for q in quartiles[c])
        reach = (q3 - q1) * factor
        inside = (v >= q1 - reach) & (v <= q3 + reach)
        aggs += [
            F.min(F.when(inside, v)).alias(f"{c}|whisker_low"),
            F.max(F.when(inside, v)).alias(f"{c}|whisker_high"),
            F.count_if(~inside).alias(f"{c}|n_fliers"),
            F.min(q1).alias(f"{c}|q1"),
            F.min(median).alias(f"{c}|median"),
            F.min(q3).alias(f"{c}|q3"),
        ]
    return one_row_to_long(df.agg(*aggs), list(columns), stats)


KDE_CELL = 0.5  # width of a cell in bandwidths
KDE_TERMS = 18
KDE_REACH = 39.0  # bandwidths beyond which the kernel is zero in double precision


def kde_grid(df: DataFrame, column: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density on an even grid, Scott bandwidth, by cells of moments.

    Values fall into cells of half a bandwidth; a cell keeps the sums of the
    first KDE_TERMS powers of the distances u to its middle, so the work for a
    row does not depend on the grid. A grid point at distance t from a middle
    gets ``exp(-t*t/2) * sum(moment_p / p! * He_p(t))``. As |u| is at most a
    quarter of a bandwidth, what is cut off is below
    ``1.09 * 0.25**p / sqrt(p!)`` of a kernel for p = KDE_TERMS, so below 1e-18.
    What is shuffled are the occupied cells, first of each task, then all.
    """
    require_columns(df, [column])
    values = df.select(clean_double(df, column).alias("v")).filter(F.col("v").isNotNull())
    moments = values.agg(
        F.count("v").alias("n"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    ).first()
    schema = "grid_id int, x double, density double"
    if not moments["n"] or not moments["std"]:
        return df.sparkSession.createDataFrame([], schema)
    n, width = moments["n"], moments["std"] * moments["n"] ** -0.2
    start = moments["low"] - cut * width
    step = (moments["high"] + cut * width - start) / (points - 1)
    scale = 1.0 / (n * width * 2.5066282746310002)

    cell = F.floor((F.col("v") - F.lit(moments["low"])) / F.lit(KDE_CELL * width))
    middle = F.lit(moments["low"]) + (F.col("cell") + 0.5) * F.lit(KDE_CELL * width)
    powers = values.withColumn("cell", cell).withColumn("p1", (F.col("v") - middle) / F.lit(width))
    for p in range(2, KDE_TERMS):
        powers = powers.withColumn(f"p{p}", F.col(f"p{p // 2}") * F.col(f"p{p - p // 2}"))
    sums = [F.count("*").cast("double")] + [F.sum(f"p{p}") / F.lit(float(math.factorial(p))) for p in range(1, KDE_TERMS)]
    cells = powers.groupBy("cell").agg(F.array(*sums).alias("m")).select(middle.alias("middle"), "m")

    reach = F.lit(KDE_REACH * width)
    first = F.greatest(F.ceil((F.col("middle") - reach - F.lit(start)) / F.lit(step)), F.lit(0))
    last = F.least(F.floor((F.col("middle") + reach - F.lit(start)) / F.lit(step)), F.lit(points - 1))
    near = cells.where(first <= last).withColumn("grid_id", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    near = near.withColumn("t", (F.lit(start) + F.col("grid_id") * F.lit(step) - F.col("middle")) / F.lit(width))
    # the polynomials follow from the two before: He_p = t He_(p-1) - (p - 1) He_(p-2)
    state = F.struct(F.lit(1.0).alias("he"), F.lit(0.0).alias("back"), F.lit(0.0).alias("total"), F.lit(0.0).alias("p"))

    def add(s: Column, m: Column) -> Column:
        return F.struct(
            (F.col("t") * s["he"] - s["p"] * s["back"]).alias("he"), s["he"].alias("back"),
            (s["total"] + m * s["he"]).alias("total"), (s["p"] + 1.0).alias("p"),
        )

    series = F.aggregate("m", state, add, lambda s: s["total"])
    summed = near.groupBy("grid_id").agg(F.sum(F.exp(-0.5 * F.col("t") * F.col("t")) * series).alias("s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("grid_id"))
    density = F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) * F.lit(scale)
    return grid.join(summed, "grid_id", "left").select("grid_id", (F.lit(start) + F.col("grid_id") * F.lit(step)).alias("x"), density.alias("density"))


WIDE_BLOCK = 256
FAN_IN = 32


def corr_matrix_wide(df: DataFrame, columns: Sequence[str], block: int = WIDE_BLOCK) -> DataFrame:
    """The same as :func:`corr_matrix` for thousands of columns: plans and runs by blocks of columns.

    A task multiplies its rows, shifted by rough means and with absent values as
    zero, with each other and with the mask of present values: so every pair has
    its counts, sums, squares and products over the rows with both values. The
    matrices leave a task in blocks of column pairs, are added up in two rounds,
    and each block gives its correlations where it lies. A task holds five
    numbers for each pair of columns.
    """
    require_columns(df, columns)
    d = len(columns)
    values = df.select(F.array(*[clean_double(df, c) for c in columns]).alias("v"))
    rough = values.limit(1000).toPandas()["v"]
    known = np.array([list(r) for r in rough], float).reshape(len(rough), d) if len(rough) else np.zeros((0, d))
    present = ~np.isnan(known)
    shift = np.where(present, known, 0).sum(axis=0) / np.maximum(present.sum(axis=0), 1)
    edges = list(range(0, d, block))

    def partial(batches):
        total = None
        for batch in batches:
            for s in range(0, len(batch), 4096):
                v = batch.column("v").slice(s, 4096)
                x = v.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(v), d) - shift
                mask = (~np.isnan(x)).astype(float)
                x = np.where(mask > 0, x, 0)
                here = np.stack((mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x))
                total = here if total is None else total + here
        if total is not None:
            task = TaskContext.get().partitionId()
            for i in edges:
                for j in edges:
                    if i <= j:
                        a, b = slice(i, i + block), slice(j, j + block)
                        # the other column's sums and squares stand in the transposed block
                        parts = np.stack((total[0, a, b], total[1, a, b], total[1, b, a].T, total[2, a, b], total[2, b, a].T, total[3, a, b]))
                        yield pa.RecordBatch.from_pydict({
                            "i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), "part": pa.array([task % FAN_IN], pa.int32()),
                            "sums": pa.array([np.ascontiguousarray(parts).tobytes()], pa.binary()),
                        })

    def summed(table: pa.Table) -> np.ndarray:
        total = 0.0
        for raw in table.column("sums"):
            total = total + np.frombuffer(raw.as_buffer(), float)
        return total

    def add(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).drop_columns(["sums"]).append_column("sums", pa.array([summed(table).tobytes()], pa.binary()))

    def correlate(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        rows, cols = min(block, d - i), min(block, d - j)
        n, sx, sy, xx, yy, xy = summed(table).reshape(6, rows, cols)
        with np.errstate(all="ignore"):
            vx, vy = xx - sx * sx / n, yy - sy * sy / n
            steady = (vx <= 1e-13 * xx) | (vy <= 1e-13 * yy) | (n == 0)
            r = (xy - sx * sy / n) / np.sqrt(vx * vy)
        a, b = np.meshgrid(np.arange(i, i + rows), np.arange(j, j + cols), indexing="ij")
        r = np.where(a == b, 1.0, r)
        keep = (a <= b) if i == j else np.ones(a.shape, bool)
        mirrored = keep & (a != b)
        names = np.array(columns, object)
        gone = np.concatenate((steady[keep], steady[mirrored]))
        return pa.table({
            "col_a": pa.array(np.concatenate((names[a[keep]], names[b[mirrored]])), pa.string()),
            "col_b": pa.array(np.concatenate((names[b[keep]], names[a[mirrored]])), pa.string()),
            "corr": pa.array(np.concatenate((r[keep], r[mirrored])), pa.float64(), mask=gone),
        })

    blocks = values.mapInArrow(partial, "i int, j int, part int, sums binary")
    added = blocks.groupBy("i", "j", "part").applyInArrow(add, "i int, j int, part int, sums binary")
    return added.groupBy("i", "j").applyInArrow(correlate, "col_a string, col_b string, corr double")
