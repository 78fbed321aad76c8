"""Minority oversampling by interpolation between nearest neighbours (SMOTE).

Exact neighbours without comparing all pairs:

1. Equal feature vectors collapse to one row with a count, so a large group of
   copies is one point whose neighbours are its own copies.
2. Points are dealt to cells. From WIDE columns on these are small and have
   bounding boxes (:mod:`plumbline.operators.neighbours`): a box that is further
   away than the current k-th neighbour holds no neighbour. A single column is
   cut into cells of equal size.
3. The points of its own cell bound the distance of a point to its k-th
   neighbour from above.
4. Each point visits the cells its bound reaches, keeps what lies within the
   bound, and ranks it. Nothing is sampled or capped.

Ties between different vectors at one distance go to the smaller key. All
random choices come from the md5 digest of seed, row key and draw number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import require_columns
from plumbline.functions.hashing import DRAW_DIGITS, DRAW_SPAN, digest, hex_number, row_hash
from plumbline.functions.selection import below_cut, rank_cuts
from plumbline.operators.neighbours import visits, with_cells
from plumbline.sources.scratch import materialize_once

NEIGHBOURS = 5
CELL_ROWS = 2_048
MAX_CELLS = 20_000
HOT_VECTOR_ROWS = 10_000
MAX_HOT_VECTORS = 100_000
WIDE = 2
OTHER = ("vid AS other", "vkey AS other_key", "copies AS other_copies", "v AS nv")


def class_counts(df: DataFrame, label: str) -> dict[Any, int]:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def _squared_distance(left: str, right: str, n: int) -> str:
    """SQL text over two arrays of known length: parsed at once and compiled with the stage."""
    return " + ".join(f"({left}[{i}] - {right}[{i}]) * ({left}[{i}] - {right}[{i}])" for i in range(n))


def _direction(spread: Sequence[float]) -> list[float]:
    """Unit vector leaning on the wide columns; the uneven factors keep
    different vectors apart on it."""
    uneven = [s * (1.0 + 0.1 * math.modf((i + 1) * 0.6180339887498949)[0]) for i, s in enumerate(spread)]
    length = math.sqrt(sum(u * u for u in uneven))
    return [u / length for u in uneven] if length else [1.0] + [0.0] * (len(spread) - 1)


def _cells(df: DataFrame, splits: Sequence[float], columns: dict[str, str]) -> DataFrame:
    """Cell number of each projection column."""
    if len(splits) == 2:
        return df.withColumns({out: F.lit(0) for out in columns.values()})
    cut = Bucketizer(
        splitsArray=[list(splits)] * len(columns),
        inputCols=list(columns),
        outputCols=list(columns.values()),
        handleInvalid="error",
    ).transform(df)
    return cut.withColumns({out: F.col(out).cast("int") for out in columns.values()})


def feature_points(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """Row key, feature values as one array ``v``, and the digest ``vid`` of the values.

    One array instead of many columns keeps the plans small: the optimizer
    multiplies long conditions for every column that is renamed above them.
    """
    values = ", ".join(f"nanvl(CAST(`{f}` AS DOUBLE), NULL)" for f in features)
    v = F.expr(f"array_compact(array({values}))")
    complete = F.when(F.size(v) == len(features), v).otherwise(
        F.raise_error("a feature is missing; impute or drop first").cast("array<double>")
    )
    return df.select(F.col(f"`{key}`").alias("key"), complete.alias("v")).withColumn(
        "vid", F.md5(F.expr("array_join(CAST(v AS ARRAY<STRING>), '|')"))
    )


def distinct_vectors(points: DataFrame) -> DataFrame:
    """One row per feature vector: ``vid, v, copies, vkey`` (smallest row key)."""
    return points.groupBy("vid").agg(
        F.first("v").alias("v"), F.count("*").alias("copies"), F.min("key").alias("vkey")
    )


def nearest_vectors(vectors: DataFrame, n_features: int, k: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Neighbours of every vector that has fewer than ``k`` other copies.

    Returns ``vid, rank, nv``: the neighbour's values at each rank. Own copies
    take the first ranks and get no row.
    """
    if n_features >= WIDE:
        placed, boxes = with_cells(vectors)
        visiting = visits(placed, boxes, k)
        return _ranked(visiting, placed.selectExpr("cell", *OTHER), "vid <> other", n_features, k)
    axes = range(n_features)
    shape = vectors.agg(F.count("*").alias("n"), *[F.expr(f"stddev_pop(v[{i}])").alias(f"s{i}") for i in axes]).first()
    direction = _direction([shape[f"s{i}"] or 0.0 for i in axes])
    placed = vectors.withColumn("p", F.expr(" + ".join(f"{w!r}D * v[{i}]" for i, w in enumerate(direction))))

    n_cells = min(MAX_CELLS, -(-shape["n"] // cell_rows))
    splits = [-math.inf, math.inf]
    if n_cells > 1:
        probs = ", ".join(f"{i / n_cells!r}D" for i in range(1, n_cells))
        accuracy = max(10_000, 10 * n_cells)
        cuts = placed.agg(F.expr(f"percentile_approx(p, array({probs}), {accuracy})")).first()[0]
        splits = [-math.inf, *sorted(set(cuts)), math.inf]
    placed = _cells(placed, splits, {"p": "cell"})

    # the bound: distances to the points next to this one in its cell
    steps = ", ".join(
        f"{shift}(v, {j}) OVER (PARTITION BY cell ORDER BY p, vid)" for j in range(1, k + 1) for shift in ("lag", "lead")
    )
    squares = "aggregate(zip_with(v, b, (x, y) -> (x - y) * (x - y)), 0D, (total, x) -> total + x)"
    bounded = (
        placed.withColumn("beside", F.expr(f"array({steps})"))
        .selectExpr(
            "vid",
            "copies",
            "p",
            "v",
            f"{k} - (copies - 1) AS needed",
            f"array_sort(transform(filter(beside, b -> b IS NOT NULL), b -> {squares})) AS gaps",
            "sqrt(aggregate(v, 0D, (total, x) -> total + x * x)) AS norm",
        )
        .filter("needed > 0")
        .withColumn("reach2", F.expr("get(gaps, int(needed - 1))"))
    )
    reach = "sqrt(reach2) * (1 + 1e-9D) + 1e-12D * norm"
    queries = bounded.selectExpr(
        "vid",
        "copies",
        "needed",
        "reach2",
        "v",
        f"coalesce(p - ({reach}), double('-infinity')) AS low",
        f"coalesce(p + ({reach}), double('infinity')) AS high",
    )
    visits_of_cells = _cells(queries, splits, {"low": "cell_low", "high": "cell_high"}).withColumn(
        "cell", F.explode(F.sequence("cell_low", "cell_high"))
    )
    others = placed.selectExpr("cell", *OTHER, "p AS other_p")
    return _ranked(visits_of_cells, others, "vid <> other AND other_p BETWEEN low AND high", n_features, k)


def _ranked(visiting: DataFrame, others: DataFrame, met: str, n_features: int, k: int) -> DataFrame:
    """The nearest vectors among those of the visited cells."""
    distance = _squared_distance("v", "nv", n_features)
    within = F.expr(f"{met} AND (reach2 IS NULL OR {distance} <= reach2)")
    found = visiting.join(others, "cell").filter(within).selectExpr(
        "vid", "copies", "needed", "other_key", "other_copies", f"{distance} AS d2", "nv"
    )
    order = Window.partitionBy("vid").orderBy("d2", "other_key")
    ranked = (
        found.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
        .withColumn("upto", F.sum("other_copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("first", F.col("upto") - F.col("other_copies"))
        .filter(F.col("first") < F.col("needed"))
    )
    return ranked.selectExpr(
        "vid", "explode(sequence(copies - 1 + first, copies - 2 + least(upto, needed))) AS rank", "nv"
    )


def synthesize(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    minority: Any,
    n_new: int,
    n_rows: int,
    k: int = NEIGHBOURS,
    seed: int = 42,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``n_new`` synthetic rows of one class: ``key, draw, features.., label``.

    Every row of the class is the base of ``n_new // n_rows`` draws; the rows
    with the lowest hashes take the remainder.
    """
    if n_rows < 2:
        raise ValueError(f"class {minority!r} has {n_rows} row; interpolation needs two")
    k = min(k, n_rows - 1)
    members = df.filter(F.col(f"`{label}`") == F.lit(minority))
    points = materialize_once(feature_points(members, features, key), "minority")
    vectors = materialize_once(distinct_vectors(points), "vectors")
    neighbours = nearest_vectors(vectors, len(features), k, cell_rows)

    extra = F.lit(0)
    if n_new % n_rows:
        h = row_hash(["key"], seed)
        _, cuts = rank_cuts(points, h, lambda n: {s: [n_new % n_rows] for s in n})
        extra = below_cut(h, {s: c[0] for s, c in cuts.items()}).cast("int")
    drawn = (
        points.withColumn("n_draws", F.lit(n_new // n_rows) + extra)
        .filter(F.col("n_draws") > 0)
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("n_draws"))))
        .withColumn("dice", digest(seed, ["key"], F.col("draw")))
        .withColumn("rank", F.pmod(hex_number(F.col("dice"), 1, DRAW_DIGITS), F.lit(k)).cast("bigint"))
        .withColumn("u", hex_number(F.col("dice"), 1 + DRAW_DIGITS, DRAW_DIGITS) / F.lit(float(DRAW_SPAN)))
    )
    # A vector with more than k copies only has itself as neighbour. The most
    # frequent ones skip the join, so no join key is hot. At most
    # n_rows / threshold vectors pass the filter: the broadcast is bounded.
    threshold = max(HOT_VECTOR_ROWS, n_rows // MAX_HOT_VECTORS)
    hot = vectors.filter(F.col("copies") > threshold).select("vid", F.lit(True).alias("hot"))
    marked = drawn.join(F.broadcast(hot), "vid", "left")
    joined = marked.filter(F.col("hot").isNull()).join(neighbours, ["vid", "rank"], "left")
    moved = joined.select(
        "key",
        "draw",
        F.expr("coalesce(zip_with(v, nv, (x, y) -> x + u * (y - x)), v)").alias("v"),
    )
    copied = marked.filter(F.col("hot")).select("key", "draw", "v")
    out = moved.unionByName(copied).select(
        "key", "draw", *[F.expr(f"v[{i}]").alias(f) for i, f in enumerate(features)]
    )
    return out.withColumn(label, F.lit(minority)).withColumnRenamed("key", key)


def _as_double(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    return c if isinstance(df.schema[column].dataType, T.DoubleType) else c.cast("double").alias(column)


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    k: int = NEIGHBOURS,
    seed: int = 42,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Original and synthetic rows; every class ends with the majority's count.

    Columns: key, ``draw`` (0 for original rows), features as double, label.
    """
    require_columns(df, [*features, label, key])
    counts = class_counts(df, label)
    if not counts:
        raise ValueError("nothing to balance")
    largest = max(counts.values())
    out = df.select(key, F.lit(0).alias("draw"), *[_as_double(df, f) for f in features], label)
    for value, n in sorted(counts.items(), key=lambda kv: str(kv[0])):
        if n < largest:
            rows = synthesize(df, features, label, key, value, largest - n, n, k, seed, cell_rows)
            out = out.unionByName(rows.withColumn(label, F.col(label).cast(df.schema[label].dataType)))
    return out


def class_distribution(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Rows per class, for example by split or before and after balancing."""
    return df.groupBy(*by, label).agg(F.count("*").alias("count"))
