"""Ranks over tables that are too large for one sorted partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.scratch import materialize_once

PART = "__part"


def rank_rows(df: DataFrame, order: Sequence[str | Column], rank: str, by: str | None = None) -> DataFrame:
    """0-based ``rank`` in ``order``, over all rows or within each value of ``by``.

    Rows are cut into sorted ranges, ranked inside a range and shifted by the
    rows of the ranges before. Only the numbers of rows of (value of ``by``,
    range) are added up in one place. Equal order values fall in one range.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    head = [F.col(by)] if by else []
    ranged = materialize_once(df.repartitionByRange(*head, *columns).withColumn(PART, F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(*head, PART).agg(F.count("*").alias("__rows"))
    before = Window.partitionBy(*(head or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*head, PART, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*head, PART).orderBy(*columns)
    joined = ranged.join(offsets, [*([by] if by else []), PART])
    return joined.withColumn(rank, F.row_number().over(inside) - 1 + F.col("__before")).drop(PART, "__before")
