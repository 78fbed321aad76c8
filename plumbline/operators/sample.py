"""Splits, folds and samples by row hash.

Fitting finds a few hash thresholds; assigning rows is a comparison with
literals: no shuffle, no sort, the same answer for any partitioning. Sizes are
exact when the key is unique; rows that share a key stay together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.hashing import HASH_SPAN, row_hash
from plumbline.functions.selection import TooManyStrata, below_cut, cuts_passed, rank_cuts
from plumbline.functions.strata import largest_remainder, stratum_counts, stratum_cuts, stratum_key, with_cuts


def stratified_sizes(counts: Mapping[Any, int], test_size: float) -> dict[Any, int]:
    """Test rows per class: ``ceil(n * test_size)`` in total, by largest remainder."""
    total = sum(counts.values())
    if not total:
        return {}
    wanted = math.ceil(round(total * test_size, 9))
    shares = {s: wanted * n / total for s, n in counts.items()}
    sizes = {s: math.floor(x) for s, x in shares.items()}
    by_remainder = sorted(counts, key=lambda s: (sizes[s] - shares[s], str(s)))
    for s in by_remainder[: wanted - sum(sizes.values())]:
        sizes[s] += 1
    return sizes


def fit_split(
    df: DataFrame,
    key: str,
    stratify: str | None = None,
    test_size: float = 0.2,
    seed: int = 42,
) -> Column:
    """Expression giving ``test`` or ``train`` for each row."""
    h = row_hash([key], seed)
    if stratify is None:
        _, cuts = rank_cuts(df, h, lambda n: {s: [math.ceil(round(c * test_size, 9))] for s, c in n.items()})
        in_test = below_cut(h, {s: c[0] for s, c in cuts.items()} or {None: 0})
    else:
        stratum = F.col(f"`{stratify}`")
        _, cuts = rank_cuts(
            df, h, lambda n: {s: [k] for s, k in stratified_sizes(n, test_size).items()}, stratum
        )
        in_test = below_cut(h, {s: c[0] for s, c in cuts.items()}, stratum)
    return F.when(in_test, "test").otherwise("train")


def split_train_test(
    df: DataFrame,
    key: str,
    stratify: str | None = None,
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: a reproducible train/test assignment.

    Some hundreds of strata are compared with literals; more are joined as a table.
    """
    try:
        return df.withColumn("split", fit_split(df, key, stratify, test_size, seed))
    except TooManyStrata:
        return split_by_table(df, key, stratify, test_size, seed)


def split_by_table(df: DataFrame, key: str, stratify: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """The same split for any number of strata: sizes and cuts are tables, nothing per stratum reaches the driver."""
    stratum, h = F.col(f"`{stratify}`"), row_hash([key], seed)
    rows = df.select(stratum_key(stratum).alias("s"), h.alias("h"))
    sizes = largest_remainder(stratum_counts(rows), test_size)
    cuts = stratum_cuts(rows, sizes.select("s", "n", F.array("k").alias("ranks")))
    return with_cuts(df, stratum, h, cuts, "split", F.when(F.col("__h") < F.get("__cuts", F.lit(0)), "test").otherwise("train"))


def assign_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..k-1; within each class fold sizes differ by at most one."""
    h = row_hash([key], seed)
    stratum = F.col(f"`{label}`")
    try:
        _, cuts = rank_cuts(
            df, h, lambda n: {s: [-(-c * j // k) for j in range(1, k)] for s, c in n.items()}, stratum
        )
    except TooManyStrata:
        return folds_by_table(df, key, label, k, seed)
    fold = cuts_passed(h, cuts, stratum) if cuts else F.lit(0)
    return df.withColumn("fold", fold.cast("int"))


def folds_by_table(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """The same folds for any number of classes: counts and cuts are tables."""
    stratum, h = F.col(f"`{label}`"), row_hash([key], seed)
    rows = df.select(stratum_key(stratum).alias("s"), h.alias("h"))
    ranks = F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda j: F.ceil(F.col("n") * j / k)) if k > 1 else F.array().cast("array<long>")
    cuts = stratum_cuts(rows, stratum_counts(rows).select("s", "n", ranks.alias("ranks")))
    passed = F.size(F.filter(F.coalesce("__cuts", F.array().cast("array<long>")), lambda c: F.col("__h") >= c))
    return with_cuts(df, stratum, h, cuts, "fold", passed.cast("int"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the lowest hashes (all rows when there are fewer)."""
    h = row_hash([key], seed)
    _, cuts = rank_cuts(df, h, lambda counts: {s: [n] for s in counts})
    return df.filter(below_cut(h, {s: c[0] for s, c in cuts.items()} or {None: 0}))


def sample_fraction(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """Rows whose hash lies in the lowest ``fraction`` of the range."""
    return df.filter(row_hash([key], seed) < F.lit(int(fraction * HASH_SPAN)))


def sample_rows(
    df: DataFrame,
    key: str,
    n: int | None = None,
    fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """Sample by number or by fraction; one of them is needed."""
    if n is not None:
        return sample_n(df, n, key, seed)
    if fraction is not None:
        return sample_fraction(df, fraction, key, seed)
    raise ValueError("either n or fraction must be given")
