"""Exact rank selection over row hashes without sorting the table.

``rank_cuts`` finds the hash value below which exactly ``rank`` rows lie. Each
pass counts rows by the next 12 hash bits, inside the bins that still hold a
wanted rank; the driver sees at most 4,096 counts per wanted rank. After the
first pass a bin holds about 1/4096 of its stratum, so two passes settle
hundreds of millions of rows and three settle 10^12.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.hashing import HASH_BITS, HASH_SPAN

RADIX_BITS = 12
MAX_STRATA = 1_000


class TooManyStrata(ValueError):
    """More strata than the driver should hold; see :mod:`plumbline.functions.strata`."""


@dataclass
class _Target:
    stratum: Any
    rank: int
    low: int = 0
    high: int = HASH_SPAN
    below: int = 0
    inside: int = 0


def _by_stratum(rows: Sequence[Any]) -> dict[Any, list[tuple[int, int]]]:
    out: dict[Any, list[tuple[int, int]]] = {}
    for r in rows:
        out.setdefault(r["stratum"], []).append((r["bin"], r["n"]))
    for bins in out.values():
        bins.sort()
    return out


def _narrow(target: _Target, bins: list[tuple[int, int]], shift: int) -> None:
    """Move the target into the bin that holds its rank."""
    first, last = target.low >> shift, (target.high - 1) >> shift
    below = target.below
    for b, n in bins:
        if b < first or b > last:
            continue
        if target.rank < below + n:
            target.low, target.high = b << shift, (b + 1) << shift
            target.below, target.inside = below, n
            return
        below += n


def rank_cuts(
    df: DataFrame,
    value: Column,
    wanted: Callable[[Mapping[Any, int]], Mapping[Any, Sequence[int]]],
    stratum: Column | None = None,
) -> tuple[dict[Any, int], dict[Any, list[int]]]:
    """Row counts per stratum, and per stratum the cut for each wanted rank.

    ``wanted`` gets the counts and returns ascending ranks per stratum. Rows
    with ``value < cut`` number exactly ``rank`` when keys are unique; rows that
    share one key share its hash and stay together above the cut.
    """
    keyed = df.select(
        (F.lit(None).cast("string") if stratum is None else stratum).alias("stratum"),
        value.alias("h"),
    )

    def histogram(rows: DataFrame, shift: int) -> list[Any]:
        bins = F.shiftright("h", shift) if shift else F.col("h")
        return rows.groupBy("stratum", bins.alias("bin")).agg(F.count("*").alias("n")).collect()

    strata_guard = MAX_STRATA * (1 << RADIX_BITS)
    shift = HASH_BITS - RADIX_BITS
    top = (
        keyed.groupBy("stratum", F.shiftright("h", shift).alias("bin"))
        .agg(F.count("*").alias("n"))
        .limit(strata_guard + 1)
        .collect()
    )
    if len(top) > strata_guard:
        raise TooManyStrata(f"more than {MAX_STRATA} strata")
    bins = _by_stratum(top)
    counts = {s: sum(n for _, n in b) for s, b in bins.items()}

    ranks = wanted(counts)
    targets = [_Target(s, r) for s, rs in ranks.items() for r in rs if 0 < r < counts[s]]
    for t in targets:
        _narrow(t, bins[t.stratum], shift)

    while shift and targets:
        shift = max(0, shift - RADIX_BITS)
        if all(t.inside == 1 for t in targets):
            shift = 0  # the rows are known, only their exact hashes are not
        inside = reduce(
            lambda a, b: a | b,
            [
                F.col("stratum").eqNullSafe(F.lit(t.stratum))
                & (F.col("h") >= t.low)
                & (F.col("h") < t.high)
                for t in targets
            ],
        )
        bins = _by_stratum(histogram(keyed.filter(inside), shift))
        for t in targets:
            _narrow(t, bins[t.stratum], shift)

    found = {(t.stratum, t.rank): t.low for t in targets}
    cuts = {
        s: [0 if r <= 0 else HASH_SPAN if r >= counts[s] else found[(s, r)] for r in rs]
        for s, rs in ranks.items()
    }
    return counts, cuts


def below_cut(value: Column, cuts: Mapping[Any, int], stratum: Column | None = None) -> Column:
    """Boolean: is the row under the cut of its stratum?"""
    if stratum is None:
        return value < F.lit(cuts[None])
    out = F.lit(False)
    for s, cut in cuts.items():
        out = F.when(stratum.eqNullSafe(F.lit(s)), value < F.lit(cut)).otherwise(out)
    return out


def cuts_passed(value: Column, cuts: Mapping[Any, Sequence[int]], stratum: Column | None = None) -> Column:
    """How many cuts of its stratum the row's hash has reached."""
    def passed(limits: Sequence[int]) -> Column:
        return reduce(
            lambda a, b: a + b,
            [F.when(value >= F.lit(c), 1).otherwise(0) for c in limits],
            F.lit(0),
        )

    if stratum is None:
        return passed(cuts[None])
    out = F.lit(None).cast("int")
    for s, limits in cuts.items():
        out = F.when(stratum.eqNullSafe(F.lit(s)), passed(limits)).otherwise(out)
    return out
