"""Exact quantiles with bounded memory.

``percentile`` keeps every distinct value of the table in one task. Here a
mergeable sketch first brackets each wanted rank, counts then say where the
rank lies inside its bracket, and only bracket values are ordered. A bracket
holds about ``4 / SKETCH`` of the rows and shrinks again by the same factor
until its distinct values fit the limit, so no task and no driver ever sees an
unbounded set. Nulls and NaN are left out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import clean_double

SKETCH = 10_000
BRACKET_ROWS = 50_000


@dataclass
class _Rank:
    column: str
    rank: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    done: bool = False

    def settled(self) -> bool:
        """Whether a count has shown the value; equal ends of a sketch alone do not."""
        return self.done

    def bracket(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def settle(self, value: float) -> None:
        self.low = self.high = value
        self.done = True


def _bracket_probs(p: float) -> tuple[float, float]:
    slack = 2.0 / SKETCH
    return max(0.0, p - slack), min(1.0, p + slack)


def _inside(r: _Rank) -> Column:
    v = F.col(f"`{r.column}`")
    return (v > F.lit(r.low)) & (v < F.lit(r.high))


def _brackets(ranks: list[_Rank]) -> dict[tuple[str, float, float], int]:
    """Number of each different bracket; neighbouring ranks mostly share theirs."""
    return {b: i for i, b in enumerate(dict.fromkeys(r.bracket() for r in ranks))}


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, in the order of ``wanted``."""
    if not wanted:
        return {}
    values = df.select(*[clean_double(df, c).alias(c) for c in wanted])
    sketch = []
    for c, probs in wanted.items():
        v = F.col(f"`{c}`")
        bounds = [b for p in probs for b in _bracket_probs(p)]
        sketch += [
            F.count(v).alias(f"{c}|n"),
            F.min(v).alias(f"{c}|min"),
            F.max(v).alias(f"{c}|max"),
            F.percentile_approx(v, F.array(*map(F.lit, bounds)), F.lit(SKETCH)).alias(f"{c}|q"),
        ]
    first = values.agg(*sketch).first()

    ranks: dict[tuple[str, int], _Rank] = {}
    for c, probs in wanted.items():
        n = first[f"{c}|n"]
        if n == 0:
            continue
        for i, p in enumerate(probs):
            lo, hi = first[f"{c}|q"][2 * i], first[f"{c}|q"][2 * i + 1]
            lo = first[f"{c}|min"] if _bracket_probs(p)[0] == 0.0 else lo
            hi = first[f"{c}|max"] if _bracket_probs(p)[1] == 1.0 else hi
            position = p * (n - 1)
            for rank in {math.floor(position), math.ceil(position)}:
                ranks.setdefault((c, rank), _Rank(c, rank, lo, hi))
    _settle(values, list(ranks.values()), first)

    out: dict[str, list[float | None]] = {}
    for c, probs in wanted.items():
        n = first[f"{c}|n"]
        out[c] = []
        for p in probs:
            if n == 0:
                out[c].append(None)
                continue
            position = p * (n - 1)
            low, high = math.floor(position), math.ceil(position)
            a, b = ranks[(c, low)].low, ranks[(c, high)].low
            out[c].append(a if a == b else a + (position - low) * (b - a))
    return out


def _settle(values: DataFrame, ranks: list[_Rank], first) -> None:
    """Shrink every bracket until it is one value.

    The two ends are counted apart from the inside: a value shared by a large
    part of the rows soon becomes an end and then settles or drops out. Values
    strictly inside a bracket are the next ends, so every round shrinks it.
    """
    while open_ranks := [r for r in ranks if not r.settled()]:
        aggs = []
        brackets = _brackets(open_ranks)
        for (column, low, high), i in brackets.items():
            v = F.col(f"`{column}`")
            aggs += [
                F.count_if(v < F.lit(low)).alias(f"below{i}"),
                F.count_if(v == F.lit(low)).alias(f"low{i}"),
                F.count_if((v > F.lit(low)) & (v < F.lit(high))).alias(f"inside{i}"),
                F.count_if(v == F.lit(high)).alias(f"high{i}"),
            ]
        counted = values.agg(*aggs).first()
        bracketed = []
        for r in open_ranks:
            i = brackets[r.bracket()]
            below = counted[f"below{i}"]
            inside_from = below + counted[f"low{i}"]
            inside_to = inside_from + counted[f"inside{i}"]
            if r.rank < below:
                r.low, r.high = first[f"{r.column}|min"], r.low
            elif r.rank < inside_from:
                r.settle(r.low)
            elif r.rank < inside_to:
                r.below, r.inside = inside_from, counted[f"inside{i}"]
                bracketed.append(r)
            elif r.rank < inside_to + counted[f"high{i}"]:
                r.settle(r.high)
            else:
                r.low, r.high = r.high, first[f"{r.column}|max"]
        wide = [r for r in bracketed if r.inside > BRACKET_ROWS]
        if wide:
            _shrink(values, wide)
        narrow = [r for r in bracketed if r.inside <= BRACKET_ROWS]
        if narrow:
            _order(values, narrow)


def _shrink(values: DataFrame, ranks: list[_Rank]) -> None:
    aggs = []
    for i, r in enumerate(ranks):
        v = F.col(f"`{r.column}`")
        p = (r.rank - r.below + 0.5) / r.inside
        bounds = F.array(*map(F.lit, _bracket_probs(min(max(p, 0.0), 1.0))))
        aggs.append(
            F.percentile_approx(F.when(_inside(r), v), bounds, F.lit(SKETCH)).alias(f"q{i}")
        )
    row = values.agg(*aggs).first()
    for i, r in enumerate(ranks):
        r.low, r.high = row[f"q{i}"]


def _order(values: DataFrame, ranks: list[_Rank]) -> None:
    """Order the values inside each bracket, at most ``BRACKET_ROWS``, and pick."""
    brackets = _brackets(ranks)
    one_of = {r.bracket(): r for r in ranks}
    cells = F.array(*[
        F.struct(
            F.lit(i).alias("bracket"),
            F.col(f"`{b[0]}`").alias("v"),
            _inside(one_of[b]).alias("hit"),
        )
        for b, i in brackets.items()
    ])
    any_hit = reduce(lambda a, b: a | b, [_inside(r) for r in one_of.values()])
    hits = values.filter(any_hit).select(F.inline(F.filter(cells, lambda c: c["hit"])))
    counted = hits.groupBy("bracket", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(
        Window.partitionBy("bracket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    )
    wanted: dict[int, list[int]] = {i: [] for i in brackets.values()}
    for r in ranks:
        wanted[brackets[r.bracket()]].append(r.rank - r.below)
    offsets = F.get(F.array(*[F.array(*map(F.lit, wanted[i])) for i in range(len(wanted))]), F.col("bracket"))
    first = F.col("upto") - F.col("n")
    picked = (
        counted.withColumn("upto", upto)
        .filter(F.exists(offsets, lambda o: (o >= first) & (o < F.col("upto"))))
        .select("bracket", "v", first.alias("first"), "upto")
        .collect()
    )
    settled = []
    for r in ranks:
        i, offset = brackets[r.bracket()], r.rank - r.below
        settled.append(next(p["v"] for p in picked if p["bracket"] == i and p["first"] <= offset < p["upto"]))
    for r, v in zip(ranks, settled):
        r.settle(v)
