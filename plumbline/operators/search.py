"""Grid search with shared passes: all settings and folds of a model family advance in the same jobs.

One table holds the rows of all folds with their features in one array. A row
counts for every run (a setting on a fold) that may learn from it. Each job
reads the table once and serves every run: a step of logistic regression adds up
losses and gradients of a block of coefficient vectors, a level of the trees adds
up class weights by run, node, feature and bin. So the number of passes follows
the longest run (iterations, depth), not the number of settings or folds.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import keep_present
from plumbline.operators.balance import NEIGHBOURS, smote
from plumbline.operators.sample import assign_folds
from plumbline.sources.scratch import materialize_once

SEED = 42
BINS = 32
ALL_ROWS = -1  # the fold number of a final fit on all rows
TOLERANCE = 1e-6
MEMORY = 10
SUFFICIENT = 1e-4


def settings_of(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Every combination of the grid, the last name fastest."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def setting_text(setting: Mapping[str, Any]) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(setting.items()))


def fold_table(
    df: DataFrame, features: Sequence[str], label: str, key: str, folds: int, balance: bool = True,
    k: int = NEIGHBOURS, seed: int = SEED,
) -> DataFrame:
    """Rows of all folds: ``key, draw, fold, made_for, x, y``, written once.

    ``fold`` is the fold of an original row (``draw`` 0), and ``made_for`` is
    null; a synthetic row, balanced inside the training rows of one fold, has
    that fold as ``made_for`` (ALL_ROWS for the final fit).
    """
    rows = assign_folds(keep_present(df, features), key, label, folds, seed)
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("x")
    y = F.col(f"`{label}`").cast("double").alias("y")
    key_text = F.col(f"`{key}`").cast("string").alias("key")
    out = rows.select(key_text, F.lit(0).alias("draw"), "fold", F.lit(None).cast("int").alias("made_for"), x, y)
    if balance:
        def made(f: int) -> DataFrame:
            learn = rows.where(F.col("fold") != f).drop("fold")
            new = smote(learn, features, label, key, k, seed).where("draw > 0")
            return new.select(key_text, "draw", F.lit(None).cast("int").alias("fold"), F.lit(f).alias("made_for"), x, y)

        # the jobs of the folds are small and independent
        with ThreadPool(folds + 1) as pool:
            for part in pool.map(inheritable_thread_target(df.sparkSession)(made), [*range(folds), ALL_ROWS]):
                out = out.unionByName(part)
    return materialize_once(out, "folds")


def all_rows(table: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The training rows of the final fit from a fold table: key, ``draw``, features, label."""
    rows = table.where((F.col("draw") == 0) | (F.col("made_for") == ALL_ROWS))
    return rows.select("key", "draw", *[F.get("x", F.lit(i)).alias(f) for i, f in enumerate(features)], F.col("y").alias(label))


def learns(fold: np.ndarray, made_for: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """(rows, runs) whether a row is a training row of a run on the given fold; absent numbers are -2."""
    original = fold[:, None] != -2
    return np.where(original, fold[:, None] != runs[None, :], made_for[:, None] == runs[None, :])


def blocks(batches):
    """Batches of the fold table as (x, y, fold, made_for, the batch)."""
    for batch in batches:
        if len(batch):
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(len(batch), -1)
            fold, made_for = (np.asarray(batch.column(c).fill_null(-2), np.int64) for c in ("fold", "made_for"))
            yield x, np.asarray(batch.column("y"), np.float64), fold, made_for, batch


@dataclass
class Runs:
    """Settings times folds, as columns of a block: ``fold`` and ``setting`` of every run."""

    settings: list[dict[str, Any]]
    folds: Sequence[int]
    setting: np.ndarray = field(init=False)
    fold: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.setting = np.repeat(np.arange(len(self.settings)), len(self.folds))
        self.fold = np.tile(np.array(self.folds, np.int64), len(self.settings))

    def values(self, name: str, default: Any = None) -> list[Any]:
        return [self.settings[s].get(name, default) for s in self.setting]


def added(frame: DataFrame, partial, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over the table of arrays of a fixed shape; each task returns one, and the driver gets one."""
    size = int(np.prod(shape))

    def run(batches):
        total = np.zeros(shape)
        for part in blocks(batches):
            total += partial(*part[:4])
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size)), "v": pa.array(total.ravel())})

    out = np.zeros(size)
    for i, v in frame.select("x", "y", "fold", "made_for").mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas().to_numpy():
        out[int(i)] = v
    return out.reshape(shape)


@dataclass
class LogisticBlock:
    """Coefficients (runs, features + 1; the intercept last) fitted for the runs, with passes over the table."""

    runs: Runs
    weights: np.ndarray
    gradients: np.ndarray
    passes: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(x @ self.weights[:, :-1].T + self.weights[:, -1])))


def directions(gradient: np.ndarray, steps: list, changes: list) -> np.ndarray:
    """Quasi-Newton directions of every run from its last steps and gradient changes (lists of (runs, n) arrays)."""
    q, kept = gradient.copy(), []
    for s, c in zip(reversed(steps), reversed(changes), strict=True):
        curve = (s * c).sum(axis=1)
        good = curve > 1e-12 * (c * c).sum(axis=1)
        rho = np.where(good, 1 / np.where(good, curve, 1), 0)
        alpha = rho * (s * q).sum(axis=1)
        q -= alpha[:, None] * c
        kept.append((s, c, rho, alpha))
    if steps:
        curve, own = (steps[-1] * changes[-1]).sum(axis=1), (changes[-1] ** 2).sum(axis=1)
        q *= np.where((curve > 0) & (own > 0), curve / np.where(own > 0, own, 1), 1)[:, None]
    else:
        q /= np.maximum(np.linalg.norm(gradient, axis=1), 1)[:, None]
    for s, c, rho, alpha in reversed(kept):
        q += (alpha - rho * (c * q).sum(axis=1))[:, None] * s
    return -q


def fit_logistic(table: DataFrame, settings: list[dict[str, Any]], folds: Sequence[int], tolerance: float = TOLERANCE) -> LogisticBlock:
    """L2-penalised logistic regressions (``C`` on the sum of losses, ``maxIter``) of all settings and folds at once.

    Each pass evaluates one trial point of every run that is not done; runs whose
    trial does not lower the loss enough halve their step in the next pass, which
    the others use for their next iteration.
    """
    runs = Runs(settings, folds)
    d = len(table.select("x").first()[0])
    moments = added(table, lambda x, y, f, m: np.stack((np.append(x.sum(axis=0), len(x)), np.append((x * x).sum(axis=0), 0.0))), (2, d + 1))
    mean = moments[0, :d] / max(moments[0, d], 1)
    spread = np.sqrt(np.maximum(moments[1, :d] / max(moments[0, d], 1) - mean**2, 0))
    scale = np.append(np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 1), 1.0)
    penalty = np.array([1.0 / c for c in runs.values("C", 1.0)])
    most = np.array(runs.values("maxIter", 100))
    centre = np.append(mean, 0.0)

    def evaluate(points: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Losses and gradients in scaled, centred coefficients, for the active runs."""
        w, fold = points[active], runs.fold[active]

        def partial(x, y, f, m):
            z = np.column_stack(((x - mean) * scale[:-1], np.ones(len(x))))
            margin, use = z @ w.T, learns(f, m, fold)
            loss = (np.logaddexp(0, margin) - y[:, None] * margin) * use
            error = (1 / (1 + np.exp(-margin)) - y[:, None]) * use
            return np.column_stack((error.T @ z, loss.sum(axis=0)))

        total = added(table, partial, (len(fold), d + 1 + 1))
        shrink = np.append(scale[:-1] ** 2, 0.0)  # the penalty holds for the coefficients of the given features
        loss = total[:, -1] + 0.5 * penalty[active] * (w**2 * shrink).sum(axis=1)
        return loss, total[:, :-1] + penalty[active][:, None] * w * shrink

    n = len(runs.fold)
    w = np.zeros((n, d + 1))
    passes = 1
    loss, gradient = evaluate(w, np.arange(n))
    start = np.maximum(np.linalg.norm(gradient, axis=1), 1.0)
    history: list[tuple[list, list]] = [([], []) for _ in range(n)]
    direction = directions(gradient, [], [])
    step, iteration = np.ones(n), np.zeros(n, int)
    active = np.flatnonzero((np.linalg.norm(gradient, axis=1) > tolerance * start) & (most > 0))
    while len(active):
        trial = w.copy()
        trial[active] += step[active, None] * direction[active]
        new_loss, new_gradient = evaluate(trial, active)
        passes += 1
        going = []
        for place, r in enumerate(active):
            slope = float(gradient[r] @ direction[r])
            slack = 1e-12 * abs(loss[r])
            if new_loss[place] > loss[r] + SUFFICIENT * step[r] * slope + slack and step[r] > 1e-8:
                step[r] /= 2
                going.append(r)
                continue
            steps, changes = history[r]
            steps.append((trial[r] - w[r])[None])
            changes.append((new_gradient[place] - gradient[r])[None])
            del steps[:-MEMORY], changes[:-MEMORY]
            before = loss[r]
            w[r], loss[r], gradient[r] = trial[r], new_loss[place], new_gradient[place]
            iteration[r] += 1
            flat = np.linalg.norm(gradient[r]) <= tolerance * start[r]
            stuck = step[r] <= 1e-8 or abs(before - loss[r]) <= 1e-14 * abs(loss[r])
            if not flat and not stuck and iteration[r] < most[r]:
                direction[r] = directions(gradient[r][None], steps, changes)[0]
                step[r] = 1.0
                going.append(r)
        active = np.array(going, int)
    plain = w * scale
    plain[:, -1] -= plain[:, :-1] @ centre[:-1]
    return LogisticBlock(runs, plain, gradient, passes)


def bin_edges(table: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """For every feature the upper edges of its bins but the last: all values if they fit, else quantiles of the original rows."""
    original = table.where("draw = 0")
    d = len(table.select("x").first()[0])
    probs = [i / bins for i in range(1, bins)]
    row = original.agg(*[
        f(F.get("x", F.lit(i))).alias(f"{name}{i}") for i in range(d) for name, f in (
            ("q", lambda c: F.percentile_approx(c, probs, 10_000)), ("n", lambda c: F.approx_count_distinct(c, 0.01)),
        )
    ]).first()
    few = [i for i in range(d) if (row[f"n{i}"] or 0) <= 2 * bins]
    exact = {}
    if few:
        values = original.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.get("x", F.lit(i)).alias("v")) for i in few])).alias("c"))
        for i, v in values.select("c.i", "c.v").distinct().collect():
            exact.setdefault(i, []).append(v)
    edges = []
    for i in range(d):
        some = sorted(exact.get(i, []))
        edges.append(np.array(some[:-1] if some and len(some) <= bins else sorted(set(row[f"q{i}"] or []))))
    return edges


@dataclass
class TreeBlock:
    """Trees of all families on all folds as heaps: node k splits into 2k and 2k + 1.

    ``feature`` and ``cut`` are (families, nodes), with -1 where a node does not
    split: values up to the cut go to 2k. ``positive`` is the share of class 1.
    """

    edges: list[np.ndarray]
    families: list[tuple[str, int, int]]  # impurity, least rows of a node, fold
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    positive: np.ndarray
    passes: int = 0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)]) if len(self.edges) else np.zeros((len(x), 0), int)

    def descend(self, family: int, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row after ``depth`` splits, or the leaf where it stopped before."""
        node = np.ones(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(depth):
            feature = self.feature[family, node]
            inner = feature >= 0
            right = bins[rows, np.maximum(feature, 0)] > self.cut[family, node]
            node = np.where(inner, 2 * node + right, node)
        return node


def best_splits(counts: DataFrame) -> DataFrame:
    """From class counts (family, entropy, least, node, feature, bin, n0, n1) every node's totals and its best split, if any.

    Of equal gains the first feature and bin count.
    """
    order = Window.partitionBy("family", "node", "feature").orderBy("bin")
    whole = Window.partitionBy("family", "node", "feature")
    sides = counts.select(
        "*", F.sum("n0").over(order).alias("l0"), F.sum("n1").over(order).alias("l1"),
        F.sum("n0").over(whole).alias("t0"), F.sum("n1").over(whole).alias("t1"),
    )

    def impurity(a: str, b: str) -> Column:
        """Gini index or entropy times the number of rows."""
        x, y = F.col(a), F.col(b)
        n = x + y
        part = lambda v: F.when(v > 0, -v * F.log2(v / n)).otherwise(0.0)
        return F.when(F.col("entropy"), part(x) + part(y)).otherwise(F.when(n > 0, 2 * x * y / n).otherwise(0.0))

    sides = sides.withColumns({"r0": F.col("t0") - F.col("l0"), "r1": F.col("t1") - F.col("l1")})
    gain = impurity("t0", "t1") - impurity("l0", "l1") - impurity("r0", "r1")
    fits = (F.col("l0") + F.col("l1") >= F.col("least")) & (F.col("r0") + F.col("r1") >= F.col("least")) & (gain > 1e-9)
    split = F.when(fits, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    best = sides.groupBy("family", "node").agg(F.max(split).alias("s"), F.first("t0").alias("t0"), F.first("t1").alias("t1"))
    return best.select("family", "node", "t0", "t1", "s.gain", (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("cut"))


HELD = 1 << 22


def fit_trees(table: DataFrame, settings: list[dict[str, Any]], folds: Sequence[int], bins: int = BINS) -> TreeBlock:
    """Decision trees of all settings and folds (``maxDepth``, ``minInstancesPerNode``, ``impurity``), a level at a time.

    Settings that differ in depth alone share a tree, since a shallow one is the
    top of a deep one. A level is one pass: tasks count classes by family, node,
    feature and bin, Spark adds the counts up and picks the splits, and the
    driver gets one row a node.
    """
    edges = bin_edges(table, bins)
    kinds = sorted({(s.get("impurity", "gini"), int(s.get("minInstancesPerNode", 1))) for s in settings})
    families = [(kind, least, f) for kind, least in kinds for f in folds]
    depth = max(int(s.get("maxDepth", 5)) for s in settings)
    size = 2 << depth
    shape = (len(families), size)
    block = TreeBlock(edges, families, depth, np.full(shape, -1), np.full(shape, -1), np.full(shape, np.nan))
    fold_of = np.array([f for _, _, f in families], np.int64)
    d, width = len(edges), max([len(e) for e in edges], default=0) + 1
    names = table.sparkSession.createDataFrame([(i, kind == "entropy", least) for i, (kind, least, _) in enumerate(families)], "family int, entropy boolean, least long")
    open_ = np.zeros(shape, bool)
    open_[:, 1] = True
    for level in range(depth + 1):
        if not open_.any():
            break
        here = open_.copy()

        def run(batches):
            held, count = [], 0

            def summed():
                code, n = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
                return code, np.bincount(n, np.concatenate([w for _, w in held])).astype(np.int64)

            def out(code, n):
                code, y = code // 2, code % 2
                code, b = code // width, code % width
                code, feature = code // d, code % d
                return pa.RecordBatch.from_pydict({
                    "family": pa.array((code // size).astype(np.int32)), "node": pa.array(code % size), "feature": pa.array(feature.astype(np.int32)),
                    "bin": pa.array(b.astype(np.int32)), "n0": pa.array(np.where(y == 0, n, 0)), "n1": pa.array(np.where(y == 1, n, 0)),
                })

            for x, y, fold, made_for, _ in blocks(batches):
                binned = block.binned(x)
                use = learns(fold, made_for, fold_of)
                for family in np.flatnonzero(here.any(axis=1)):
                    rows = np.flatnonzero(use[:, family])
                    node = block.descend(family, binned[rows], level)
                    some = here[family, node]
                    rows, node = rows[some], node[some]
                    code = (family * size + node)[:, None] * d + np.arange(d)
                    code = (code * width + binned[rows]) * 2 + y[rows].astype(np.int64)[:, None]
                    key, n = np.unique(code.ravel(), return_counts=True)
                    held.append((key, n))
                    count += len(key)
                if count > HELD:
                    held = [summed()]
                    count = len(held[0][0])
                    if count > HELD // 2:
                        yield out(*held[0])
                        held, count = [], 0
            if count:
                yield out(*summed())

        counted = table.select("x", "y", "fold", "made_for").mapInArrow(run, "family int, node bigint, feature int, bin int, n0 bigint, n1 bigint")
        counts = counted.groupBy("family", "node", "feature", "bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        found = best_splits(counts.join(F.broadcast(names), "family")).collect()
        block.passes += 1
        open_[:] = False
        for r in found:
            block.positive[r.family, r.node] = r.t1 / (r.t0 + r.t1)
            if r.gain is not None and level < depth:
                block.feature[r.family, r.node], block.cut[r.family, r.node] = r.feature, r.cut
                open_[r.family, [2 * r.node, 2 * r.node + 1]] = True
    return block


LOGISTIC, TREE = "logistic", "tree"
SUPPORTED = {LOGISTIC: {"C", "maxIter"}, TREE: {"maxDepth", "minInstancesPerNode", "impurity"}}


def fold_predictions(table: DataFrame, family: str, settings: list[dict[str, Any]], folds: int) -> DataFrame:
    """``key, fold, y, setting, probability, prediction`` of every original row by every setting, fitted without the row's fold."""
    numbers = list(range(folds))
    if family == LOGISTIC:
        fitted = fit_logistic(table, settings, numbers)

        def probability(x: np.ndarray, fold: int) -> np.ndarray:
            return fitted.probabilities(x)[:, fitted.runs.fold == fold]
    else:
        trees = fit_trees(table, settings, numbers)

        def probability(x: np.ndarray, fold: int) -> np.ndarray:
            binned = trees.binned(x)
            columns = []
            for s in settings:
                at = trees.families.index((s.get("impurity", "gini"), int(s.get("minInstancesPerNode", 1)), fold))
                columns.append(trees.positive[at, trees.descend(at, binned, int(s.get("maxDepth", 5)))])
            return np.column_stack(columns)

    def run(batches):
        for x, y, fold, _, batch in blocks(batches):
            for f in np.unique(fold):
                rows = np.flatnonzero(fold == f)
                p = probability(x[rows], int(f))
                n, m = p.shape
                yield pa.RecordBatch.from_pydict({
                    "key": batch.column("key").take(pa.array(np.repeat(rows, m))), "fold": pa.array(np.full(n * m, f, np.int32)),
                    "y": pa.array(np.repeat(y[rows], m)), "setting": pa.array(np.tile(np.arange(m, dtype=np.int32), n)),
                    "probability": pa.array(p.ravel()), "prediction": pa.array((p.ravel() > 0.5).astype(np.float64)),
                })

    schema = "key string, fold int, y double, setting int, probability double, prediction double"
    return table.where("draw = 0").select("key", "x", "y", "fold", "made_for").mapInArrow(run, schema)


def setting_scores(predictions: DataFrame, scoring: str = "accuracy") -> DataFrame:
    """``setting, score``: the mean over the folds of the accuracy, or of the f1 of class 1."""
    right, guessed, true = F.col("y") == F.col("prediction"), F.col("prediction") == 1, F.col("y") == 1
    if scoring == "f1":
        both = F.count_if(right & true)
        score = F.coalesce(2 * both / F.nullif(F.count_if(guessed) + F.count_if(true), F.lit(0)), F.lit(0.0))
    elif scoring == "accuracy":
        score = F.avg(right.cast("double"))
    else:
        raise ValueError(f"scoring must be accuracy or f1: {scoring}")
    return predictions.groupBy("setting", "fold").agg(score.alias("score")).groupBy("setting").agg(F.avg("score").alias("score"))


def shared_search(
    df: DataFrame, family: str, grid: Mapping[str, Sequence[Any]], features: Sequence[str], label: str, key: str,
    folds: int = 5, scoring: str = "accuracy", balance: bool = True, seed: int = SEED, table: DataFrame | None = None,
) -> tuple[list[dict[str, Any]], list[float]]:
    """All settings of a grid and the cross-validated score of each; ``family`` is LOGISTIC or TREE.

    A ``table`` from :func:`fold_table` with the same arguments is used as it is."""
    if unknown := set(grid) - SUPPORTED[family]:
        raise ValueError(f"not searched in shared passes: {sorted(unknown)}")
    settings = settings_of(grid)
    table = fold_table(df, features, label, key, folds, balance, seed=seed) if table is None else table
    scores = {r.setting: r.score for r in setting_scores(fold_predictions(table, family, settings, folds), scoring).collect()}
    return settings, [scores.get(i, math.nan) for i in range(len(settings))]
