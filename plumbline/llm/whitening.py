"""Whitening of embeddings from the covariance of distinct rounded vectors and their counts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.joins import join_back
from plumbline.llm.shared import checkpointed

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
BLOCK = 4096
LARGEST = 2.0**62  # entries beyond it, scaled, count as it
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors of one length with sums ``total``: ``turn`` maps centred vectors to whitened components."""

    n: int
    total: tuple[int, ...]
    turn: np.ndarray  # (dimensions, components)
    explained: np.ndarray  # (components,)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - total / n, with the whole part of the mean taken off exactly."""
        whole = [s // self.n for s in self.total]
        rest = np.array([(s - self.n * w) / self.n for s, w in zip(self.total, whole, strict=True)])
        return (x - np.array(whole, np.int64)).astype(np.float64) - rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - total)**2, exact; null where it needs more than 64 bits."""
        whole = [s // self.n for s in self.total]
        rest = [s - self.n * w for s, w in zip(self.total, whole, strict=True)]
        near = x - np.array(whole, np.int64)
        if (int(np.abs(near).max(initial=0)) + 1) ** 2 * self.n**2 * x.shape[1] < 1 << 62:
            return ((near * self.n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((near.astype(object) * self.n - np.array(rest, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def rounded(vec: Column) -> Column:
    """floor(64 c) + 1,000,000 for every entry."""
    inside = lambda c: F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))
    return F.transform(vec, lambda c: F.floor(inside(c)) + OFFSET)


def matrices(batches, columns: list[str]):
    """(dimension, batch, (rows, dimension) array of the first column) for every length in every batch."""
    for batch in batches:
        sizes = np.asarray(pa.compute.list_value_length(batch.column(columns[0])))
        for d in np.unique(sizes):
            part = batch.filter(pa.array(sizes == d))
            for s in range(0, len(part), BLOCK):
                some = part.slice(s, BLOCK)
                yield int(d), some, np.asarray(some.column(columns[0]).flatten()).reshape(len(some), int(d))


def sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For every length: number of vectors and their sums per dimension, exact."""

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for d, part, x in matrices(batches, ["x"]):
            w = np.asarray(part.column("weight"))
            if float(np.abs(x).max()) * float(w.sum()) >= 2.0**62:
                w, x = w.astype(object), x.astype(object)
            here = np.append(w @ x, w.sum()).astype(object)
            found[d] = found[d] + here if d in found else here
        for d, values in found.items():
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * len(values), pa.int32()), "i": pa.array(range(len(values)), pa.int32()),
                "v": pa.array([int(v) for v in values], pa.decimal128(38, 0)),
            })

    total = distinct.select("x", "weight").mapInArrow(run, "d int, i int, v decimal(38,0)")
    out: dict[int, list[int]] = {}
    for r in total.groupBy("d", "i").agg(F.sum("v").alias("v")).orderBy("d", "i").collect():
        out.setdefault(r.d, []).append(int(r.v))
    return {d: (values[-1], values[:-1]) for d, values in out.items()}


def gram(frame: DataFrame, column: str, centre) -> dict[int, np.ndarray]:
    """For every length the sum of weight * c c', c = centre(length, vectors); each task returns one triangle a length."""

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for d, part, x in matrices(batches, [column]):
            c = centre(d, x)
            here = (c * np.asarray(part.column("weight"), np.float64)[:, None]).T @ c
            found[d] = found[d] + here if d in found else here
        for d, values in found.items():
            i, j = np.triu_indices(len(values))
            yield pa.RecordBatch.from_pydict({
                "d": pa.array(np.full(len(i), d, np.int32)), "i": pa.array(i.astype(np.int32)),
                "j": pa.array(j.astype(np.int32)), "v": pa.array(values[i, j]),
            })

    parts = frame.select(column, "weight").mapInArrow(run, "d int, i int, j int, v double")
    rows = parts.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for d, part in rows.groupby("d"):
        size = int(part.i.max()) + 1
        matrix = np.zeros((size, size))
        matrix[part.i, part.j] = part.v
        out[int(d)] = np.triu(matrix) + np.triu(matrix, 1).T
    return out


def fit_whitening(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for every vector length, from distinct vectors ``x`` (array of long) and their ``weight``.

    Components are unit eigenvectors of the covariance by falling eigenvalue,
    their largest entry positive; those without variance are left out. The
    driver gets one triangle of the covariance for each length, whatever the rows.
    """
    known = sums(distinct)
    plain = {d: Whitening(n, tuple(s), np.zeros((d, 0)), np.zeros(0)) for d, (n, s) in known.items()}
    fitted = {}
    for d, total in gram(distinct, "x", lambda d, x: plain[d].centred(x)).items():
        n, s = known[d]
        values, vectors = np.linalg.eigh(total / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        some = int((values[:components] > RANK_TOLERANCE * max(values[0], 0)).sum())
        values, vectors, trace = values[:some], vectors[:, :some], np.trace(total / n)
        lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(some)] if some else np.zeros(0)
        fitted[d] = Whitening(n, tuple(s), vectors * np.sign(lead) / np.sqrt(values), values / trace if some else values)
    return fitted


def identity_errors(whitened: DataFrame) -> dict[int, float]:
    """For every number of components the largest entry of the whitened covariance minus the identity; columns w, weight."""
    def mean_of(rows):
        n = rows[-1]
        return np.array([v / n for v in rows[:-1]])

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for d, part, w in matrices(batches, ["w"]):
            k = np.asarray(part.column("weight"), np.float64)
            here = np.append(k @ w, k.sum())
            found[d] = found[d] + here if d in found else here
        for d, values in found.items():
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * len(values), pa.int32()), "i": pa.array(range(len(values)), pa.int32()), "v": pa.array(values),
            })

    rows: dict[int, list[float]] = {}
    firsts = whitened.select("w", "weight").mapInArrow(run, "d int, i int, v double")
    for r in firsts.groupBy("d", "i").agg(F.sum("v").alias("v")).orderBy("d", "i").collect():
        rows.setdefault(r.d, []).append(r.v)
    means = {d: mean_of(v) for d, v in rows.items()}
    seconds = gram(whitened, "w", lambda d, w: w - means[d])
    return {d: float(np.abs(m / rows[d][-1] - np.eye(d)).max()) for d, m in seconds.items()}


def whiten_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, weights: str = "count",
) -> DataFrame:
    """Whitened components of every usable vector.

    Entries c become x = floor(64 c) + 1,000,000. Equal x count as one vector
    whose fit weight is the number of its rows (``weights="count"``) or one
    (``"one"``); each is whitened once and joined back to its rows, the
    most frequent by broadcast.

    Returns for every row and component the id, ``component`` (from 1), ``n``
    and ``deviation`` (n vectors and sums S of the fit: sum of (n x - S)**2,
    null beyond 64 bits), ``whitened``, ``explained`` (share of all variance)
    and ``identity_error``. Rows whose vector is null, or holds a null or
    non-finite entry, go. Vectors of different lengths are whitened apart; the
    error is the largest of all. There are as many components as have variance,
    ``components`` at most, so vectors that are all equal, and empty ones, give
    no rows. Rows with the same id, or none, are returned each.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights must be count or one")
    vec = F.col("vec")
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(F.size("vec") > 0).where(finite).select("id", rounded(vec).alias("x"))
    keyed = rows.select("id", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"))
    counts = rows.groupBy("x").agg(F.count("*").alias("rows"))
    distinct = checkpointed(counts.select(
        "x", "rows", (F.col("rows") if weights == "count" else F.lit(1).cast("long")).alias("weight"),
        F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"),
    ))
    total = distinct.agg(F.sum("rows")).first()[0] or 0
    fitted = fit_whitening(distinct, components)

    def run(batches):
        for d, part, x in matrices(batches, ["x"]):
            model = fitted[d]
            w = model.centred(x) @ model.turn
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("h1", "h2", "rows", "weight")), pa.array(np.full(len(w), d, np.int32)),
                 pa.array(model.deviation(x), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                names=["h1", "h2", "rows", "weight", "d", "deviation", "w"],
            )

    usable = [d for d, model in fitted.items() if model.turn.shape[1]]
    schema = "h1 bigint, h2 bigint, rows bigint, weight bigint, d int, deviation bigint, w array<double>"
    whitened = checkpointed(distinct.where(F.size("x").isin(usable)).mapInArrow(run, schema))
    errors = [e for d in usable for e in identity_errors(whitened.where(F.col("d") == d)).values()]
    back = join_back(keyed, whitened, ["h1", "h2"], ["d", "deviation", "w"], F.col("rows"), total, F.col("id"))
    fits = back.where("d is not null").select("*", F.posexplode("w").alias("k", "value"))

    def per_length(value) -> Column:
        """A number of the fitted model by vector length and component."""
        out = F.lit(None)
        for d in usable:
            out = F.when(F.col("d") == d, value(fitted[d])).otherwise(out)
        return out

    explained = per_length(lambda m: F.get(F.array(*[F.lit(float(e)) for e in m.explained]), F.col("k")))
    return fits.select(
        F.col("id").alias(id_col), (F.col("k") + 1).cast("int").alias("component"),
        per_length(lambda m: F.lit(m.n).cast("long")).cast("long").alias("n"), "deviation", F.col("value").alias("whitened"),
        explained.cast("double").alias("explained"), F.lit(max(errors, default=None)).cast("double").alias("identity_error"),
    )
