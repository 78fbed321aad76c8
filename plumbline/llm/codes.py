"""Near-duplicate vectors by randomly rotated binary codes with correction factors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import connected_components
from plumbline.llm.shared import checkpointed
from plumbline.llm.text import mix

COSINE = 0.93
RECALL = 0.999
CELL = 1024
BLOCK = 1024
CONFIDENCE = 4.0  # widths of the estimator's error bound
SEED = 11


def index_shape(vectors: int) -> tuple[int, int]:
    """Bits of a cell number and bands of cells, so that cells hold about CELL vectors and RECALL of the links share one.

    Both follow from the number of vectors of the largest label: a rotated
    coordinate of two vectors at the threshold has the same sign with chance
    ``1 - angle / pi``.
    """
    bits = max(0, math.ceil(math.log2(max(vectors, 1) / CELL)))
    same = (1 - math.acos(COSINE) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(1 - RECALL) / math.log(1 - same))


def rotations(dimensions: int, bits: int, bands: int) -> np.ndarray:
    """(r, d, d) random orthogonal matrices with enough coordinates for every band's bits."""
    count = max(2, -(-bits * bands // dimensions))
    rng = np.random.default_rng([SEED, dimensions])
    return np.stack([np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0] for _ in range(count)])


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cells(signs: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """Cell number of every vector in every band: ``bits`` signs of its own."""
    out = np.zeros((len(signs), bands), np.uint64)
    for b in range(bits):
        out = out * np.uint64(2) + signs[:, b : bits * bands : bits][:, :bands].astype(np.uint64)
    return out


class Coded:
    """Unit vectors, their rotations, sign codes and what corrects the codes' inner products."""

    def __init__(self, vectors: np.ndarray, bits: int, bands: int):
        turns = rotations(vectors.shape[1], bits, bands)
        self.unit = unit(vectors)
        self.turned = np.einsum("rij,nj->nri", turns, self.unit)
        self.signs = self.turned > 0
        self.code = np.where(self.signs, 1.0, -1.0) / math.sqrt(vectors.shape[1])
        self.factor = np.maximum((self.code * self.turned).sum(axis=2), 1e-6)
        self.cell = cells(self.signs.reshape(len(vectors), -1), bits, bands)

    def estimates(self, other: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Unbiased inner products of own codes with the other's vectors, and half the width of their bounds."""
        count, d = self.factor.shape[1], self.unit.shape[1]
        left = (self.code / self.factor[:, :, None] / count).reshape(len(self.unit), -1).astype(np.float32)
        found = left @ other.turned.reshape(len(other.unit), -1).astype(np.float32).T
        spread = np.sqrt((1 / self.factor**2 - 1).clip(0).mean(axis=1) / (count * max(d - 1, 1)))
        return found, CONFIDENCE * spread[:, None]


def linked_pairs(a: Coded, b: Coded, same: bool, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at COSINE or more that share this band's cell and no earlier one."""
    about, width = a.estimates(b)
    maybe = about >= COSINE - width
    if same:
        maybe &= np.triu(np.ones(maybe.shape, bool), 1)
    i, j = np.nonzero(maybe)
    near = np.zeros(len(i), bool)
    for s in range(0, len(i), 1 << 16):
        part = slice(s, s + (1 << 16))
        near[part] = np.einsum("nd,nd->n", a.unit[i[part]], b.unit[j[part]]) >= COSINE
    i, j = i[near], j[near]
    fresh = ~(a.cell[i, :band] == b.cell[j, :band]).any(axis=1)
    return i[fresh], j[fresh]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position each of n positions reaches by links (i, j)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def vectors_of(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Links of cosine 0.93 or more between vectors of equal label, and their groups.

    Equal vectors of a label count as one with its number of ids. Signs of
    randomly rotated coordinates put every vector into one cell of each band; a
    cell is compared block by block inside tasks. Codes with their correction
    factors give unbiased inner products; pairs whose upper bound reaches the
    threshold are computed again in double precision. A pair counts in the first
    band where it meets. Tasks return link counts and, for the groups, one
    row per vector, never pairs. So the rows do not grow with the size of a
    group; the comparisons within one cell do, in blocks over many tasks.

    Returns id, ``n_links`` (other ids linked directly), ``component_id`` and
    ``kept``. A vector that is null, empty, zero or has a null or non-finite
    component, or whose label is null, has no links and is its own component.
    Vectors of different lengths do not compare. Repeated rows of an id and
    vector count once as a partner and each get the result; rows without an id
    get null ``component_id`` and ``kept``.
    """
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")).select(
        "*", valid.alias("valid"), F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")
    )
    use = rows.where("valid")
    keys = ["label", "h1", "h2"]
    ids = use.groupBy(*keys, "id").agg(F.lit(1).alias("one"))
    groups = checkpointed(ids.groupBy(*keys).agg(F.min("id").alias("rep"), F.count("*").alias("mult")))
    first = groups.withColumnRenamed("rep", "id")
    reps = checkpointed(
        use.join(first, [*keys, "id"]).select("label", F.size("vec").alias("dim"), "id", "mult", "vec").dropDuplicates(["label", "id"])
    )
    largest = reps.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, bands = index_shape(largest)

    def encode(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                coded = Coded(vectors_of(part.column("vec")), bits, bands)
                for band in range(bands):
                    cell = pa.array(mix(coded.cell[:, band] + np.uint64((band + 1) << 40)).view(np.int64))
                    number = pa.array(np.full(len(part), band, np.int32))
                    yield pa.RecordBatch.from_arrays([*part.columns, number, cell], names=[*part.schema.names, "band", "cell"])

    celled = reps.mapInArrow(encode, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in reps.schema)}, band int, cell bigint")
    cell = ["label", "dim", "band", "cell"]
    blocks = checkpointed(
        celled.groupBy(*cell).count().select(*cell, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")).where("blocks >= 1")
    )
    placed = celled.join(blocks, cell).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *cell, F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "id", "mult", "vec"
    )

    def compare(group: pa.Table) -> pa.Table:
        band, p, q = (group.column(c)[0].as_py() for c in ("band", "p", "q"))
        mine = np.asarray(group.column("mine"))
        side = [np.flatnonzero(mine == p), np.flatnonzero(mine == q)]
        id_, mult = np.asarray(group.column("id")), np.asarray(group.column("mult"))
        vecs = vectors_of(group.column("vec").combine_chunks())
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not len(side[0]) or not len(side[1]):
            return none
        coded = [Coded(vecs[s], bits, bands) for s in side[: 1 if p == q else 2]]
        i, j = linked_pairs(coded[0], coded[-1], p == q, band)
        i, j = side[0][i], side[1][j]
        n = np.bincount(i, mult[j], len(mine)) + np.bincount(j, mult[i], len(mine))
        some = np.flatnonzero(n)
        root = forest(len(mine), i, j)[some]
        return pa.table({"a": pa.array(id_[some]), "b": pa.array(id_[root]), "n": pa.array(n[some].astype(np.int64))})

    found = checkpointed(spread.groupBy(*cell, "p", "q").applyInArrow(compare, "a bigint, b bigint, n bigint"))
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    component = connected_components(found.select("a", "b")).withColumnRenamed("id", "rep")
    result = checkpointed(groups.join(counts, "rep", "left").join(component, "rep", "left").select(
        *keys, (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("component", "rep").alias("component")
    ))
    known = F.when(F.col("valid"), F.struct("label", "h1", "h2"))
    joined = rows.select("id", known.alias("k")).join(result.select(F.struct(*keys).alias("k"), "n", "component"), "k", "left")
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"), (F.col("id") == F.coalesce("component", "id")).alias("kept"),
    )
