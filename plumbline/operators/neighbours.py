"""Cells with bounding boxes over vectors, for exact neighbour searches.

A projection says little about a distance in several columns; the boxes of small
cells do. On wide one-hot tables a cell in which many columns are constant lies
far from every vector that differs in them.
A tree of column splits, fitted on a bounded sample, deals all vectors to cells;
the box of a cell holds the least and greatest value of every column over all
its vectors. A vector visits the cells whose box its search radius reaches, so
nothing is lost whatever the sample was.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.scratch import materialize_once

SAMPLE = 50_000
CELL_VECTORS = 32
MAX_CELLS = 20_000
MAX_BOX_VALUES = 4_000_000
STEP = 256
ASKED = 1_024


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


@dataclass
class Tree:
    """Splits in arrays: values of ``column`` up to ``cut`` go to node ``next``, others to the one after; a leaf has column -1 and its cell in ``next``."""

    column: np.ndarray
    cut: np.ndarray
    next: np.ndarray
    leaves: int

    def cells(self, v: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(v), np.int64), np.arange(len(v))
        while True:
            column = self.column[node]
            inner = column >= 0
            if not inner.any():
                return self.next[node]
            right = v[rows, np.maximum(column, 0)] > self.cut[node]
            node = np.where(inner, self.next[node] + right, node)


def fit_tree(sample: np.ndarray, leaf: float) -> Tree:
    """Halves the sample by its widest column until a part has ``leaf`` vectors at most or no column varies."""
    column, cut, follow, leaves = [-1], [0.0], [0], 0
    parts = [(0, np.arange(len(sample)))]
    while parts:
        node, rows = parts.pop()
        v = sample[rows]
        spread = np.ptp(v, axis=0) if len(rows) else np.zeros(sample.shape[1])
        if len(rows) <= leaf or not (spread > 0).any():
            follow[node] = leaves
            leaves += 1
            continue
        widest = int(v.var(axis=0).argmax()) if v.var(axis=0).max() > 0 else int(spread.argmax())
        values = np.unique(v[:, widest])
        middle = int(np.clip(np.searchsorted(values, np.median(v[:, widest]), "right") - 1, 0, len(values) - 2))
        below = v[:, widest] <= values[middle]
        column[node], cut[node], follow[node] = widest, values[middle], len(column)
        parts += [(len(column), rows[below]), (len(column) + 1, rows[~below])]
        column += [-1, -1]
        cut += [0.0, 0.0]
        follow += [0, 0]
    return Tree(np.array(column), np.array(cut), np.array(follow), leaves)


@dataclass
class Boxes:
    """Least and greatest values of every cell and its number of vectors, and the same for every node of the tree; empty cells hold none."""

    tree: Tree
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray

    def __post_init__(self) -> None:
        leaf, cell = self.tree.column < 0, self.tree.next
        shape = (len(leaf), self.low.shape[1])
        self.node_low, self.node_high, self.node_rows = np.full(shape, np.inf), np.full(shape, -np.inf), np.zeros(len(leaf), np.int64)
        self.node_low[leaf], self.node_high[leaf], self.node_rows[leaf] = self.low[cell[leaf]], self.high[cell[leaf]], self.rows[cell[leaf]]
        for node in np.flatnonzero(~leaf)[::-1]:  # children stand behind their parent
            below = slice(cell[node], cell[node] + 2)
            self.node_low[node], self.node_high[node] = self.node_low[below].min(axis=0), self.node_high[below].max(axis=0)
            self.node_rows[node] = self.node_rows[below].sum()

    def distances(self, v: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance of every vector to the nearest and to the farthest point of the box of its node."""
        near, far = np.zeros(len(v)), np.zeros(len(v))
        for i in range(v.shape[1]):
            below, above = self.node_low[node, i] - v[:, i], v[:, i] - self.node_high[node, i]
            near += np.maximum(np.maximum(below, above), 0) ** 2
            far += np.maximum(np.abs(below), np.abs(above)) ** 2
        return near, far

    def reached(self, v: np.ndarray, needed: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (vector, cell) whose box is within the vector's squared ``reach``, and the reach.

        All vectors go down the tree together, a level at a time. On the way the
        reach falls to the farthest point of the boxes that hold ``needed`` other
        vectors, so a vector meets the nodes around it and not all cells.
        """
        reach = reach.copy()
        row, node = np.arange(len(v)), np.zeros(len(v), np.int64)
        while True:
            near, far = self.distances(v[row], node)
            order = np.lexsort((far, row))
            sorted_row, counts = row[order], self.node_rows[node[order]]
            total = np.cumsum(counts)
            start = np.searchsorted(sorted_row, np.arange(len(v)))
            before = total[start] - counts[start]
            # the vector itself may be among those counted
            enough = np.flatnonzero(total - before[sorted_row] > needed[sorted_row])
            which, place = np.unique(sorted_row[enough], return_index=True)
            reach[which] = np.minimum(reach[which], far[order][enough[place]] * (1 + 1e-9))
            near_enough = near <= reach[row]
            row, node = row[near_enough], node[near_enough]
            inner = self.tree.column[node] >= 0
            if not inner.any():
                return row, self.tree.next[node], reach
            times = np.where(inner, 2, 1)
            child = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, node = np.repeat(row, times), np.repeat(np.where(inner, self.tree.next[node], node), times) + child
            some = self.node_rows[node] > 0
            row, node = row[some], node[some]


def with_cells(vectors: DataFrame, cell_vectors: int = CELL_VECTORS) -> tuple[DataFrame, Boxes]:
    """The vectors (``vid, v`` and more) with their ``cell``, written once, and the boxes of all cells.

    The driver gets SAMPLE vectors and two vectors for each of at most MAX_CELLS cells.
    """
    n = vectors.count()
    # ids are digests, so those that are lowest are a sample
    share = min(1.0, SAMPLE / max(n, 1))
    picked = vectors.where(F.conv(F.substring("vid", 1, 8), 16, 10).cast("bigint") <= F.lit(int(share * 0xFFFFFFFF)))
    sample = np.array([r.v for r in picked.orderBy("vid").limit(2 * SAMPLE).select("v").collect()], np.float64)
    sample = sample.reshape(len(sample), -1) if len(sample) else np.zeros((1, 1))
    most = max(1, min(MAX_CELLS, MAX_BOX_VALUES // max(sample.shape[1], 1)))
    wanted = min(most, max(1, -(-n // cell_vectors)))
    tree = fit_tree(sample, max(len(sample) / wanted, 1))
    schema = vectors.schema

    def place(batches):
        for batch in batches:
            cells = tree.cells(matrix(batch.column("v"))) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], names=[*batch.schema.names, "cell"])

    placed = materialize_once(
        vectors.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", cell int"), "cells"
    )

    def partial(batches):
        low = high = rows = None
        for batch in batches:
            if not len(batch):
                continue
            v, cell = matrix(batch.column("v")), np.asarray(batch.column("cell"))
            if low is None:
                low, high = np.full((tree.leaves, v.shape[1]), np.inf), np.full((tree.leaves, v.shape[1]), -np.inf)
                rows = np.zeros(tree.leaves, np.int64)
            np.minimum.at(low, cell, v)
            np.maximum.at(high, cell, v)
            rows += np.bincount(cell, minlength=tree.leaves)
        if low is not None:
            some = np.flatnonzero(rows)
            at, i = np.repeat(some, low.shape[1]), np.tile(np.arange(low.shape[1]), len(some))
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(at.astype(np.int32)), "i": pa.array(i.astype(np.int32)),
                "low": pa.array(low[at, i]), "high": pa.array(high[at, i]), "rows": pa.array(rows[at]),
            })

    edges = placed.select("v", "cell").mapInArrow(partial, "cell int, i int, low double, high double, rows bigint")
    found = edges.groupBy("cell", "i").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows")).toPandas()
    shape = (tree.leaves, sample.shape[1])
    low, high, rows = np.full(shape, np.inf), np.full(shape, -np.inf), np.zeros(tree.leaves, np.int64)
    cell, i = found.cell.to_numpy(int), found.i.to_numpy(int)
    low[cell, i], high[cell, i], rows[cell] = found.low, found.high, found.rows
    return placed, Boxes(tree, low, high, rows)


def visits(placed: DataFrame, boxes: Boxes, k: int) -> DataFrame:
    """``vid, copies, needed, reach2, v, cell``: the cells that may hold one of the nearest vectors of each vector.

    ``needed`` is ``k`` less its other copies. ``reach2`` bounds the squared
    distance to that many other vectors from above: by the vectors of its own
    cell, and by the farthest points of the boxes of enough vectors. Cells whose
    box is farther away hold no neighbour. Boxes of the tree's nodes rule out
    most cells many at a time.
    """

    def bound(table: pa.Table) -> pa.Table:
        v, needed = matrix(table.column("v").combine_chunks()), np.asarray(table.column("needed"))
        reach = np.full(len(v), np.inf)
        for s in range(0, len(v), STEP):
            part = slice(s, s + STEP)
            d = np.zeros((len(v[part]), len(v)))
            for i in range(v.shape[1]):
                d += (v[part, i, None] - v[:, i]) ** 2
            d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
            d.partition(min(k, len(v) - 1), axis=1)
            d = np.sort(d[:, :k], axis=1)
            at = np.maximum(needed[part] - 1, 0)
            have = at < d.shape[1]
            reach[part] = np.where(have, d[np.arange(len(d)), np.minimum(at, d.shape[1] - 1)], np.inf)
        return table.append_column("reach2", pa.array(reach * (1 + 1e-9)))

    def run(batches):
        for batch in batches:
            for s in range(0, len(batch), ASKED):
                part = batch.slice(s, ASKED)
                row, cell, reach = boxes.reached(matrix(part.column("v")), np.asarray(part.column("needed")), np.asarray(part.column("reach2")))
                out = part.select(["vid", "copies", "needed"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(reach[row]), part.column("v").take(pa.array(row)), pa.array(cell.astype(np.int32))],
                    names=["vid", "copies", "needed", "reach2", "v", "cell"],
                )

    asking = placed.withColumn("needed", F.lit(k) - (F.col("copies") - 1)).select("vid", "copies", "needed", "v", "cell")
    bounded = asking.groupBy("cell").applyInArrow(bound, "vid string, copies bigint, needed bigint, v array<double>, cell int, reach2 double")
    return bounded.where("needed > 0").mapInArrow(run, "vid string, copies bigint, needed bigint, reach2 double, v array<double>, cell int")
