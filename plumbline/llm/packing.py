"""Packing token sequences by a configuration linear program over the length histogram."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.ranks import block_offsets, hash_block, rank_in_blocks, sub_blocks
from plumbline.llm.shared import batches_of, checkpointed
from plumbline.llm.text import chunks
from plumbline.llm.tokens import BytePairEncoder

CAPACITY = 1024
END = 2
STEP = 0.25
SHARPNESS = 8.0
PASSES_PER_LENGTH = 3
ENCODE_BYTES = 1 << 19  # encoding holds some sixty bytes for each byte of text
BATCH_BYTES = 4 * ENCODE_BYTES


def price(values: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: how many of each length 1..capacity the dearest sequence holds."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        gain = best[c - 1 :: -1][:c] + values[1 : c + 1]
        k = int(gain.argmax())
        best[c], took[c] = (gain[k], k + 1) if gain[k] > best[c - 1] else (best[c - 1], 0)
    counts = np.zeros(capacity + 1, np.int64)
    c = capacity
    while c > 0:
        counts[took[c]] += took[c] > 0
        c -= took[c] or 1
    return counts


def fractional(need: np.ndarray, capacity: int) -> tuple[dict[tuple, float], float]:
    """Configurations with weights that cover ``need`` per length, and a lower bound on their number.

    Multiplicative weights: a length's price falls exponentially with its
    coverage, the knapsack finds the configuration of most value, and a step of
    it is added until every length is covered. Any prices, divided by the value
    of their best configuration, bound the number of sequences from below.
    """
    lengths = np.flatnonzero(need)
    covered = np.zeros(capacity + 1)
    weights: dict[tuple, float] = {}
    bound = float((need * np.arange(capacity + 1)).sum() / capacity)
    for _ in range(PASSES_PER_LENGTH * len(lengths)):
        if (covered[lengths] >= 1).all():
            break
        values = np.zeros(capacity + 1)
        values[lengths] = np.exp(-SHARPNESS * covered[lengths]) / need[lengths]
        counts = price(values, capacity)
        bound = max(bound, float((values * need).sum() / (values @ counts)))
        used = np.flatnonzero(counts)
        amount = STEP * (need[used] / counts[used]).min()
        covered[used] += amount * counts[used] / need[used]
        key = tuple((int(l), int(counts[l])) for l in used)
        weights[key] = weights.get(key, 0.0) + amount
    return weights, bound


def fullest(left: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """A sequence with the longest remaining piece, filled up as far as remaining pieces can: subset sums as bits."""
    longest = int(np.flatnonzero(left)[-1])
    room = capacity - longest
    steps, reach = [], 1
    mask = (1 << (room + 1)) - 1
    for l in np.flatnonzero(left[: room + 1])[::-1]:
        have = int(min(left[l] - (l == longest), room // l))
        chunk = 1
        while have > 0 and not reach >> room & 1:
            take = min(chunk, have)
            steps.append((reach, int(l), take))
            reach |= reach << (int(l) * take) & mask
            have, chunk = have - take, chunk * 2
    at = reach.bit_length() - 1
    counts = {longest: 1}
    for before, l, take in reversed(steps):
        if not before >> at & 1:
            counts[l] = counts.get(l, 0) + take
            at -= l * take
    return sorted(counts.items())


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[list[tuple[int, int]], int]], float]:
    """Patterns with their multiplicities that hold exactly the pieces of the histogram, and the lower bound.

    The fractional solution is rounded down, fullest configurations first; what
    remains is packed by filling sequences up. The number of patterns depends on
    the capacity, not on the number of pieces.
    """
    left = histogram.astype(np.int64).copy()
    patterns = []
    if left[capacity]:
        patterns.append(([(capacity, 1)], int(left[capacity])))
        full, left[capacity] = int(left[capacity]), 0
    else:
        full = 0
    weights, bound = fractional(left.astype(float), capacity) if left.any() else ({}, 0.0)
    for key, weight in sorted(weights.items(), key=lambda kv: (-sum(l * c for l, c in kv[0]), -kv[1], kv[0])):
        times = min([int(weight), *(int(left[l]) // c for l, c in key)])
        if times > 0:
            patterns.append((list(key), times))
            for l, c in key:
                left[l] -= c * times
    while left.any():
        key = fullest(left, capacity)
        times = max(1, min(int(left[l]) // c for l, c in key))
        patterns.append((key, times))
        for l, c in key:
            left[l] -= c * times
    return patterns, full + bound


def slots(patterns: list[tuple[list[tuple[int, int]], int]], capacity: int) -> dict[str, np.ndarray]:
    """Ranges of ranks per length and where the pieces of a range go; sorted by length and rank."""
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for key, times in patterns:
        offset = 0
        for l, c in key:
            rows.append((l, used[l], c, sequence, offset))
            used[l] += c * times
            offset += l * c
        sequence += times
    rows.sort()
    return {n: np.array([r[k] for r in rows], np.int64) for k, n in enumerate(("length", "first", "each", "sequence", "offset"))}


def pieces_of(docs: DataFrame, tokenizer: str | Path, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's tokens, cut only if over capacity."""
    path = str(tokenizer)

    def run(batches):
        encoder = BytePairEncoder(path)
        for part in chunks(batches, "text", ENCODE_BYTES):
            out = [[], [], [], [], []]
            for doc, ids in zip(part.column("id").to_pylist(), encoder.encode(part.column("text")), strict=True):
                raw = np.append(ids, END).astype("<u4")
                n = len(raw)
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for column, value in zip(out, (doc, k, a, b - a, zlib.crc32(raw[a:b].tobytes())), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack_documents(
    docs: DataFrame, tokenizer: str | Path, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
) -> DataFrame:
    """Places every token of every document into as few sequences of ``capacity`` tokens as it can.

    A document is its token ids and END; a null or empty text is END alone. Only
    longer ones are cut, into full pieces behind a first one with the remainder.
    The driver solves the packing on the histogram of piece lengths, at most
    ``capacity`` numbers, and gets patterns of lengths with multiplicities. The
    k-th piece of a length (by a hash of the id, id and piece) goes to the
    pattern whose range of ranks holds k; ranks are counted in blocks, so no
    length is gathered in one task.

    Returns one row per piece. Repeated rows are documents of their own and are
    packed each; other columns are ignored. An empty table gives no rows.
    """
    with batches_of(docs.sparkSession, BATCH_BYTES):
        pieces = checkpointed(pieces_of(docs, tokenizer, id_col, text_col, capacity))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        histogram[length] = n
    table = slots(plan(histogram, capacity)[0], capacity)
    key = F.concat_ws(":", "doc_id", "piece", "ids_crc32")
    rows = pieces.withColumn("block", hash_block(key, sub_blocks(int(histogram.sum()))))
    counts = rows.groupBy("length", "block").agg(F.count("*").alias("rows"))
    before = checkpointed(block_offsets(counts, ["length"], "block", "rows", "before").select("length", "block", "before"))
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = rank_in_blocks(rows.join(before, ["length", "block"]), ["length"], "block", order, "before", "k")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches):
        width = int(histogram.sum()) + 1
        starts = table["length"] * width + table["first"]
        for batch in batches:
            length, k = np.asarray(batch.column("length")), np.asarray(batch.column("k"))
            at = np.searchsorted(starts, length * width + k, "right") - 1
            nth = k - table["first"][at]
            own = [table["sequence"][at] + nth // table["each"][at], table["offset"][at] + nth % table["each"][at] * length]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *map(pa.array, own)], names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, "k").mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
