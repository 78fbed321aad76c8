"""Whole text columns as flat numpy arrays: words, word hashes and n-gram hashes.

Everything works on the UTF-8 bytes of an Arrow batch at once, in chunks of a
few megabytes, so a batch of tiny rows and one very long text cost alike.
Hashes are 64-bit; equal hashes are treated as equal words or shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 19

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_MULTIPLIER = 0x5851F42D4C957F2D
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_table(fold_case: bool) -> np.ndarray:
    """A 64-bit number for each byte value; with ``fold_case`` A-Z share those of a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if fold_case:
        table[65:91] = table[97:123]
    return table


def powers(n: int, base: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the n+1 offsets between them; a null is empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        _, at = flat(batch.column(text))
        start = 0
        while start < len(batch):
            stop = max(int(np.searchsorted(at, at[start] + size, "right")) - 1, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for n rows the n+1 offsets into the words."""
    inside = ~spaces(data)
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = ~inside[:-1]
    first[at] = True  # no word crosses rows
    starts = np.flatnonzero(inside & first[:-1])
    last = np.ones(len(data) + 1, bool)
    last[:-1] = ~inside if len(data) else True
    last[at] = True
    ends = np.flatnonzero(inside & last[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span (sorted, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    power, inverse = powers(0, _MULTIPLIER), powers(0, _INVERSE)
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, "right")), i + 1)
        low, size = starts[i], int(ends[j - 1] - starts[i])
        if size > len(power):
            power, inverse = powers(max(size, BLOCK_BYTES), _MULTIPLIER), powers(max(size, BLOCK_BYTES), _INVERSE)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(table[data[low : low + size]] * power[:size], out=total[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (total[b] - total[a]) * inverse[a] + b.astype(np.uint64) - a.astype(np.uint64)
        i = j
    return mix(out)


def word_hashes(column: pa.Array, fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a text column, and the offsets of the rows in them."""
    data, at = flat(column)
    starts, ends, rows = word_spans(data, at)
    return hash_spans(data, starts, ends, byte_table(fold_case)), rows


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words of one flat array."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for j, p in enumerate(powers(size, 0xD1342543DE82EF95)):
        total += words[j : j + n] * p
    return mix(total + np.uint64(size))
