"""Runs of periodic words in a text, by longest common extensions over a difference cover."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.llm.arrow import with_measures
from plumbline.llm.text import word_hashes

MIN_RUN = 12
STRIDE = 31
# Every difference modulo 31 is one between two of these.
COVER = np.array([1, 5, 11, 24, 25, 27])
PAIRS = 1 << 20


def _shifts() -> np.ndarray:
    """shift[a, b]: steps from positions of residues a and b until both lie in the cover."""
    inside = np.zeros(STRIDE, bool)
    inside[COVER] = True
    out = np.full((STRIDE, STRIDE), STRIDE, np.int64)
    a = np.arange(STRIDE)
    for step in range(STRIDE - 1, -1, -1):
        both = inside[(a[:, None] + step) % STRIDE] & inside[(a + step) % STRIDE]
        out[both] = step
    return out


SHIFT = _shifts()


def ranked(keys: np.ndarray) -> np.ndarray:
    """Rank of every row of (n, k) keys among the distinct rows in order."""
    if not len(keys):
        return np.zeros(0, np.int64)
    by = np.lexsort(keys.T[::-1])
    fresh = np.zeros(len(keys), np.int64)
    fresh[1:] = (keys[by[1:]] != keys[by[:-1]]).any(axis=1)
    out = np.empty(len(keys), np.int64)
    out[by] = np.cumsum(fresh)
    return out


def sort_blocks(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every suffix of a sequence of names, and the common prefixes of neighbours in that order.

    Ranks double the compared length; suffixes that no longer tie are not sorted
    again. The ranks of all rounds give the common prefixes by descent.
    """
    n = len(names)
    levels, rank, size = [names], ranked(names[:, None]), 1
    while n and rank.max() < n - 1:
        levels.append(rank)
        after = np.zeros(n, np.int64)
        after[: max(n - size, 0)] = rank[size:] + 1
        open_ = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        split = ranked(np.stack((rank[open_], after[open_]), axis=1))
        # ranks become positions, so that a split moves no rank outside its group
        place = np.cumsum(np.bincount(rank, minlength=n)) - np.bincount(rank, minlength=n)
        rank = place[rank]
        if len(open_):
            counts = np.bincount(split)
            first = np.cumsum(counts) - counts
            group = np.zeros(len(counts), np.int64)
            group[split] = rank[open_]
            start = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, first, 0))
            rank[open_] = group[split] + (first - start)[split]
        rank = ranked(rank[:, None])
        size *= 2
    order = np.argsort(rank, kind="stable")
    common = np.zeros(n, np.int64)
    a, b, reach = order[:-1], order[1:], np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + reach, b + reach
        fits = np.flatnonzero((x < n) & (y < n))
        same = fits[levels[k][x[fits]] == levels[k][y[fits]]]
        step = 1 if k == 0 else 1 << (k - 1)
        # a rank of length 2**k also agrees where both suffixes end within it
        reach[same] += np.minimum(step, n - np.maximum(x[same], y[same]))
    common[1:] = reach
    return rank, common


class Extensions:
    """Longest common extensions to the right of any two positions of a word sequence.

    Only suffixes at positions whose residue lies in the cover are sorted, as
    blocks of STRIDE words. Two positions are compared word by word until both
    reach such a position, STRIDE words at most; from there the minimum of the
    common prefixes between their ranks answers.
    """

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        self.words = np.concatenate((words, np.full(2 * STRIDE, -1)))
        starts = [np.arange(r, n, STRIDE) for r in COVER]
        # blocks past the end are below all words; each residue ends in one, so no suffix passes into the next residue
        starts = [np.append(s, s[-1] + STRIDE if len(s) else n) for s in starts]
        at = np.concatenate(starts)
        width = max(int(words.max(initial=0)) + 2, 2).bit_length()
        per = max(1, 63 // width)
        keys = np.zeros((len(at), -(-STRIDE // per)), np.int64)
        for k in range(STRIDE):
            word = self.words[np.minimum(at + k, n)] + 1
            keys[:, k // per] = keys[:, k // per] << width | word
        # the ends of residues differ from each other and from all blocks
        keys = np.column_stack((keys, np.zeros(len(at), np.int64)))
        keys[np.cumsum([len(s) for s in starts]) - 1, -1] = np.arange(1, len(COVER) + 1)
        blocks = ranked(keys)
        rank, common = sort_blocks(blocks)
        order = np.argsort(rank, kind="stable")
        # common blocks to common words: the first blocks that differ are compared word by word
        a, b = at[order[:-1]] + common[1:] * STRIDE, at[order[1:]] + common[1:] * STRIDE
        length = np.zeros(len(at), np.int32)
        length[1:] = common[1:] * STRIDE + self._walk(a, b, np.full(len(a), STRIDE))
        self.rank = np.full(n + STRIDE + 1, -1, np.int64)
        self.rank[np.minimum(at, n + STRIDE)] = rank
        self.table = [length]
        while 2 << (len(self.table) - 1) <= len(length):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _walk(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from positions a and b on, ``most`` at most."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for step in range(STRIDE):
            x, y = a[live] + step, b[live] + step
            here = (step < most[live]) & (x < self.n) & (y < self.n)
            here[here] = self.words[x[here]] == self.words[y[here]]
            live = live[here]
            out[live] = step + 1
            if not len(live):
                break
        return out

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of positions i != j."""
        shift = SHIFT[i % STRIDE, j % STRIDE]
        out = self._walk(i, j, shift)
        far = np.flatnonzero((out == shift) & (i + shift < self.n) & (j + shift < self.n))
        x, y = self.rank[i[far] + shift[far]], self.rank[j[far] + shift[far]]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            some = level == k
            row = self.table[k]
            out[far[some]] += np.minimum(row[low[some]], row[high[some] - (1 << int(k)) + 1])
        return out


def grid_pairs(words: np.ndarray, rows: np.ndarray):
    """Blocks of (position, period): every multiple of every period up to half the row whose word stands again a period later."""
    sizes = np.diff(rows)
    for row in np.flatnonzero(sizes > 1):
        low, n = int(rows[row]), int(sizes[row])
        periods = np.arange(1, n // 2 + 1)
        counts = (n - 1) // periods  # multiples k with k * period + period < n
        at = np.concatenate(([0], np.cumsum(counts)))
        start = 0
        while start < len(periods):
            stop = max(start + 1, int(np.searchsorted(at, at[start] + PAIRS, "right")) - 1)
            period = np.repeat(periods[start:stop], counts[start:stop])
            k = np.arange(len(period)) - np.repeat(at[start:stop] - at[start], counts[start:stop])
            i = low + k * period
            same = words[i] == words[i + period]
            yield np.full(int(same.sum()), row), i[same], period[same]
            start = stop


def runs_of(words: np.ndarray, rows: np.ndarray, least: int = MIN_RUN) -> tuple[np.ndarray, ...]:
    """All runs as arrays (row, start, length, period) by row, start and period; rows must not share words at their borders.

    A run of period p holds a multiple of p whose word stands again p later, so
    the multiples of each period are enough. Extensions to both sides give the
    stretch; of the periods of a stretch the smallest counts.
    """
    n = len(words)
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    found, held = [], 0
    ahead = back = None

    def flush(parts):
        row, start, stop, period = (np.concatenate(p) for p in zip(*parts, strict=True))
        by = np.lexsort((period, stop, start))
        fresh = np.ones(len(by), bool)
        fresh[1:] = (start[by[1:]] != start[by[:-1]]) | (stop[by[1:]] != stop[by[:-1]])
        by = by[fresh]
        return row[by], start[by], stop[by], period[by]

    def extend(row, i, period):
        nonlocal ahead, back, held, found
        if ahead is None:
            ahead, back = Extensions(words), Extensions(words[::-1].copy())
        j = i + period
        # rows touch in the flat sequence, so extensions stop at the row's ends
        right = np.minimum(ahead.between(i, j), rows[row + 1] - j)
        left = np.zeros(len(i), np.int64)
        some = np.flatnonzero(i > rows[row])
        left[some] = np.minimum(back.between(n - i[some], n - j[some]), i[some] - rows[row[some]])
        some = (left + right >= period) & (left + right + period >= least)
        found.append((row[some], (i - left)[some], (j + right)[some], period[some]))
        held += len(found[-1][0])
        if held > 4 * PAIRS:
            found = [flush(found)]
            held = len(found[0][0])

    waiting, count = [], 0
    for part in grid_pairs(words, rows):
        waiting.append(part)
        count += len(part[0])
        if count >= PAIRS:
            extend(*(np.concatenate(p) for p in zip(*waiting, strict=True)))
            waiting, count = [], 0
    if count:
        extend(*(np.concatenate(p) for p in zip(*waiting, strict=True)))
    if not held:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    row, start, stop, period = flush(found)
    by = np.lexsort((period, start))
    return row[by], (start - rows[row])[by], (stop - start)[by], period[by]


def numbered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of a text column as small numbers, and the offsets of the rows in them."""
    hashes, rows = word_hashes(column, fold_case=False)
    return np.unique(hashes, return_inverse=True)[1].astype(np.int64), rows


def collapse(texts: list[bytes | None], rows: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[str]:
    """The words of each text outside the repeats of its runs, joined by one space."""
    steps = np.bincount(rows[row] + start + period, minlength=rows[-1] + 1) - np.bincount(rows[row] + start + length, minlength=rows[-1] + 1)
    dropped = np.cumsum(steps[:-1]) > 0
    out = []
    for k, text in enumerate(texts):
        words = (text or b"").split()  # the same white space as that between words
        gone = dropped[rows[k] : rows[k + 1]]
        if gone.any():
            words = [words[i] for i in np.flatnonzero(~gone)]
        out.append(b" ".join(words).decode())
    return out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OWN = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
])


def measure(texts: pa.Array, least: int = MIN_RUN) -> dict[str, object]:
    words, rows = numbered(texts)
    row, start, length, period = runs_of(words, rows, least)
    per_row = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(texts)))))
    runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN))
    raw = texts.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
    return {
        "n_words": np.diff(rows),
        "runs": pa.LargeListArray.from_arrays(pa.array(per_row), runs).cast(pa.list_(RUN)),
        "collapsed": collapse(raw, rows, row, start, length, period),
    }


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """Every run of periodic words of every text, and the text without the repeats.

    Words are spans without ASCII white space, numbered from 0; equal means equal
    bytes. A run is a stretch with smallest period p whose words p apart are
    equal, of at least ``min_run`` words and two periods, that no neighbouring
    word extends. ``runs`` lists them by start and period; ``collapsed`` has the
    words that no run holds behind its first period, joined by one space.

    Memory follows one text, at about 40 bytes a word, or batches of a few MB. A
    null, empty or blank text has no words, no runs and an empty ``collapsed``.
    Every row stands for itself, so repeated rows get equal results; other
    columns pass through, those named like a result are replaced.
    """
    return with_measures(docs, text_col, keep, OWN, lambda texts: measure(texts, min_run))
