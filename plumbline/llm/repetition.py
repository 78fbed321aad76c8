"""Quality rules on repetition inside a text, from suffix arrays over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.arrow import with_measures
from plumbline.llm.text import byte_table, flat, hash_spans, mix, spaces, word_spans

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_SPAN = 10
MAX_COVERED = 0.2
MAX_LONGEST = 50

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)  # fixed value


def suffix_array(symbols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes and the common prefix length of each with the next one.

    Rows never share a symbol, so no common prefix leaves its row. Ranks double
    the compared length each round; only suffixes that still tie are sorted
    again, and the ranks of all rounds give the common prefixes by descent.
    """
    n = len(symbols)
    end = np.repeat(rows[1:], np.diff(rows))
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = symbols[order[1:]] != symbols[order[:-1]]
    starts = np.flatnonzero(fresh)
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, size = [rank.copy()], 1
    tied = np.flatnonzero(np.bincount(rank[:n], minlength=n)[rank[:n]] > 1)
    while len(tied):
        follows = tied + size
        second = np.where(follows < end[tied], rank[np.minimum(follows, n)] + 1, 0)
        by = np.lexsort((second, rank[tied]))
        at, first, second = tied[by], rank[tied[by]], second[by]
        group = np.ones(len(at), bool)
        group[1:] = first[1:] != first[:-1]
        split = group.copy()
        split[1:] |= second[1:] != second[:-1]
        place = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(group, place, 0))
        sub = np.maximum.accumulate(np.where(split, place, 0))
        rank[at] = first + sub - begin
        sub_sizes = np.diff(np.append(np.flatnonzero(split), len(at)))
        tied = at[np.repeat(sub_sizes, sub_sizes) > 1]
        size *= 2
        if len(tied):
            levels.append(rank.copy())
    suffixes = np.empty(n, np.int64)
    suffixes[rank[:n]] = np.arange(n)
    common = np.zeros(n, np.int64)
    pairs = np.flatnonzero(levels[0][suffixes[:-1]] == levels[0][suffixes[1:]]) if n > 1 else np.zeros(0, np.int64)
    a, b = suffixes[pairs], suffixes[pairs + 1]
    reach = np.zeros(len(pairs), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + reach, n), np.minimum(b + reach, n)
        reach += np.where((levels[level][x] == levels[level][y]) & (x != y), 1 << level, 0)
    common[pairs] = reach
    return suffixes, common


def longest_repeats(suffixes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run of words from there that stands elsewhere too."""
    out = np.zeros(len(suffixes), np.int64)
    out[suffixes] = np.maximum(common, np.concatenate(([0], common[:-1])))
    return out


def cover(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def row_sums(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]


def row_max(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows) - 1, np.int64)
    some = np.flatnonzero(np.diff(rows))
    if len(some):
        out[some] = np.maximum.reduceat(values, rows[some])
    return out


def repeated_lines(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per row the lines with a word that equal an earlier line of the row."""
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((at[:-1][np.diff(at) > 0], breaks + 1)))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 10) if len(starts) else ends
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~spaces(data), out=inside[1:])
    some = inside[ends] > inside[starts]
    starts, ends = starts[some], ends[some]
    row = np.searchsorted(at, starts, "right") - 1
    keys = mix(hash_spans(data, starts, ends, table) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return np.bincount(row[again], minlength=len(at) - 1)


def measure(texts: pa.Array) -> dict[str, object]:
    table = byte_table(fold_case=False)
    data, at = flat(texts)
    starts, ends, rows = word_spans(data, at)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows)).astype(np.uint64)
    symbols = mix(hash_spans(data, starts, ends, table) + row * np.uint64(0xD6E8FEB86659FD93))
    repeat = longest_repeats(*suffix_array(symbols, rows))
    n = len(repeat)
    windows = np.flatnonzero(repeat >= WINDOW)
    # a run that the word before extends too is inside a longer one
    maximal = (repeat >= MIN_SPAN) & (np.concatenate(([0], repeat[:-1])) <= repeat)
    spans = np.flatnonzero(maximal)
    covered = cover(spans, repeat[spans], n)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    # spans of neighbouring rows can touch
    begins = np.unique(np.concatenate((edge[0::2], rows[:-1][(np.diff(rows) > 0)][covered[rows[:-1][np.diff(rows) > 0]]])))
    stops = np.minimum(edge[1::2][np.searchsorted(edge[1::2], begins, "right")], rows[np.searchsorted(rows, begins, "right")])
    of = np.searchsorted(rows, begins, "right") - 1
    local = np.stack((begins - rows[of], stops - rows[of]), axis=1).ravel()
    per_row = np.concatenate(([0], np.cumsum(2 * np.bincount(of, minlength=len(rows) - 1))))
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    word_chars = np.concatenate(([0], np.cumsum(chars[ends] - chars[starts])))
    return {
        "n_words": np.diff(rows),
        "word_chars": word_chars[rows[1:]] - word_chars[rows[:-1]],
        "n_symbols": row_sums(np.isin(data, SYMBOLS), at),
        "n_dup_lines": repeated_lines(data, at, table),
        "n_repeat_words": row_sums(cover(windows, np.full(len(windows), WINDOW), n), rows),
        "covered_words": row_sums(covered, rows),
        "longest_repeat": row_max(repeat, rows),
        "spans": pa.LargeListArray.from_arrays(pa.array(per_row), pa.array(local)).cast(pa.list_(pa.int64())),
    }


OWN = T.StructType([
    T.StructField(c, T.LongType())
    for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
] + [T.StructField("spans", T.ArrayType(T.LongType()))])


def repetition_rules(
    docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Word, symbol and repetition counts of every text and a verdict on them.

    Words are runs without ASCII white space; equal means equal bytes. The
    suffix array of a text's words gives for every position the longest run that
    stands elsewhere in the text. Runs of MIN_SPAN words or more that no longer
    run contains are its repeated passages: ``spans`` lists their union as word
    positions begin, end, begin, end..., ``covered_words`` its size, and
    ``longest_repeat`` is the longest run of any length.

    ``base_failed``: fewer than ``min_words`` words, or over ``max_repeat_percent``
    of them in 5-word windows that occur twice. ``kept``: neither that, nor more
    than ``max_covered`` of the words in repeated passages, nor a repeat longer
    than ``max_longest`` words.

    A null or empty text has no words and fails. Every row stands for itself, so
    repeated rows get equal verdicts; other columns pass through, those named
    like a result are replaced.
    """
    found = with_measures(docs, text_col, [c for c in keep or docs.columns if c not in ("base_failed", "kept")], OWN, measure)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    verdict = ~base & (F.col("covered_words") <= F.lit(max_covered) * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return found.withColumn("base_failed", base).withColumn("kept", verdict)
