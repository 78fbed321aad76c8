from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa

from plumbline.llm import repetition

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again)


def repeats(text):
    words = WORD.findall(text or "")
    n, longest = len(words), [0] * len(words)
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            longest[i], longest[j] = max(longest[i], k), max(longest[j], k)
    covered = {k for i in range(n) if longest[i] >= repetition.MIN_SPAN for k in range(i, i + longest[i])}
    return covered, max(longest, default=0)


def texts():
    rng = random.Random(4)
    out = [" ".join(rng.choice("abcdefgh") * rng.choice((1, 2)) for _ in range(rng.randrange(160))) for _ in range(60)]
    passage = " ".join(f"p{k}" for k in range(70))
    out += [f"{passage} middle {passage}", f"{passage}\n" * 3, passage, "a " * 500, "x y\nx y\n\n\nx y ", " \n\t", "", None, "é#é <é>", "b\n" * 40, "z"]
    out += ["one two three four five six seven eight nine ten", "one two three four five six seven eight nine"]
    return out


def test_counts_spans_and_verdicts(spark):
    rows = [(i, t, "x", i) for i, t in enumerate([*texts(), texts()[0]])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string, row int")
    got = repetition.repetition_rules(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        covered, longest = repeats(r.text)
        spans = {k for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for k in range(a, b)}
        assert spans == covered and r.covered_words == len(covered) and r.longest_repeat == longest
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        fits = len(covered) <= repetition.MAX_COVERED * want[0] and longest <= repetition.MAX_LONGEST
        assert r.kept == (not r.base_failed and fits) and r.row == r.doc_id


def test_long_repeat_in_a_long_text_fails():
    passage = " ".join(f"p{k}" for k in range(60))
    filler = " ".join(f"f{k}" for k in range(2000))
    m = repetition.measure(pa.array([f"{passage} {filler} {passage}"]))
    assert m["longest_repeat"][0] == 60 and m["n_repeat_words"][0] == 120


def test_no_rows(spark):
    assert repetition.repetition_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []
