from __future__ import annotations

import re
from collections import defaultdict

import pytest

from plumbline.llm.mixing import mix_sources, repeat_documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes, weights=(5, 2, 1)):
    """Reshare what stands above twice a source until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = goal - sum(2 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        now = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / free for s in order}
        more = {s for s in order if s not in capped and now[s] > 2 * sizes[s]}
        if not more or not free:
            return now
        capped |= more


def rows(n):
    out = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else [None, "Zed", "a", "é", "tiny"][i % 5] if i % 50 else "tiny"
        out.append((i, "w " * (i * 37 % 400 + 1), source, "x"))
    return out


def test_words_taken_meet_the_targets(spark):
    docs = [*rows(3000), (9001, None, "a", "x"), (9002, "", "a", "x"), (9003, "word\x0b" * 20000, "Zed", "x"), (5, "w " * 9, "a", "x"), (None, "w w", "a", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, taken string").selectExpr("*", "7 AS block", "8 AS rate")
    got = mix_sources(frame).collect()
    again = mix_sources(frame.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.size, str(r.source), r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(docs) and all(r.block == 7 and r.rate == 8 for r in got)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r.size == len(WORD.findall(r.text or ""))
        assert r.taken == r.copies * r.size and r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in got)
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 2 * max(r.size for r in got if r.source == s))


def test_mix_repeats_documents(spark):
    frame = spark.createDataFrame(rows(300), "doc_id long, text string, source string, x string")
    mixed = mix_sources(frame)
    repeated = repeat_documents(mixed, frame.columns)
    assert repeated.columns == frame.columns
    assert repeated.count() == sum(r.copies for r in mixed.collect())


def test_empty_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema)).collect() == []
    got = mix_sources(spark.createDataFrame([(1, None, None), (2, "", "s")], schema)).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
