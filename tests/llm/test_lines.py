from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import lines


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return row[-1]


def brute(docs, min_chars):
    """Lines left of each (id, text): none earlier within one edit."""
    seen = {(i, t) for i, t in docs if t is not None}
    spots = [(i, t, no, raw.strip(" \t\r")) for i, t in seen for no, raw in enumerate(t.split("\n"))]
    spots = sorted((s for s in spots if len(s[3]) >= min_chars), key=lambda s: (s[0], s[2]))
    gone = set()
    for k, (i, t, no, line) in enumerate(spots):
        if any(abs(len(o[3]) - len(line)) < 2 and distance(o[3], line) < 2 for o in spots[:k]):
            gone.add((i, t, no))
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        parts = t.split("\n")
        left = [p for no, p in enumerate(parts) if (i, t, no) not in gone]
        out.append((i, "\n".join(left), len(parts), len(parts) - len(left)))
    return sorted(out, key=str)


def got(spark, docs, min_chars):
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS first", "1 AS n_removed", "2 AS id")
    found = lines.dedup_lines(frame, min_chars=min_chars).collect()
    assert all(r.first == "x" and r.id == 2 for r in found)
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found), key=str)


def changed(rng, line):
    k = rng.randrange(len(line))
    return rng.choice([line[:k] + line[k + 1:], line[:k] + rng.choice("abé") + line[k:], line[:k] + rng.choice("abé") + line[k + 1:]])


@pytest.mark.parametrize("small", [lines.SMALL_GROUP, 0, 3])
def test_equals_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(lines, "SMALL_GROUP", small)
    rng = random.Random(small)
    bases = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(12, 17))) for _ in range(6)]
    docs = []
    for i in range(60):
        mine = []
        for _ in range(rng.randrange(5)):
            line = rng.choice(bases)
            for _ in range(rng.randrange(4)):
                line = changed(rng, line)
            mine.append(rng.choice(["", " ", "\t"]) + line + rng.choice(["", "\r"]))
        docs.append((i, "\n".join(mine)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (5, docs[5][1]), (6, "other\n" + bases[0]), (103, "short\nshort"), (104, bases[1] * 400), (105, bases[1] * 400 + "x")]
    assert got(spark, docs, 12) == brute(docs, 12)


def test_many_lines_that_share_a_half(spark):
    base = "the same beginning of forty characters or so, "
    docs = [(i, f"{base}{i * i * 7919 % 99991:06d} and the end") for i in range(300)]
    assert got(spark, docs, 20) == brute(docs, 20)


def test_short_lines_go_if_equal(spark):
    short, long = "And therhean is the is esndha.", "a line of more than forty characters that is near"
    docs = [(1, f"{short}\nOk.\n{long}"), (2, f"{short}\nOk.\n{short[:-1]}\n{long}s"), (3, f"kept\n {short}\n{'x' * 11}\n{'x' * 12}"), (4, f"{'x' * 11}\n{'x' * 12}")]
    found = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in found} == {
        1: docs[0][1], 2: f"Ok.\n{short[:-1]}", 3: f"kept\n{'x' * 11}\n{'x' * 12}", 4: "x" * 11
    }


def test_nothing(spark):
    assert got(spark, [], 40) == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=3, max_size=12), st.text("abc", min_size=3, max_size=12)), min_size=20, max_size=40), st.integers(1, 3))
def test_banded_distance(spark, pairs, edits):
    pairs = [(x, y) for x, y in pairs if abs(len(x) - len(y)) <= edits <= min(len(x), len(y))]
    frame = spark.createDataFrame(pairs, "x string, y string")
    rows = frame.select("x", "y", lines.edit_distance(F.col("x"), F.col("y"), edits).alias("d"), lines.one_place(F.col("x"), F.col("y")).alias("maybe")).collect()
    for r in rows:
        true = distance(r.x, r.y)
        assert r.d == true if true <= edits else r.d > edits, (r, true)
        assert r.maybe or true > 1
