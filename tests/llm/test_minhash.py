from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import minhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs):
    sets = {}
    for i, t in docs:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (max(len(s) for s in sets[i]), find(i)) for i in sets}


def varied(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], ["new%d" % rng.randrange(99)], [words[k], "more"]])
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs = []
    for _ in range(12):
        base = fresh(rng.choice([3, 5, 6, 9, 40, 120]))
        docs += [varied(rng, base, rng.randrange(4)) for _ in range(rng.choice([1, 2, 5]))]
    passage = fresh(60)
    docs += [" ".join([*passage, *fresh(rng.choice([15, 40, 60]))]) for _ in range(12)]
    hot = fresh(150)
    docs += [varied(rng, hot, rng.choice([1, 2, 3])) for _ in range(90)]
    docs += [" ".join(hot)] * 30 + [None, "", " \n", "one", "ONE", "one\ttwo", "x " * 400]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    docs = [*corpus(seed), (None, "no id"), (3, "a second text of document three")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS id", "'x' AS kept")
    got = minhash.near_duplicates(frame).collect()
    assert len(got) == len(docs) and all(r.id == 2 for r in got)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, None)]


def passage_corpus(seed, documents, links):
    """Documents around one passage, and pairs of 0.75 to 0.88 similarity among them."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    passage = fresh(304)
    docs = [" ".join([*passage, *fresh(rng.randrange(110, 200))]) for _ in range(documents)]
    for _ in range(links):
        docs += [" ".join([*passage, *fresh(20)]), " ".join([*passage, *fresh(rng.choice([20, 30, 60]))])]
        own = fresh(160)
        docs += [" ".join([*passage, *own]), " ".join([*passage, *own[:130], *fresh(30)])]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("block", "bucket"), [(minhash.BLOCK, minhash.SMALL_BUCKET), (16, 4)])
def test_links_in_large_mixed_buckets(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SMALL_BUCKET", bucket)
    docs = passage_corpus(block, 700 if block > 16 else 150, 3)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    want = brute(docs)
    assert len({c for _, c in want.values()}) < len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_equal_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 2)
    docs = corpus(seed)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)


@pytest.mark.parametrize("copies", [1, 3])
def test_ids_with_several_texts_link_them_all(spark, copies):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    near = varied(rng, words, 2)
    docs = [(0, " ".join(words)), (3, near), (3, "another text that nothing else resembles at all"), (7, "another text that nothing else resembles at all")]
    docs = docs * copies + [(5, "alone with its own few words here")]
    for _ in range(3):
        got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs) and len(got) == len(docs)
        assert {r.component_id for r in got} == {0, 5}


def test_no_documents(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_estimates_follow_similarity():
    rng = np.random.default_rng(0)
    for both, own in ((300, 50), (300, 0), (100, 200), (12, 2), (0, 200)):
        found = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, both + 2 * own, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(pool[: both + own]), np.unique(np.concatenate((pool[:both], pool[both + own :])))
            found.append(float(minhash.estimate(minhash.sketch(a)[None], minhash.sketch(b)[None])[0]))
        assert abs(np.mean(found) - both / (both + 2 * own)) < 0.05


def test_sets_are_exact():
    texts = ["a b c d e f", "A B c D e f", "a b", "a  b\x0b", None, "", "é a b c d", "a b c d e a b c d e"]
    sets = [set(s.tolist()) for s in minhash.shingle_sets(pa.array(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[0] == sets[1] and sets[2] == sets[3] and not sets[2] & sets[6]
