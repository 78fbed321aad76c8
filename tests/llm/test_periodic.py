from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from plumbline.llm import periodic, queries


def brute(words, least=12):
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(least, 2 * p):
                out.setdefault((start, i + p), p)
    return sorted((a, b - a, p) for (a, b), p in out.items())


def collapsed(words, runs):
    gone = {k for a, length, p in runs for k in range(a + p, a + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts():
    rng = random.Random(5)
    out = [None, "", " \n", "a", "é " * 12, "a " * 11, "a b " * 200 + "c " * 300, "z"]
    for _ in range(150):
        words = [rng.choice("abcdefgh"[: rng.choice((1, 2, 3, 8))]) for _ in range(rng.choice((0, 1, 20, 60, 200)))]
        for _ in range(rng.randrange(3)):
            unit, at = [rng.choice("xyzuv") for _ in range(rng.randrange(1, 20))], rng.randrange(len(words) + 1)
            words[at:at] = unit * rng.randrange(2, 6)
        out.append(rng.choice((" ", "\n ", " \t")).join(words))
    return [*out, out[6], out[6]]


def test_runs_equal_all_periods(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "q " * 20, "x")]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = (r.text or "").split()
        want = brute(words)
        assert [tuple(x) for x in r.runs] == want and r.collapsed == collapsed(words, want) and r.n_words == len(words)


def test_extensions_over_deep_repeats():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 3, 4000)
    words = np.concatenate((base, base, rng.integers(0, 3, 50), base[:1500], np.zeros(3000, np.int64), np.tile(base[:333], 9)))
    reach = periodic.Extensions(words)
    i, j = rng.integers(0, len(words), (2, 3000))
    i, j = np.concatenate((i, np.arange(1000))), np.concatenate((j, np.arange(1000) + 4000))
    i, j = i[i != j], j[i != j]
    for a, b, k in zip(i, j, reach.between(i, j), strict=True):
        assert (words[a : a + k] == words[b : b + k]).all()
        assert max(a, b) + k == len(words) or words[a + k] != words[b + k]


def test_very_long_texts():
    one = periodic.measure(pa.array(["a " * 150_000]))
    assert one["runs"].to_pylist() == [[{"start": 0, "length": 150_000, "period": 1}]] and one["collapsed"] == ["a"]
    words = [f"w{k % 777}" for k in range(100_000)]
    assert periodic.measure(pa.array([" ".join(words)]))["runs"].to_pylist() == [[{"start": 0, "length": 100_000, "period": 777}]]


def test_query_plants_and_digests(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op13_periodic(spark, folder).collect()
    assert {r.doc_id for r in got} == set(docs) and sum(r.n_runs > 0 for r in got) > 5
    for r in got:
        words = re.findall("[^\x20\x09-\x0d]+", docs[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2000:
            continue
        runs = brute(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{p}\n" for a, b, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_no_rows(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
