from __future__ import annotations

import numpy as np
import pytest

from plumbline.llm.whitening import whiten_vectors


def vectors():
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(150, 8)) @ rng.normal(size=(8, 8))).round(1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900 + i, x[0].tolist()) for i in range(120)]
    rows += [(2000, None), (2001, [float("nan")] * 8), (2002, [None] * 8), (2003, []), (2004, [float("inf")] * 8)]
    return [*rows, (3, x[3].tolist()), (3, x[5].tolist()), (None, x[4].tolist())]


def expected(rows, weights):
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    every = np.floor(64 * np.array([v for _, v in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    x = every if weights == "count" else np.unique(every, axis=0)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    cov = centred.T @ centred / n
    e, p = np.linalg.eigh(cov)
    e, p = e[::-1], p[:, ::-1]
    whitened = (every - s / n) @ p / np.sqrt(e)
    return n, sorted(
        (-1 if i is None else i, k + 1, int(((n * row - s) ** 2).sum()), round(abs(w[k]), 6), round(e[k] / e.sum(), 9))
        for (i, _), row, w in zip(good, every, whitened, strict=True) for k in range(8)
    )


@pytest.mark.parametrize("weights", ["count", "one"])
def test_components_equal_the_plain_covariance(spark, weights):
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "2 AS n", "'y' AS h1")
    got = whiten_vectors(frame, weights=weights).collect()
    n, want = expected(vectors(), weights)
    assert {r.n for r in got} == {n} and {r.identity_error < 1e-9 for r in got} == {True}
    found = sorted((-1 if r.vec_id is None else r.vec_id, r.component, r.deviation, round(abs(r.whitened), 6), round(r.explained, 9)) for r in got)
    assert len(found) == len(want)
    for a, b in zip(found, want, strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-5 and abs(a[4] - b[4]) < 1e-8


def test_signs_agree_across_rows(spark):
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>")
    rows = whiten_vectors(frame, components=3).where("vec_id < 150 and vec_id != 3").collect()
    w = np.zeros((150, 3))
    for r in rows:
        w[r.vec_id, r.component - 1] = r.whitened
    assert {r.component for r in rows} == {1, 2, 3}
    x = {i: np.floor(64 * np.array(v, np.float32).astype(float)) for i, v in vectors()[:150]}
    some = [i for i in range(150) if i != 3]
    fit = np.linalg.lstsq(np.c_[np.array([x[i] for i in some]), np.ones(len(some))], w[some], rcond=None)
    assert np.abs(np.c_[np.array([x[i] for i in some]), np.ones(len(some))] @ fit[0] - w[some]).max() < 1e-8


def test_odd_inputs(spark):
    schema = "vec_id long, embedding array<double>"
    assert whiten_vectors(spark.createDataFrame([], schema)).collect() == []
    assert whiten_vectors(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    flat = whiten_vectors(spark.createDataFrame([(i, [float(i), 5.0]) for i in range(5)], schema)).collect()
    assert sorted((r.vec_id, r.component) for r in flat) == [(i, 1) for i in range(5)]
    mixed = [(i, [float(i % 3), float(i % 5)]) for i in range(15)] + [(20 + i, [float(i)]) for i in range(4)]
    got = whiten_vectors(spark.createDataFrame(mixed, schema)).collect()
    assert {(r.n, r.component) for r in got} == {(15, 1), (15, 2), (4, 1)} and len(got) == 34
    huge = whiten_vectors(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3.0, 0.0])], schema)).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and all(r.deviation is None or r.deviation >= 0 for r in huge)
    with pytest.raises(ValueError):
        whiten_vectors(spark.createDataFrame([], schema), weights="two")
