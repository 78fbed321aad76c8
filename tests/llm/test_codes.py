from __future__ import annotations

import numpy as np

from plumbline.llm.codes import COSINE, Coded, forest, index_shape, linked_pairs, near_vectors


def clustered(n, d, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6 + 1, d))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d)) * 0.22).astype(np.float32)


def brute(rows):
    """Links by all pairs of distinct ids, and components."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [(i, np.array(v, float), l) for i, v, l in rows if i is not None and l is not None and fine(v)]
    links = {i: set() for i, _, _ in rows}
    for x, (i, v, l) in enumerate(good):
        for j, w, m in good[x + 1:]:
            if i != j and l == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= COSINE:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in sorted(k for k in links if k is not None):
        if i in root:
            continue
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in root:
                root[k] = i
                todo += links[k]
    return {(i, len(links[i]), root.get(i)) for i in links}


def test_links_and_groups_equal_all_pairs(spark):
    vecs = clustered(500, 16).tolist()
    rows = [(i, v, i % 3) for i, v in enumerate(vecs)]
    rows += [(500 + i, vecs[4], 1) for i in range(40)]  # copies
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] + [1.0] * 15, 1), (603, [None] + [1.0] * 15, 1)]
    rows += [(604, vecs[4], None), (605, [], 1), (606, [1.0, 2.0], 1), (607, [2.0, 4.0], 1), (608, [float("inf")] * 16, 1)]
    rows += [(4, vecs[4], 1), (4, vecs[4], 1), (None, vecs[4], 1), (609, [1e-30] * 16, 0), (610, [1e30] * 16, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS rep", "2 AS cell", "3 AS n_links")
    got = near_vectors(frame).collect()
    assert len(got) == len(rows)
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_estimates_are_unbiased_and_bounded():
    a, b = Coded(clustered(400, 64, 1).astype(float), 3, 7), Coded(clustered(300, 64, 2).astype(float), 3, 7)
    found, width = a.estimates(b)
    error = found - a.unit @ b.unit.T
    assert abs(error.mean()) < 0.005
    assert (np.abs(error) > width).mean() < 1e-3


def test_recall_of_the_cells():
    vecs = clustered(3000, 32, 3).astype(float)
    bits, bands = index_shape(1 << 16)
    assert bits == 6
    coded = Coded(vecs, bits, bands)
    cosine = np.triu(coded.unit @ coded.unit.T, 1) >= COSINE
    i, j = np.nonzero(cosine)
    met = (coded.cell[i] == coded.cell[j]).any(axis=1)
    assert len(i) > 500 and met.mean() > 0.99
    seen = set()
    for band in range(bands):
        shared = {}
        for k, c in enumerate(coded.cell[:, band].tolist()):
            shared.setdefault(c, []).append(k)
        for members in shared.values():
            part = Coded(vecs[members], bits, bands)
            x, y = linked_pairs(part, part, True, band)
            pairs = {(members[p], members[q]) for p, q in zip(x.tolist(), y.tolist(), strict=True)}
            assert not pairs & seen  # once only
            seen |= pairs
    assert seen == set(zip(i[met].tolist(), j[met].tolist(), strict=True))


def test_forest():
    assert forest(6, np.array([4, 2]), np.array([5, 4])).tolist() == [0, 1, 2, 3, 2, 2]
