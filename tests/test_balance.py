from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import balance, neighbours


def points(kind: str, n: int, d: int) -> list[tuple[float, ...]]:
    r = random.Random(5)
    if kind == "lattice":
        return [tuple(float(r.randrange(6)) for _ in range(d)) for _ in range(n)]
    if kind == "hot third":
        return [tuple(1.0 for _ in range(d)) if i % 3 == 0 else tuple(r.gauss(0, 3) for _ in range(d)) for i in range(n)]
    if kind == "one column varies":
        return [(float(i * i),) + (7.0,) * (d - 1) for i in range(n)]
    return [tuple(r.gauss(0, 1) * 10 ** (j - 1) for j in range(d)) for _ in range(n)]


def brute_neighbours(rows: list[tuple[float, ...]], k: int) -> list[list[tuple[float, ...]]]:
    """k nearest of each row: own copies first, then vectors by distance and smallest key."""
    first: dict[tuple[float, ...], int] = {}
    copies: dict[tuple[float, ...], int] = {}
    for key, row in enumerate(rows):
        first.setdefault(row, key)
        copies[row] = copies.get(row, 0) + 1
    out = []
    for row in rows:
        near = [row] * (copies[row] - 1)

        def squared(v):
            total = 0.0
            for a, b in zip(row, v):
                total += (a - b) * (a - b)
            return total

        for v in sorted((v for v in first if v != row), key=lambda v: (squared(v), first[v])):
            near += [v] * copies[v]
        out.append(near[:k])
    return out


@pytest.mark.parametrize("kind", ["gauss", "lattice", "hot third", "one column varies"])
@pytest.mark.parametrize("cell_rows", [7, 2048, "boxes"])
def test_neighbours_match_brute_force(spark, monkeypatch, kind, cell_rows):
    d, k = 3, 5
    if cell_rows == "boxes":
        monkeypatch.setattr(balance, "WIDE", 3)
        monkeypatch.setattr(balance, "with_cells", lambda v: neighbours.with_cells(v, 9))
        cell_rows = 0
    rows = points(kind, 240, d)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "key bigint, f0 double, f1 double, f2 double")
    df = balance.feature_points(df, ["f0", "f1", "f2"], "key")
    near = balance.nearest_vectors(balance.distinct_vectors(df), d, k, cell_rows)
    found: dict[int, list] = {i: [r] * k for i, r in enumerate(rows)}
    for r in df.select("key", "vid").join(near, "vid").collect():
        found[r.key][r["rank"]] = tuple(r.nv)
    want = brute_neighbours(rows, k)
    assert [found[i] for i in range(len(rows))] == want


def frame(spark, majority: int, minority: list[tuple[float, float]]):
    r = random.Random(1)
    rows = [(i, r.gauss(5, 1), r.gauss(5, 1), 0) for i in range(majority)]
    rows += [(10_000 + i, a, b, 1) for i, (a, b) in enumerate(minority)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, y int")


def test_classes_end_equal_and_points_lie_on_segments(spark):
    minority = points("gauss", 30, 2)
    df = frame(spark, 100, minority)
    out = balance.smote(df, ["a", "b"], "y", "id")
    assert {r.y: r["count"] for r in balance.class_distribution(out, "y").collect()} == {0: 100, 1: 100}
    assert out.filter("draw = 0").count() == 130
    near = brute_neighbours(minority, 5)
    for r in out.filter("draw > 0").collect():
        x = np.array(minority[r.id - 10_000])
        s = np.array([r.a, r.b])
        assert any(
            abs(np.linalg.norm(s - x) + np.linalg.norm(s - np.array(v)) - np.linalg.norm(x - np.array(v))) < 1e-9
            for v in near[r.id - 10_000]
        )


def test_draws_are_spread_evenly(spark):
    out = balance.smote(frame(spark, 100, points("gauss", 30, 2)), ["a", "b"], "y", "id")
    draws = [r["count"] for r in out.filter("draw > 0").groupBy("id").count().collect()]
    assert len(draws) == 30 and set(draws) == {2, 3}


def test_result_does_not_depend_on_partitioning_or_cells(spark):
    df = frame(spark, 80, points("lattice", 25, 2))
    one = balance.smote(df.repartition(1), ["a", "b"], "y", "id")
    two = balance.smote(df.repartition(13), ["a", "b"], "y", "id", cell_rows=4)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_hot_copies_skip_the_join(spark, monkeypatch):
    minority = [(1.0, 1.0)] * 20 + points("gauss", 10, 2)
    df = frame(spark, 100, minority)
    plain = sorted(map(tuple, balance.smote(df, ["a", "b"], "y", "id").collect()))
    monkeypatch.setattr(balance, "HOT_VECTOR_ROWS", 6)
    assert sorted(map(tuple, balance.smote(df, ["a", "b"], "y", "id").collect())) == plain


def test_two_minority_classes(spark):
    df = frame(spark, 60, points("gauss", 12, 2))
    third = df.filter("y = 1").limit(4).select((F.col("id") + 50_000).alias("id"), "a", "b", F.lit(2).alias("y"))
    out = balance.smote(df.unionByName(third), ["a", "b"], "y", "id")
    assert {r.y: r["count"] for r in balance.class_distribution(out, "y").collect()} == {0: 60, 1: 60, 2: 60}


def test_many_features_plan_quickly(spark):
    d = 45
    df = spark.createDataFrame([(i, *p, i % 4 // 3) for i, p in enumerate(points("gauss", 60, d))],
                               "id bigint, " + ", ".join(f"c{i} double" for i in range(d)) + ", y int")
    names = [f"c{i}" for i in range(d)]
    out = balance.smote(df.dropna(subset=names), names, "y", "id")
    assert out.count() == 90 and out.filter("draw > 0").count() == 30


def test_refusals(spark):
    with pytest.raises(ValueError, match="needs two"):
        balance.smote(frame(spark, 10, [(1.0, 1.0)]), ["a", "b"], "y", "id")
    broken = frame(spark, 10, [(1.0, 1.0), (float("nan"), 2.0), (0.0, 1.0)])
    with pytest.raises(Exception, match="a feature is missing"):
        balance.smote(broken, ["a", "b"], "y", "id").collect()


def test_balanced_classes_stay_as_they_are(spark):
    df = frame(spark, 5, points("gauss", 5, 2))
    assert balance.smote(df, ["a", "b"], "y", "id").filter("draw > 0").count() == 0


def one_hot_rows(n: int) -> list[tuple[float, ...]]:
    """Customers of 30 kinds: twelve choices of three or four values that mostly follow the kind, as 40 dummies, and two numbers."""
    r = random.Random(8)
    sizes = [3] * 8 + [4] * 4
    kinds = [[r.randrange(s) for s in sizes] for _ in range(30)]
    out = []
    for _ in range(n):
        kind = r.choice(kinds)
        picks = [r.randrange(s) if r.random() < 0.08 else c for s, c in zip(sizes, kind)]
        out.append(tuple(float(v == c) for s, c in zip(sizes, picks) for v in range(s)) + (r.random(), r.random()))
    return out


def test_a_few_columns_compare_few_pairs(spark, monkeypatch):
    ranked, pairs = balance._ranked, []

    def counted(visiting, others, met, n_features, k):
        pairs.append(visiting.join(others, "cell").count())
        return ranked(visiting, others, met, n_features, k)

    monkeypatch.setattr(balance, "_ranked", counted)
    r, rows = random.Random(3), []
    for _ in range(1500):
        size = r.lognormvariate(0, 1)
        kind = r.randrange(4)
        rows.append((size, size * r.gauss(1, 0.05), size**0.7 * r.gauss(1, 0.05), *(float(kind == i) for i in range(4))))
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], ["key", *(f"f{i}" for i in range(7))])
    points_ = balance.feature_points(df, [f"f{i}" for i in range(7)], "key")
    near = balance.nearest_vectors(balance.distinct_vectors(points_).cache(), 7, 5)
    found = {}
    for row in points_.join(near, "vid").collect():
        found.setdefault(row.key, {})[row["rank"]] = tuple(row.nv)
    assert sum(pairs) < 0.15 * len(rows) ** 2
    assert [[found[i][j] for j in range(5)] for i in range(len(rows))] == brute_neighbours(rows, 5)


@pytest.mark.parametrize("sample", [neighbours.SAMPLE, 60])
def test_wide_one_hot_tables_visit_few_cells(spark, monkeypatch, sample):
    monkeypatch.setattr(neighbours, "SAMPLE", sample)
    k, rows = 5, one_hot_rows(1500)
    d = len(rows[0])
    names = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["key", *names])
    points_ = balance.feature_points(df, names, "key")
    vectors = balance.distinct_vectors(points_).cache()
    placed, boxes = neighbours.with_cells(vectors, 16)
    pairs = neighbours.visits(placed, boxes, k).groupBy("cell").count().collect()
    share = sum(r["count"] * int(boxes.rows[r.cell]) for r in pairs) / vectors.count() ** 2
    assert share < (0.12 if sample > 60 else 0.6)
    near = balance.nearest_vectors(vectors, d, k)
    found = {}
    for r in vectors.select("vkey", "vid").join(near, "vid").collect():
        found.setdefault(r.vkey, {})[r["rank"]] = tuple(r.nv)
    x = np.array(rows)
    for i in range(0, len(rows), 7):
        gaps = ((x - x[i]) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(len(x)), gaps))
        want = [float(gaps[j]) for j in order if j != i][:k]
        got = [float(((np.array(found[i][j]) - x[i]) ** 2).sum()) for j in range(k)]
        assert np.allclose(got, want)
