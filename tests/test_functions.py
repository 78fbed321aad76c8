from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import quantiles, selection
from plumbline.functions.hashing import HASH_SPAN, row_hash
from plumbline.functions.pvalues import chi2_tail, student_two_sided
from plumbline.functions.quantiles import exact_quantiles
from plumbline.functions.selection import below_cut, cuts_passed, rank_cuts


def test_rank_cuts_select_exact_counts(spark):
    df = spark.range(20_000).withColumn("c", (F.col("id") % 7 == 0).cast("int"))
    h = row_hash(["id"])
    counts, cuts = rank_cuts(df, h, lambda n: {s: [0, 1, n[s] // 3, n[s]] for s in n}, F.col("c"))
    assert counts == {0: 17142, 1: 2858}
    for s, n in counts.items():
        for rank, cut in zip([0, 1, n // 3, n], cuts[s]):
            assert df.filter((F.col("c") == s) & (h < cut)).count() == rank


def test_rank_cuts_go_deeper_when_bins_are_full(spark, monkeypatch):
    monkeypatch.setattr(selection, "RADIX_BITS", 4)
    df = spark.range(5_000)
    _, cuts = rank_cuts(df, row_hash(["id"]), lambda n: {None: [1234]})
    assert df.filter(below_cut(row_hash(["id"]), {None: cuts[None][0]})).count() == 1234


def test_rank_cuts_keep_copies_together(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("k"))
    h = row_hash(["k"])
    _, cuts = rank_cuts(df, h, lambda n: {None: [450]})
    chosen = df.filter(h < cuts[None][0])
    assert chosen.filter("k = 7").count() in (0, 600)


def test_cuts_passed_counts_limits(spark):
    df = spark.createDataFrame([(5,), (10,), (11,)], "v int")
    got = [r[0] for r in df.select(cuts_passed(F.col("v"), {None: [6, 11]})).collect()]
    assert got == [0, 1, 2]


def test_row_hash_is_stable_under_repartitioning(spark):
    df = spark.range(1000)
    one = {r.id: r.h for r in df.repartition(1).withColumn("h", row_hash(["id"])).collect()}
    many = {r.id: r.h for r in df.repartition(16).withColumn("h", row_hash(["id"])).collect()}
    assert one == many
    assert all(0 <= h < HASH_SPAN for h in one.values())


CASES = {
    "uniform": lambda r, i: r.random(),
    "hot third": lambda r, i: 1.0 if i % 3 == 0 else r.gauss(0, 5),
    "heavy tail": lambda r, i: math.exp(r.gauss(0, 8)),
    "few values": lambda r, i: float(i % 4),
    "constant": lambda r, i: 3.5,
}


@pytest.mark.parametrize("case", CASES)
def test_exact_quantiles_match_numpy_in_bracket_mode(spark, monkeypatch, case):
    monkeypatch.setattr(quantiles, "SKETCH", 50)
    monkeypatch.setattr(quantiles, "BRACKET_ROWS", 40)
    r = random.Random(3)
    values = [CASES[case](r, i) for i in range(3_000)]
    rows = [(v,) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, {"v": probs})["v"]
    assert np.allclose(got, np.percentile(values, [p * 100 for p in probs]), rtol=1e-12)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [1.5]}


@pytest.mark.parametrize(
    ("stat", "dof", "p"), [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (11.070498, 5, 0.05), (18.307038, 10, 0.05), (0, 3, 1.0)]
)
def test_chi2_tail_textbook(stat, dof, p):
    assert chi2_tail(stat, dof) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize(
    ("t", "dof", "p"), [(12.7062, 1, 0.05), (2.228139, 10, 0.05), (2.750000, 30, 0.01), (1.959964, 10**7, 0.05), (0.0, 5, 1.0)]
)
def test_student_textbook(t, dof, p):
    assert student_two_sided(t, dof) == pytest.approx(p, abs=1e-5)
