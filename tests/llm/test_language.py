from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import arrow, language

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "öt", "ung", "er"], "cc": ["ción", "que", "los", "ar"]}


def labelled(n):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(4, 60)))
        rows.append((i, text, lang, "x"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([*labelled(600), (900, None, "aa", "x"), (901, "12 34", "bb", "x"), (902, "mi tu", None, "x")],
                                 "doc_id long, text string, lang string, score string")
    return language.train_language_model(docs, F.col("doc_id"), per_language=150)


def test_held_out_accuracy(spark, model):
    rows = [(i + 5000, t, g, s) for i, t, g, s in labelled(900)[600:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language.predict_languages(docs, model).collect()
    assert len(got) == 300
    assert sum(r.lang == r.lang_pred for r in got) >= 297
    assert sum(r.rejected for r in got) <= 6
    assert all(0 <= r.score <= 1 for r in got)


def test_texts_without_language(spark, model):
    rows = [(1, None), (2, ""), (3, "1234 !?"), (4, "öt ung " * 30000), (5, "öt ung"), (5, "öt ung"), (6, "zzz xxq wvw jjj")]
    got = language.predict_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7
    for k in (1, 2, 3):
        assert (by[k].lang_pred, by[k].score, by[k].rejected) == ("und", 0.0, True)
    assert by[4].lang_pred == by[5].lang_pred == "bb"
    assert by[6].lang_pred in SYLLABLES and by[6].rejected


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "ka lo", None)], "doc_id long, text string, lang string")
    model = language.train_language_model(docs, F.col("doc_id"))
    row = language.predict_languages(docs, model).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)


def test_shared_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.train_language_model(docs.where(~held), F.col("doc_id"))
    got = language.predict_languages(docs.where(held), model, keep=["doc_id", "lang"]).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)


def test_the_sample_stays_in_arrow_buffers(spark):
    """Rows come in the order of their hashes and as views of a few large buffers, not as an object for each value."""
    docs = spark.createDataFrame([*labelled(200), (900, "a", "aa", "x")], "doc_id long, text string, lang string, score string")
    features = language.sample_features(docs, F.col("doc_id"), "text", "lang", 100)
    got = language.sampled_rows(features)
    plain = sorted(features.collect(), key=lambda r: (r["draw"], r["same"], r["lang"]))
    assert [(r["lang"], bytes(r["buckets"]), bytes(r["counts"])) for r in got] == [(r["lang"], bytes(r["buckets"]), bytes(r["counts"])) for r in plain]
    assert all(isinstance(r["counts"], pa.Buffer) for r in got)
    assert language.dense(got, 0, len(got)).shape == (len(got), language.BUCKETS)


def test_the_driver_gets_the_model_without_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame(labelled(200), "doc_id long, text string, lang string, score string")
    features = language.sample_features(docs, F.col("doc_id"), "text", "lang", 50)
    plain = language.fit(language.sampled_rows(features))

    def refused(*_):
        raise AssertionError("the sample came to the driver")

    monkeypatch.setattr(language, "sampled_rows", refused)
    got = language.train_language_model(docs, F.col("doc_id"), per_language=50)
    assert got.languages == plain.languages
    assert np.allclose(got.scores, plain.scores, rtol=1e-4, atol=1e-6) and np.allclose(got.bias, plain.bias, rtol=1e-4, atol=1e-6)
    assert np.isclose(got.temperature, plain.temperature) and np.isclose(got.threshold, plain.threshold)


def test_counts_of_the_sample_take_as_many_bytes_as_they_need(spark):
    rows = [(1, "lo mi", "aa"), (2, "lo mi " * 300, "aa"), (3, "lo mi " * 70000, "aa"), (4, "a", "aa")]
    features = language.sample_features(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"), "text", "lang", 9)
    got = sorted(language.sampled_rows(features), key=lambda r: len(r["counts"]))
    assert [len(r["counts"]) // max(1, len(r["buckets"]) // 2) for r in got] == [0, 1, 2, 4]
    for r, (_, text, _) in zip(got, sorted(rows, key=lambda r: len(r[1])), strict=True):
        found, _ = language.subwords(*language.flat(pa.array([text])))
        c = np.bincount(found, minlength=language.BUCKETS).astype(np.float32)
        assert np.allclose(language.dense([r], 0, 1)[0], c / (c.sum() + language.PRIOR))


def test_workers_hold_little(spark, model, monkeypatch):
    """Texts go to the worker once, and n-grams are made of a quarter of a megabyte at a time; results and columns stay."""
    docs = spark.range(600).selectExpr("id as doc_id", "'x' as source", "repeat('öt ung ', 600) as text", "id % 7 as n").coalesce(1)
    whole = language.predict_languages(docs, model).collect()
    plain, cut, most = language.subwords, arrow.chunks, 1 << 18

    def small(data, at):
        assert len(data) <= most, len(data)
        return plain(data, at)

    def once(batches, text, size):
        def seen():
            for batch in batches:
                assert text == "text" and batch.nbytes < 1.5 * batch.column(text).nbytes
                yield batch

        return cut(seen(), text, size)

    monkeypatch.setattr(language, "subwords", small)
    monkeypatch.setattr(arrow, "chunks", once)
    found = language.predict_languages(docs, model)
    assert found.columns == [*docs.columns, "lang_pred", "score", "rejected"]
    assert found.collect() == whole and len(whole) == 600
    assert language.predict_languages(docs, model, keep=["text"]).columns == ["text", "lang_pred", "score", "rejected"]
    monkeypatch.undo()
    assert language.predict_languages(docs, model, keep=["text"]).first().text == whole[0].text
