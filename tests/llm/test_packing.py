from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing, tokens
from plumbline.llm.packing import fractional, pack_documents, plan
from plumbline.llm.tokens import BytePairEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ENCODER = BytePairEncoder(PATH)
WORDS = ["a", "It's", " 's", "'ll x", "\n\n", "  ", "\t", "don't", "''s", "we're'd", "12", "½", "é", "日本", " ", "!?", " ", "'S", "x'", "\r\n ", "🙂", "<|endoftext|>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(WORDS), max_size=12).map("".join), st.text(max_size=20)), max_size=5))
def test_ids_equal_the_tokenizers(texts):
    tokenizer = Tokenizer.from_file(PATH) if not hasattr(test_ids_equal_the_tokenizers, "t") else test_ids_equal_the_tokenizers.t
    tokenizer.encode_special_tokens = True
    test_ids_equal_the_tokenizers.t = tokenizer
    got = ENCODER.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_go_to_the_tokenizer_once_and_many_at_a_time(monkeypatch):
    """A vocabulary beyond 131,072 words is remembered, and a call of the tokenizer serves many words; both stay bounded."""
    words = [f" w{i}x{i * 7919 % 100_003}" for i in range(200_000)]
    texts = pa.array(["".join(words[i : i + 20_000]) for i in range(0, len(words), 20_000)])
    encoder, sent = BytePairEncoder(PATH), []
    plain = encoder.words

    class Counting:
        def encode(self, text, **settings):
            sent.append(len(text))
            return plain.encode(text, **settings)

    encoder.words = Counting()
    first = [encoder.encode(texts.slice(i, 1)) for i in range(len(texts))]
    assert 0 < len(sent) < len(words) / 1000 and max(sent) <= tokens.SENT_BYTES * 1.5
    sent.clear()
    again = [encoder.encode(texts.slice(i, 1)) for i in range(len(texts))]
    assert not sent
    assert all((a[0] == b[0]).all() for a, b in zip(first, again, strict=True))
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 30_000)
    small = BytePairEncoder(PATH)
    for i in range(len(texts)):
        assert (small.encode(texts.slice(i, 1))[0] == first[i][0]).all()
        assert len(small.known) <= 30_000 + 20_000


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=25))
def test_plan_holds_every_piece_once(counts):
    histogram = np.zeros(41, np.int64)
    for l, n in counts.items():
        histogram[l] = n
    patterns, bound = plan(histogram, 40)
    held = np.zeros(41, np.int64)
    for key, times in patterns:
        assert sum(l * c for l, c in key) <= 40
        for l, c in key:
            held[l] += c * times
    assert (held == histogram).all()
    used = sum(t for _, t in patterns)
    assert bound <= used + 1e-6
    assert used <= 1.5 * bound + 2


def test_prices_give_a_bound():
    need = np.zeros(11)
    need[6] = 10  # two never fit together
    _, bound = fractional(need, 10)
    assert bound == pytest.approx(10)


def check(rows, texts, reference, capacity):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    want = defaultdict(list)
    for doc, text in texts:
        want[doc].append(np.array([*reference(text), 2], "<u4"))
    assert set(pieces) == set(want)
    for doc, versions in want.items():
        for ids in versions:
            n = len(ids)
            first = n % capacity or capacity
            cuts = [0, *range(first, n + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                mine = (k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                assert mine in [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc]]
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packs_all_tokens(spark, reference):
    texts = [(i, f"word{i} " * (i * 7 % 90)) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "very long " * 500), (7, texts[7][1]), (7, texts[7][1]), (203, "x")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in texts], "doc_id long, text string, block string")
    rows = pack_documents(docs, PATH, capacity=64).collect()
    used = check(rows, texts, reference, 64)
    assert used <= -(-sum(r.length for r in rows) // 64) + 2
    assert len(rows) == sum(-(-(len(reference(t)) + 1) // 64) for _, t in texts)


def test_nothing_to_pack(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, PATH).collect() == []


def test_workers_get_small_batches(spark, monkeypatch):
    """Fifteen megabytes of texts in one partition come to the encoder in batches of about BATCH_BYTES; the session's setting stays."""
    plain, most = packing.chunks, 2 * packing.BATCH_BYTES

    def checked(batches, text, size):
        def small():
            for batch in batches:
                assert batch.nbytes <= most, batch.nbytes
                yield batch

        return plain(small(), text, size)

    monkeypatch.setattr(packing, "chunks", checked)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 1000) as text").coalesce(1)
    pack_documents(docs, PATH)
    assert spark.conf.get(name) == before
    with pytest.raises(RuntimeError), packing.batches_of(spark, 1 << 20):
        raise RuntimeError
    assert spark.conf.get(name) == before
