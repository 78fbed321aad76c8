from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from plumbline.llm import ngram

WORD = re.compile("[^\x20\x09-\x0d]+")
END = object()


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


class Brute:
    def __init__(self, texts):
        self.uni, self.pair = Counter(), Counter()
        for t in texts:
            w = [*words(t), END]
            self.uni.update(w)
            self.pair.update(zip([END, *w[:-1]], w, strict=True))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.cont = Counter(w for _, w in self.pair)
        self.by = defaultdict(list)
        for (a, _), c in self.pair.items():
            self.by[a].append(c)
        coc = lambda counts: [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        self.d = ngram.discounts(coc(self.pair.values()))
        self.e = ngram.discounts(coc(self.cont.values()))

    def take(self, c, d):
        return max(c - (d[min(c, 3) - 1] if c else 0), 0)

    def low(self, w):
        total = sum(self.cont.values())
        left = sum(c - self.take(c, self.e) for c in self.cont.values()) / total
        return self.take(self.cont[w], self.e) / total + left / (self.v + 1)

    def p(self, a, w):
        if not self.uni[a]:
            return self.low(w)
        total = sum(self.by[a])
        return self.take(self.pair[a, w], self.d) / total + sum(c - self.take(c, self.d) for c in self.by[a]) / total * self.low(w)

    def score(self, text):
        w = [*words(text), END]
        return sum(math.log10(self.p(a, b)) for a, b in zip([END, *w[:-1]], w, strict=True))

    def base(self, text):
        return sum(math.log10((self.uni[w] + 1) / (self.n + self.v + 1)) for w in [*words(text), END])


def corpus(n):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "THE", "the"]
    return [" ".join(rng.choice(vocabulary[: rng.choice((5, 63))]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("shard", [ngram.WORDS_PER_SHARD, 50])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(ngram, "WORDS_PER_SHARD", shard)
    monkeypatch.setattr(ngram, "BUFFER", 200)
    texts = [*corpus(80), None, "", "the " * 300]
    brute = Brute(texts)
    model = ngram.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert (model.tokens, model.words, model.pairs) == (brute.n, brute.v, len(brute.pair))
    asked = [*texts, "never seen w1 words THE w2", " ", "w3\x0bw4"]
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS perplexity")
    for r in ngram.score_texts(rows, model).collect():
        t = asked[r.doc_id]
        assert r.n_tokens == len(words(t)) + 1
        assert r.n_known == sum(brute.uni[w] > 0 for w in [*words(t), END])
        assert r.base_score == pytest.approx(brute.base(t), rel=1e-12)
        assert r.score == pytest.approx(brute.score(t), rel=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_probabilities_sum_to_one():
    brute = Brute(corpus(40))
    for a in (END, "w1", "w50", "never"):
        assert sum(brute.p(a, w) for w in [*brute.uni, "never"]) == pytest.approx(1)


def test_model_of_nothing(spark):
    model = ngram.train(spark.createDataFrame([], "text string"))
    row = ngram.score_texts(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert (row.n_tokens, row.n_known, row.score, row.base_score) == (3, 0, 0.0, 0.0)
