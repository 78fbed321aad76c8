"""Language-model scores from an interpolated modified Kneser-Ney bigram model.

The model is a set of sorted arrays in the shared folder, cut into shards:
word hashes with their counts, pairs of word numbers with their counts, and for
each word its continuation count and how many followers it has once, twice and
more often. Workers map the files into memory and look words up by bisection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import arrays
from plumbline.llm.arrow import TEXT, with_measures
from plumbline.llm.shared import checkpointed
from plumbline.llm.text import byte_table, chunks, flat, hash_spans, mix, word_spans
from plumbline.sources.scratch import new_path

WORDS_PER_SHARD = 1 << 22
BUFFER = 1 << 22
END = mix(np.array([0x454E44], np.uint64))[0]

BLOBS = "shard int, keys binary, counts binary"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every row and of one END behind them, and the rows' offsets."""
    data, at = flat(texts)
    starts, ends, rows = word_spans(data, at)
    words = hash_spans(data, starts, ends, byte_table(fold_case=True))
    return np.insert(words, rows[1:], END), rows + np.arange(len(rows))


def before(ids: np.ndarray, rows: np.ndarray, end: int) -> np.ndarray:
    """The word in front of each word; in front of a row's first one stands END."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[rows[:-1]] = end
    return out


def blobs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """One compressed row for each shard that sorted keys fall into."""
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = np.append(cut[1:], len(shard))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard[cut].astype(np.int32)),
            pa.array([arrays.squeeze_sorted(keys[a:b]) for a, b in zip(cut, ends, strict=True)], pa.binary()),
            pa.array([arrays.squeeze(counts[a:b].astype(np.uint32)) for a, b in zip(cut, ends, strict=True)], pa.binary()),
        ],
        names=["shard", "keys", "counts"],
    )


def counted(parts, make, shard_of):
    """Sorted and counted keys of about BUFFER tokens at a time, as blobs."""
    held, size = [], 0
    for part in parts:
        keys = make(part)
        held.append(keys)
        size += len(keys)
        if size >= BUFFER:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            yield blobs(keys, counts, shard_of(keys))
            held, size = [], 0
    if size:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        yield blobs(keys, counts, shard_of(keys))


def merged(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [arrays.unsqueeze_sorted(x) for x in group.column("keys").to_pylist()]
    counts = [arrays.unsqueeze(x, np.uint32) for x in group.column("counts").to_pylist()]
    return arrays.summed(keys, counts)


@dataclass
class Model:
    """Where the arrays are and the few numbers that go with them."""

    path: str
    bits: int
    shards: list[int] = field(default_factory=list)  # word shards that exist
    offsets: list[int] = field(default_factory=list)  # number of the first word of each
    words: int = 0
    tokens: int = 0
    cuts: list[int] = field(default_factory=list)  # first pair key of each pair shard but the first
    pair_shards: list[int] = field(default_factory=list)
    pairs: int = 0
    discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_mass: float = 1.0  # what the continuation distribution leaves to all words alike

    def url(self, name: str, shard: int) -> str:
        return f"{self.path}/{name}-{shard}.npy"


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Three discounts from how many items have count 1, 2, 3 and 4; within [0, count] where these are few."""
    n1, n2, n3, n4 = (max(x, 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.1), k - 0.1) for k, d in enumerate(raw, 1))


def count_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


class Vocabulary:
    """Numbers of words by bisection in the mapped hash arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.hashes = [arrays.load(model.url("hash", s)) for s in model.shards]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each of sorted hashes, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        shard = (hashes >> np.uint64(64 - self.model.bits)).astype(np.int64)
        for s, offset, known in zip(self.model.shards, self.model.offsets, self.hashes, strict=True):
            a, b = np.searchsorted(shard, [s, s + 1])
            at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
            out[a:b] = np.where(known[at] == hashes[a:b], at + offset, -1)
        return out

    def values(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """An array's value at each of sorted word numbers, 0 at -1."""
        out = np.zeros(len(numbers), np.int64)
        ends = [*self.model.offsets[1:], self.model.words]
        for s, lo, hi in zip(self.model.shards, self.model.offsets, ends, strict=True):
            mine = np.flatnonzero((numbers >= lo) & (numbers < hi))
            if len(mine):
                out[mine] = arrays.load(self.model.url(name, s))[numbers[mine] - lo]
        return out


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts words and pairs of all texts in Spark and stores the model's arrays.

    Tasks send sorted, counted and compressed keys; a shard is merged by one
    task. Word shards are ranges of the hash, pair shards ranges of (first word,
    second word) with about WORDS_PER_SHARD tokens each: a word more frequent
    than that is split by its followers. The driver sees sizes, cut points and
    counts of counts. Word numbers have 32 bits, so there may be four billion
    distinct words. Everything is counted, nothing is pruned.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{text_col}`").alias(TEXT))
    rough = narrow.agg(F.sum(F.length(TEXT))).first()[0] or 0
    bits = max(4, int(rough // (5 * WORDS_PER_SHARD)).bit_length())
    model = Model(new_path(spark, "ngram"), bits)

    def word_blobs(batches):
        shard = lambda keys: (keys >> np.uint64(64 - bits)).astype(np.int64)
        yield from counted(chunks(batches, TEXT), lambda part: tokens(part.column(TEXT))[0], shard)

    def store_words(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        hashes, counts = merged(group)
        arrays.save(model.url("hash", shard), hashes)
        arrays.save(model.url("count", shard), counts.astype(np.uint32 if counts.max() < 1 << 32 else np.uint64))
        total = np.cumsum(counts)
        often = np.flatnonzero(counts > WORDS_PER_SHARD)
        rare = total - np.cumsum(np.where(counts > WORDS_PER_SHARD, counts, 0))
        steps = np.flatnonzero(np.diff(rare // WORDS_PER_SHARD, prepend=0))
        at = [*((int(i), int(counts[i] // WORDS_PER_SHARD) + 1) for i in often), *((int(i), 1) for i in steps if counts[i] <= WORDS_PER_SHARD)]
        at.sort()
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "words": pa.array([len(hashes)], pa.int64()), "tokens": pa.array([int(total[-1])], pa.int64()),
            "cut": pa.array([[i for i, _ in at]], pa.list_(pa.int64())), "parts": pa.array([[n for _, n in at]], pa.list_(pa.int64())),
        })

    stored = (
        narrow.mapInArrow(word_blobs, BLOBS).groupBy("shard")
        .applyInArrow(store_words, "shard int, words bigint, tokens bigint, cut array<bigint>, parts array<bigint>")
    )
    found = sorted(stored.collect(), key=lambda r: r["shard"])
    if not found:
        return model
    sizes = [r["words"] for r in found]
    model.shards = [r["shard"] for r in found]
    model.offsets = np.concatenate(([0], np.cumsum(sizes)[:-1])).tolist()
    model.words, model.tokens = sum(sizes), sum(r["tokens"] for r in found)
    cuts = set()
    for r, offset in zip(found, model.offsets, strict=True):
        cuts.add(offset << 32)
        for i, n in zip(r["cut"], r["parts"], strict=True):
            cuts |= {(offset + i << 32) + model.words * k // n for k in range(n)}
            cuts |= {offset + i + 1 << 32} if n > 1 else set()
    model.cuts = sorted(c for c in cuts if 0 < c < model.words << 32)

    def pair_blobs(batches):
        vocabulary, edges = Vocabulary(model), np.array(model.cuts, np.uint64)
        end = int(vocabulary.numbers(np.array([END]))[0])

        def keys(part):
            hashes, rows = tokens(part.column(TEXT))
            distinct, which = np.unique(hashes, return_inverse=True)
            ids = vocabulary.numbers(distinct)[which].astype(np.uint64)
            return before(ids, rows, end) << np.uint64(32) | ids

        yield from counted(chunks(batches, TEXT), keys, lambda k: np.searchsorted(edges, k, "right"))

    starts = np.array(model.offsets, np.int64)

    def by_word(kind: int, ids: np.ndarray, values: np.ndarray):
        shard = np.searchsorted(starts, ids, "right") - 1
        batch = blobs(ids.astype(np.uint64), values, shard)
        return batch.append_column("kind", pa.array(np.full(len(batch), kind, np.int32)))

    def store_pairs(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys, counts = merged(group)
        arrays.save(model.url("pair", shard), keys)
        wide = np.uint16 if counts.max() < 1 << 16 else np.uint32 if counts.max() < 1 << 32 else np.uint64
        arrays.save(model.url("pairs", shard), counts.astype(wide))
        out = [by_word(0, *np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True))]
        first = (keys >> np.uint64(32)).astype(np.int64)
        for kind, some in ((1, counts == 1), (2, counts == 2), (3, counts > 2)):
            if some.any():
                out.append(by_word(kind, *np.unique(first[some], return_counts=True)))
        numbers = np.array([shard, len(keys), *count_of_counts(counts)], np.int64)
        own = pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([numbers.tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([-1], pa.int32())],
            names=["shard", "keys", "counts", "kind"],
        )
        return pa.Table.from_batches([own, *out])

    paired = checkpointed(
        narrow.mapInArrow(pair_blobs, BLOBS).groupBy("shard").applyInArrow(store_pairs, BLOBS + ", kind int")
    )
    facts = [np.frombuffer(r["keys"], np.int64) for r in paired.where("kind = -1").select("keys").collect()]
    model.pair_shards = sorted(int(f[0]) for f in facts)
    model.pairs = int(sum(f[1] for f in facts))
    model.discounts = discounts(np.sum([f[2:] for f in facts], axis=0).tolist())

    def store_followers(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        at = model.shards[shard]
        lo, hi = model.offsets[shard], [*model.offsets[1:], model.words][shard]
        kinds = np.asarray(group.column("kind"))
        for kind, name in enumerate(("continued", "once", "twice", "often")):
            dense = np.zeros(hi - lo, np.int64)
            rows = group.filter(pa.array(kinds == kind))
            if len(rows):
                ids, n = merged(rows)
                dense[ids.astype(np.int64) - lo] = n
            arrays.save(model.url(name, at), dense.astype(np.uint32))
            if kind == 0:
                facts = [int(dense.sum()), *count_of_counts(dense), int((dense > 2).sum())]
        return pa.table({"facts": pa.array([facts], pa.list_(pa.int64()))})

    rows = paired.where("kind >= 0").groupBy("shard").applyInArrow(store_followers, "facts array<bigint>").collect()
    total, n1, n2, n3, n4, more = np.sum([r["facts"] for r in rows], axis=0).tolist()
    model.word_discounts = d = discounts([n1, n2, n3, n4])
    model.word_mass = (d[0] * n1 + d[1] * n2 + d[2] * more) / total
    return model


def discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *by])[np.minimum(counts, 3)], 0)


class Scorer:
    """Probabilities of words behind words, from the mapped arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = Vocabulary(model)
        self.pair = {s: (arrays.load(model.url("pair", s)), arrays.load(model.url("pairs", s))) for s in model.pair_shards}
        self.edges = np.array(model.cuts, np.uint64)
        self.end = int(self.vocabulary.numbers(np.array([END]))[0]) if model.words else -1

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted pair keys."""
        out = np.zeros(len(keys), np.int64)
        shard = np.searchsorted(self.edges, keys, "right")
        for s in np.unique(shard):
            if s in self.pair:
                known, counts = self.pair[s]
                a, b = np.searchsorted(shard, [s, s + 1])
                at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == keys[a:b], counts[at], 0)
        return out

    def scored(self, texts: pa.Array) -> dict[str, np.ndarray]:
        model = self.model
        hashes, rows = tokens(texts)
        distinct, which = np.unique(hashes, return_inverse=True)
        ids = self.vocabulary.numbers(distinct)
        value = {n: self.vocabulary.values(n, ids) for n in ("count", "continued", "once", "twice", "often")} if model.words else None
        n = len(rows) - 1
        row = np.repeat(np.arange(n), np.diff(rows))
        total = lambda x: np.bincount(row, x, n)
        count = value["count"] if value else np.zeros(len(distinct), np.int64)
        base = np.log10((count + 1) / (model.tokens + model.words + 1))
        if value is None:
            return {"n_tokens": np.diff(rows), "n_known": np.zeros(n, np.int64), "base_score": total(base[which]), "score": total(base[which])}
        continued = max(model.pairs, 1)
        low = discounted(value["continued"], model.word_discounts) / continued + model.word_mass / (model.words + 1)
        d = model.discounts
        seen = np.maximum(count, 1)
        back = np.where(count > 0, (d[0] * value["once"] + d[1] * value["twice"] + d[2] * value["often"]) / seen, 1.0)
        end = int(np.searchsorted(distinct, END))
        behind = before(which, rows, end)
        both = (ids[which] >= 0) & (ids[behind] >= 0)
        pair = np.zeros(len(which), np.int64)
        keys = ids[behind[both]].astype(np.uint64) << np.uint64(32) | ids[which[both]].astype(np.uint64)
        order = np.argsort(keys)
        found = np.empty(len(keys), np.int64)
        found[order] = self.pair_counts(keys[order])
        pair[both] = found
        p = discounted(pair, d) / seen[behind] + back[behind] * low[which]
        return {
            "n_tokens": np.diff(rows), "n_known": total(count[which] > 0).astype(np.int64),
            "base_score": total(base[which]), "score": total(np.log10(p)),
        }


OWN = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
])


def score_texts(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """log10 probability of every whole text, END included, by the model and by add-one word counts.

    ``perplexity`` is per token. Null and empty texts are END alone. A model of
    no texts gives every word the same chance. Words that were never counted get
    the share that all words get alike. Repeated rows score alike; columns named
    like a result are replaced.
    """
    scorer: list[Scorer] = []

    def measure(texts: pa.Array) -> dict[str, object]:
        if not scorer:
            scorer.append(Scorer(model))
        return scorer[0].scored(texts)

    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("perplexity", "train_tokens")]
    found = with_measures(docs, text_col, keep, OWN, measure)
    return found.withColumn("train_tokens", F.lit(model.tokens).cast("bigint")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    )
