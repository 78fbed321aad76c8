"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.arrow import TEXT, with_measures
from plumbline.llm.text import byte_table, chunks, flat, mix, powers

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
ORDERS = (2, 3, 4)
DIMENSIONS = 16
SAMPLE_PER_LANGUAGE = 1000
EPOCHS = 12
MIN_STEPS = 400  # a small sample is gone through more often
BATCH = 64
PRIOR = 10  # n-grams without an opinion that every text gets, so that short texts stay unsure
RATE = 0.5
EMBED_RATE = 100.0
REJECT_SHARE = 0.001
REJECT_BELOW = 0.5
NO_LANGUAGE = "und"
TEXT_BYTES = 1 << 18  # n-grams take over a hundred bytes for each byte of text

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_LETTERS[128:] = True


def subwords(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of every row, with one blank for whatever is no letter, and the row of each."""
    letter = _LETTERS[data]
    blank = ~letter
    table = byte_table(fold_case=True)
    values = np.where(letter, table[data], table[32])
    row = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    ends = np.repeat(at[1:], np.diff(at))
    blanks = np.zeros(len(data) + 1, np.int32)
    np.cumsum(blank, out=blanks[1:])
    found, rows = [], []
    place = np.arange(len(data))
    for n in ORDERS:
        if len(data) < n:
            continue
        m = len(data) - n + 1
        h = np.full(m, n, np.uint64)
        for j, p in enumerate(powers(n, 0xD1342543DE82EF95)):
            h += values[j : j + m] * p
        good = (place[:m] + n <= ends[:m]) & (blanks[n : n + m] - blanks[:m] <= 1)
        found.append((mix(h[good]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        rows.append(row[:m][good])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(found), np.concatenate(rows)


@dataclass
class LanguageModel:
    """Scores of every bucket for every language, a temperature and the confidence below which a text is rejected."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        buckets, rows = subwords(data, at)
        n = len(at) - 1
        counts = np.bincount(rows, minlength=n) + PRIOR
        logits = np.empty((n, len(self.languages)))
        for k in range(len(self.languages)):
            logits[:, k] = np.bincount(rows, self.scores[k][buckets], minlength=n) / counts + self.bias[k]
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample_features(docs: DataFrame, key: Column, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """Bucket counts of a sample with at most ``per_language`` texts of each language, by hash of the key.

    Buckets take two bytes each; the counts of a text take one, two or four each, as its largest needs.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.lit("language"), key.cast("string")), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * per_language / n))])
    picked = rows.where(draw < share[F.col(lang_col)] * F.lit(float(1 << 30))).select(
        F.col(lang_col).alias("lang"), draw.alias("draw"), F.xxhash64(text_col).alias("same"), F.col(text_col).alias(TEXT)
    )

    def run(batches):
        for part in chunks(batches, TEXT, TEXT_BYTES):
            data, at = flat(part.column(TEXT))
            buckets, row = subwords(data, at)
            keys, n = np.unique(row.astype(np.int64) * BUCKETS + buckets, return_counts=True)
            cuts = np.searchsorted(keys, np.arange(len(at)) * BUCKETS)
            spans = [*zip(cuts[:-1], cuts[1:], strict=True)]
            held = (keys % BUCKETS).astype(np.uint16)
            packed = [
                pa.array([held[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([n[a:b].astype(np.min_scalar_type(n[a:b].max(initial=0))).tobytes() for a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *packed], names=["lang", "draw", "same", "buckets", "counts"])

    features = picked.mapInArrow(run, "lang string, draw bigint, same bigint, buckets binary, counts binary")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "same"))
    return features.withColumn("place", place).where(F.col("place") <= per_language).drop("place")


def dense(rows: list, lo: int, hi: int) -> np.ndarray:
    x = np.zeros((hi - lo, BUCKETS), np.float32)
    for i, r in enumerate(rows[lo:hi]):
        buckets = np.frombuffer(r["buckets"], np.uint16)
        c = np.frombuffer(r["counts"], f"u{len(r['counts']) // len(buckets)}" if len(buckets) else np.uint8).astype(np.float32)
        x[i, buckets] = c / (c.sum() + PRIOR)
    return x


def train_language_model(
    docs: DataFrame, key: Column, text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE, epochs: int = EPOCHS, seed: int = 7,
) -> LanguageModel:
    """Fits embeddings and softmax by stochastic gradient descent on a bounded sample.

    The sample, at most ``per_language`` sparse rows of at most BUCKETS counts
    for each language, meets in one task; the driver gets the model alone. Every
    fifth row is left out of the descent; on these the temperature is chosen by
    likelihood. The threshold is REJECT_BELOW, or less if that would reject over
    REJECT_SHARE of what is predicted rightly.
    """
    features = sample_features(docs, key, text_col, lang_col, per_language)

    def run(batches):
        parts = [b for b in batches if len(b)]
        if parts:
            m = fit(in_order(pa.Table.from_batches(parts)), epochs, seed)
            own = [m.languages], [m.scores.tobytes()], [m.bias.tobytes()], [m.temperature], [m.threshold]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(own, MODEL, strict=True)], schema=MODEL)

    fitted = "languages array<string>, scores binary, bias binary, temperature double, threshold double"
    row = features.select(*SAMPLE).repartition(1).mapInArrow(run, fitted).first() if features is not None else None
    if row is None:
        return LanguageModel([], np.zeros((0, BUCKETS)), np.zeros(0), 1.0, 1.0)
    scores = np.frombuffer(row["scores"], np.float32).reshape(-1, BUCKETS)
    return LanguageModel(list(row["languages"]), scores, np.frombuffer(row["bias"], np.float32), row["temperature"], row["threshold"])


SAMPLE = ("lang", "draw", "same", "buckets", "counts")
MODEL = pa.schema([
    ("languages", pa.list_(pa.string())), ("scores", pa.binary()), ("bias", pa.binary()), ("temperature", pa.float64()), ("threshold", pa.float64()),
])


def sampled_rows(features: DataFrame) -> list[dict]:
    """The sample in the order of its hashes, as a caller outside Spark's tasks gets it."""
    return in_order(features.select(*SAMPLE).toArrow())


def in_order(table: pa.Table) -> list[dict]:
    """Rows in the order of their hashes: the counts stay in Arrow's buffers, which go back to the system whole."""
    order = pc.sort_indices(table, [("draw", "ascending"), ("same", "ascending"), ("lang", "ascending")]).to_pylist()
    lang, buckets, counts = (table[c].to_pylist() if c == "lang" else [v.as_buffer() for v in table[c]] for c in ("lang", "buckets", "counts"))
    return [{"lang": lang[i], "buckets": buckets[i], "counts": counts[i]} for i in order]


def fit(rows: list, epochs: int = EPOCHS, seed: int = 7) -> LanguageModel:
    """The model from rows with ``lang``, ``buckets`` and ``counts``; every fifth row only calibrates."""
    languages = sorted({r["lang"] for r in rows})
    truth = np.array([languages.index(r["lang"]) for r in rows])
    fit = np.flatnonzero(np.arange(len(rows)) % 5 != 4)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weight = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    batches = -(-len(fit) // BATCH)
    epochs = max(epochs, -(-MIN_STEPS // batches))
    for epoch in range(epochs):
        order = rng.permutation(fit)
        for b in range(batches):
            take = order[b * BATCH : (b + 1) * BATCH]
            x = dense([rows[i] for i in take], 0, len(take))
            mean = x @ embed
            error = softmax(mean @ weight + bias).astype(np.float32)
            error[np.arange(len(take)), truth[take]] -= 1
            rate = RATE * (1 - (epoch * batches + b) / (epochs * batches))
            back = error @ weight.T
            weight -= rate * (mean.T @ error) / len(take)
            bias -= rate * error.mean(axis=0)
            # a bucket is a small part of its text, so its rate is larger
            embed -= rate * EMBED_RATE * (x.T @ back) / len(take)
    scores = embed @ weight
    model = LanguageModel(languages, np.ascontiguousarray(scores.T.astype(np.float32)), bias, 1.0, 0.0)
    left = np.flatnonzero(np.arange(len(rows)) % 5 == 4)
    left = left if len(left) else fit
    logits = np.concatenate([dense(rows, i, i + 1) @ scores + bias for i in left])
    # smoothed as if one more row were wrong, so that separable languages keep a finite confidence
    slack = 1 / (len(left) + 2)
    loss = {}
    for t in np.geomspace(0.001, 10, 121):
        p = np.log(softmax(logits / t) + 1e-300)
        own = p[np.arange(len(left)), truth[left]]
        loss[t] = -((1 - slack) * own + slack * (p.sum(axis=1) - own) / max(len(languages) - 1, 1)).mean()
    model.temperature = float(min(loss, key=loss.get))
    p = softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth[left]]
    model.threshold = float(min(REJECT_BELOW, np.quantile(right, REJECT_SHARE, method="lower"))) if len(right) else 1.0
    return model


OWN = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
])


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Language, calibrated confidence and rejection of every whole text.

    A null text and one without any letter get ``und`` with score 0 and are
    rejected, as is every text if the model knows no language. ``rejected``
    marks other texts whose confidence is below the model's threshold; they keep
    their best guess. Other columns pass through, those named like a result are
    replaced. Repeated rows get equal results.
    """

    def measure(texts: pa.Array) -> dict[str, object]:
        data, at = flat(texts)
        if not model.languages:
            n = len(at) - 1
            return {"lang_pred": [NO_LANGUAGE] * n, "score": np.zeros(n), "rejected": np.ones(n, bool)}
        p = model.probabilities(data, at)
        best = p.argmax(axis=1)
        score = p[np.arange(len(p)), best]
        return {"lang_pred": [model.languages[b] for b in best], "score": score, "rejected": score < model.threshold}

    keep = [c for c in (docs.columns if keep is None else keep) if c not in OWN.names]
    letters = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    others = [c for c in keep if c != text_col]
    row = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")] if others else []
    inner = docs.select(*row, letters.alias("letters"), F.col(f"`{text_col}`").alias("text"))
    carried = ["row"] * bool(others) + ["letters"] + ["text"] * (text_col in keep)
    found = with_measures(inner, "text", carried, OWN, measure, TEXT_BYTES)
    return found.select(
        *[F.col("text" if c == text_col else f"row.`{c}`").alias(c) for c in keep],
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(NO_LANGUAGE).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        (F.col("rejected") | ~F.col("letters")).alias("rejected"),
    )
