"""The operators of this package over the shared tables, and SQL for those it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import codes, language, lines, minhash, mixing, ngram, packing, periodic, preference, repetition, template, urls, whitening

QUERIES = {}
SQL = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL["op1_mix_sources"] = """
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
blocks AS (SELECT (floor(floor(sqrt(count(*))) / 4) + 1)::BIGINT AS b FROM documents),
placed AS (
  SELECT doc_id, src, size, floor(log2(size + 1))::BIGINT * b
         + (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % b) AS block FROM sized, blocks),
totals AS (
  SELECT src, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS most,
         CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sized GROUP BY src),
sums AS (SELECT 1.5::DOUBLE * sum(source_size) AS goal, sum(w) AS weight FROM totals),
steps AS (
  SELECT 0 AS j, (goal / weight)::DOUBLE AS lvl FROM sums
  UNION ALL
  SELECT j, ((goal - gone) / (weight - lost))::DOUBLE FROM (
    SELECT row_number() OVER o AS j, sum(most) OVER o AS gone, sum(w) OVER o AS lost
    FROM totals WINDOW o AS (ORDER BY most::DOUBLE / w, src)), sums WHERE weight > lost),
lined AS (SELECT *, row_number() OVER (ORDER BY most::DOUBLE / w, src) AS j FROM totals),
level AS (
  SELECT lvl FROM steps s WHERE NOT EXISTS (SELECT 1 FROM lined l WHERE l.j > s.j AND l.most <= l.w * s.lvl) ORDER BY j LIMIT 1),
targets AS (
  SELECT src, source_size, least(most::DOUBLE, w * lvl) AS target,
         CASE WHEN source_size > 0 THEN least(most::DOUBLE, w * lvl) / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix' || src), 1, 5))::BIGINT::DOUBLE / 1048576.0::DOUBLE AS u FROM totals, level),
ranked AS (
  SELECT doc_id, size, source_size, target, rate, u,
         row_number() OVER (PARTITION BY src ORDER BY block, size, doc_id) - 1 AS k FROM placed JOIN targets USING (src))
SELECT doc_id, size, source_size, target,
       (least(floor(u + rate * (k + 1)) - floor(u + rate * k), ceil(rate)) * size)::BIGINT AS taken FROM ranked
"""


@query
def op2_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, folder, "documents"), keep=["doc_id"]).drop("spans")


def remainder(n: int):
    """crc32 of the id's decimal digits modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train_language_model(docs.where(remainder(5) != 0), F.col("doc_id"))
    found = language.predict_languages(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), keep=["doc_id"])


@query
def op7_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.near_vectors(table(spark, folder, "embeddings"))


def tokenizer_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op10_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file())


@query
def op9_ngram(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = ngram.train(docs.where(remainder(7) != 2))
    scored = ngram.score_texts(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select(
        "doc_id", (remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


@query
def op8_template(spark: SparkSession, folder: str) -> DataFrame:
    return template.extract_main_text(table(spark, folder, "pages"))


@query
def op4_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.dedup_lines(table(spark, folder, "documents"), keep=["doc_id", "text"])


@query
def op6_preference(spark: SparkSession, folder: str) -> DataFrame:
    conversations = preference.conversations_of(table(spark, folder, "conversations"))
    found = preference.format_preferences(conversations, preference.pair_by_first_turn(conversations))
    trained = lambda c: F.coalesce(F.length(preference.rendered(F.filter(c, lambda p: p["train"]))), F.lit(0)).cast("bigint")
    return found.select(
        "chosen_id", "rejected_id", "n_common", "prompt",
        preference.rendered(F.col("chosen")).alias("chosen"), preference.rendered(F.col("rejected")).alias("rejected"),
        trained(F.col("chosen")).alias("chosen_trained"), trained(F.col("rejected")).alias("rejected_trained"),
    )


SQL["op6_preference"] = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM t GROUP BY conv_id),
b AS (SELECT (floor(floor(sqrt(count(*))) / 4) + 1)::BIGINT AS n FROM c),
ranked AS (
  SELECT conv_id, turns, turns[1] AS head, row_number() OVER (
    PARTITION BY turns[1] ORDER BY ('0x' || substr(md5(conv_id::VARCHAR), 1, 8))::BIGINT % n, conv_id) - 1 AS k FROM c, b),
pairs AS (
  SELECT x.conv_id AS chosen_id, y.conv_id AS rejected_id, x.turns AS a, coalesce(y.turns, []) AS b
  FROM ranked x LEFT JOIN ranked y ON x.head = y.head AND y.k = x.k + 1 WHERE x.k % 2 = 0),
cut AS (
  SELECT *, coalesce(list_position(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda i: coalesce(a[i] = b[i], false)), false) - 1,
                     greatest(len(a), len(b)))::INTEGER AS n_common FROM pairs),
parts AS (SELECT chosen_id, rejected_id, n_common, a[1:n_common] AS p, a[n_common + 1:] AS x, b[n_common + 1:] AS y FROM cut)
SELECT chosen_id, rejected_id, n_common,
  coalesce(array_to_string(list_transform(p, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(x, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)), ''), '') AS chosen,
  coalesce(array_to_string(list_transform(y, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)), ''), '') AS rejected,
  coalesce(list_sum(list_transform(list_filter(x, lambda t: t.role = 'assistant'), lambda t: length(replace(t.text, '<|', '< |')) + 8)), 0)::BIGINT AS chosen_trained,
  coalesce(list_sum(list_transform(list_filter(y, lambda t: t.role = 'assistant'), lambda t: length(replace(t.text, '<|', '< |')) + 8)), 0)::BIGINT AS rejected_trained
FROM parts
"""


# Verdicts by host and path.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query
def op11_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES, keep=["page_id"])


SQL["op11_url_templates"] = urls.judge_sql(URL_RULES)


@query
def op12_whiten(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten_vectors(table(spark, folder, "embeddings"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document by its id's checksum with its words from one place on repeated periodically."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, a, p = F.col("__n"), F.col("__a"), F.col("__p")
    g = F.floor(h / 10)
    planted = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return (
        docs.withColumn("__words", F.when(h % 10 == 0, words)).withColumn("__n", F.size("__words").cast("long"))
        .withColumn("__a", F.when(n > 0, g % n)).withColumn("__p", 1 + F.floor((n - a) / (3 + g % 8)))
        .withColumn("text", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")))
        .drop("__words", "__n", "__a", "__p")
    )


@query
def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_planted_runs(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs, keep=["doc_id"])
    best = F.get(F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
