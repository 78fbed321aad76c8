"""Splits, folds, samples and class balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import catalogue, table
from catalogue.cleaning import HASH
from catalogue.encoding import hash_split_sql
from plumbline.operators import balance, sample


@catalogue.add("WITH " + hash_split_sql("labels", "doc_id", "quality") + "SELECT doc_id, quality, toxic, split FROM assigned")
def split_stratified(spark: SparkSession, folder: str) -> DataFrame:
    return sample.split_train_test(table(spark, folder, "labels"), "doc_id", "quality")


@catalogue.add(f"""
SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY {HASH.format(key='c_custkey')})
  <= ceil(round(count(*) OVER () * 0.2, 9)) THEN 'test' ELSE 'train' END AS split FROM customer
""")
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    return sample.split_train_test(table(spark, folder, "customer").select("c_custkey"), "c_custkey")


@catalogue.add(f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {HASH.format(key='doc_id')}) AS rn,
    count(*) OVER (PARTITION BY quality) AS n FROM labels
)
SELECT doc_id, quality, toxic, CAST((rn - 1) * 6 // n AS INTEGER) AS fold FROM ranked
""")
def kfold_assign(spark: SparkSession, folder: str) -> DataFrame:
    return sample.assign_folds(table(spark, folder, "labels"), "doc_id", "quality", k=6)


@catalogue.add(f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {HASH.format(key='o_orderkey')} LIMIT 500")
def sample_n(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sample.sample_rows(orders, "o_orderkey", n=500)


@catalogue.add(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {HASH.format(key='o_orderkey')} < {1 << 58}")
def sample_fraction(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sample.sample_rows(orders, "o_orderkey", fraction=0.25)


def labelled_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with two sizes measured on their whole text."""
    documents = table(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split("text", " ")).cast("double").alias("words"),
    )
    return table(spark, folder, "labels").join(documents, "doc_id")


@catalogue.add(f"""
WITH d AS (
  SELECT doc_id, CAST(n_chars AS DOUBLE) AS f0, CAST(len(string_split(text, ' ')) AS DOUBLE) AS f1, quality
  FROM labels JOIN documents USING (doc_id)
), m AS (
  SELECT count(*) FILTER (quality = 0) AS n, count(*) FILTER (quality = 1) - count(*) FILTER (quality = 0) AS missing FROM d
), minority AS (
  SELECT doc_id, f0, f1, count(*) OVER (PARTITION BY f0, f1) AS copies,
    row_number() OVER (ORDER BY {HASH.format(key='doc_id')}) AS rn FROM d WHERE quality = 0
), draws AS (
  SELECT doc_id, f0, f1, copies, unnest(range(1, missing // n + CAST(rn <= missing % n AS INTEGER) + 1)) AS draw
  FROM minority, m
), dice AS (
  SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % 5 AS rank, ('0x' || substr(x, 9, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM (SELECT *, md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR), CAST(draw AS VARCHAR))) AS x FROM draws)
), vec AS (
  SELECT f0, f1, count(*) AS copies, min(doc_id) AS vkey FROM minority GROUP BY f0, f1
), near AS (
  SELECT a.f0, a.f1, b.f0 AS g0, b.f1 AS g1, b.copies AS n, a.copies - 1 + sum(b.copies) OVER (
    PARTITION BY a.vkey ORDER BY (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1), b.vkey
    ROWS UNBOUNDED PRECEDING) AS upto
  FROM vec a JOIN vec b ON a.vkey <> b.vkey
)
SELECT doc_id, 0 AS draw, round(f0, 6) AS chars, round(f1, 6) AS words, quality FROM d
UNION ALL
SELECT doc_id, CAST(draw AS INTEGER), round(dice.f0 + u * (coalesce(g0, dice.f0) - dice.f0), 6),
  round(dice.f1 + u * (coalesce(g1, dice.f1) - dice.f1), 6), 0
FROM dice LEFT JOIN near
  ON near.f0 = dice.f0 AND near.f1 = dice.f1 AND rank >= upto - n AND rank < upto
""")
def smote(spark: SparkSession, folder: str) -> DataFrame:
    out = balance.smote(labelled_sizes(spark, folder), ["chars", "words"], "quality", "doc_id")
    return out.withColumns({c: F.round(c, 6) for c in ("chars", "words")})


@catalogue.add("WITH " + hash_split_sql("orders", "o_orderkey", "o_custkey") + "SELECT o_orderkey, o_custkey, split FROM assigned")
def split_many_strata(spark: SparkSession, folder: str) -> DataFrame:
    """A stratum for every customer: sizes and cuts are tables."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return sample.split_by_table(orders, "o_orderkey", "o_custkey")


@catalogue.add(f"""
WITH ranked AS (
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {HASH.format(key='o_orderkey')}) AS rn,
    count(*) OVER (PARTITION BY o_custkey) AS n FROM orders
)
SELECT o_orderkey, o_custkey, CAST((rn - 1) * 5 // n AS INTEGER) AS fold FROM ranked
""")
def kfold_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return sample.folds_by_table(orders, "o_orderkey", "o_custkey")
