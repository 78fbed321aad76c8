"""Documents to packed training sequences: language, lines, near-duplicates, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.language import predict_languages, train_language_model
from plumbline.llm.lines import dedup_lines
from plumbline.llm.minhash import near_duplicates
from plumbline.llm.mixing import mix_sources, repeat_documents
from plumbline.llm.packing import pack_documents
from plumbline.llm.queries import tokenizer_file
from plumbline.sources.scratch import new_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model is sure of; it learns from the labels in these documents."""
    model = train_language_model(docs, F.col("doc_id"))
    return predict_languages(docs, model).where("not rejected").select(*docs.columns)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; those of which nothing is left go."""
    left = dedup_lines(docs).where("n_removed < n_lines or text is null")
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_duplicates(docs).where("kept is null or kept").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return repeat_documents(mix_sources(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return pack_documents(docs, tokenizer_file())


STAGES = [
    ("language", identify_language),
    ("lines", remove_lines),
    ("near_duplicates", remove_near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

# The sketches, the trained model and the packing are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
