"""Intermediate results that outlive executors, and bounded hints about keys."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.scratch import shared_folder

PRUNE_BUCKETS = 1 << 16
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def checkpointed(df: DataFrame) -> DataFrame:
    """Computes the frame once into the shared checkpoint folder and cuts its lineage.

    Spark removes the files with the frame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def use_checkpoints(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs inside gets its rows in Arrow batches of about ``size`` bytes, one row at least.

    By default a batch has up to 10,000 rows and 64 MB, which the JVM and the
    Python worker of a task each hold once or twice.
    """
    before = spark.conf.get(BATCH_CONF, "64m")
    spark.conf.set(BATCH_CONF, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def prune(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, buckets: int = PRUNE_BUCKETS) -> DataFrame:
    """Drops rows whose key falls in no bucket of a wanted key, before a join on that key.

    The driver sees the buckets as a bit map of ``buckets`` / 64 numbers
    whatever the size of ``wanted``, and the plan holds it as one literal. If
    most buckets are taken the filter is left out.
    """
    bucket = wanted.select(bucket_of(wanted_key, buckets).alias("b"))
    bit = F.expr("shiftleft(1L, b & 63)")
    words = {r[0]: r[1] for r in bucket.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(bit).alias("bits")).collect()}
    if 2 * sum((v & (1 << 64) - 1).bit_count() for v in words.values()) > buckets:
        return df
    bits = F.from_json(F.lit(json.dumps([words.get(w, 0) for w in range(buckets // 64)])), "array<bigint>")
    here = bucket_of(key, buckets)
    word = F.get(bits, F.shiftright(here, 6))
    return df.where(F.call_function("shiftright", word, here.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1)
