"""Joins with a table of distinct keys of which a few may stand on most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT = 256


def join_back(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], weight: Column, total: int, spread: Column) -> DataFrame:
    """Left join with ``values`` of a table of distinct, non-null ``keys``.

    ``weight`` is the number of left rows of a key and ``total`` that of all.
    Keys with more than 1/HOT of the rows, so fewer than HOT of them, come by
    broadcast. The rest meets by a shuffle on 128 bits of hash of the keys, and
    rows that are served already are scattered by ``spread``.
    """
    value = F.struct(*[F.col(v) for v in values])
    often = weight * HOT > F.lit(total)
    hot = right.where(often).select(*keys, value.alias("__hot"))
    cold = right.where(~often).select(F.xxhash64(*keys).alias("__k1"), F.xxhash64(F.lit(7), *keys).alias("__k2"), value.alias("__cold"))
    served = left.join(F.broadcast(hot), keys, "left")
    hashed = served.withColumns({
        "__k1": F.when(F.col("__hot").isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(spread)),
        "__k2": F.when(F.col("__hot").isNull(), F.xxhash64(F.lit(7), *keys)).otherwise(F.lit(0).cast("long")),
    })
    found = hashed.join(cold, ["__k1", "__k2"], "left").withColumn("__hot", F.coalesce("__hot", "__cold"))
    return found.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__hot.{v}").alias(v) for v in values])
