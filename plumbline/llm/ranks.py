"""Ranks within large groups without bringing a group into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import checkpointed


def sub_blocks(rows: int) -> int:
    """Hash blocks per group: neither a block nor the list of blocks outgrows about the root of the rows."""
    return math.isqrt(rows) // 4 + 1


def hash_block(key: Column, blocks: int) -> Column:
    """A block number below ``blocks`` from the md5 of the key."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(blocks))


def block_offsets(counts: DataFrame, keys: list[str], block: str, rows: str, offset: str) -> DataFrame:
    """For a row per (group, block) with its number of rows: the rows of the group in earlier blocks."""
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(offset, F.coalesce(F.sum(rows).over(before), F.lit(0)).cast("bigint"))


def rank_in_blocks(df: DataFrame, keys: list[str], block: str, order: list[Column], offset: str, rank: str) -> DataFrame:
    """0-based rank in the group, by block and then by ``order``; the frame carries its block's offset."""
    inside = Window.partitionBy(*keys, block).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(inside) - 1 + F.col(offset))


def global_rank(df: DataFrame, order: str, rank: str) -> DataFrame:
    """0-based rank over all rows of a frame of distinct ``order`` values, sorted by ranges."""
    part = "__part"
    ranged = checkpointed(df.repartitionByRange(order).withColumn(part, F.spark_partition_id()))
    sizes = block_offsets(ranged.groupBy(part).agg(F.count("*").alias("__rows")), [F.lit(0)], part, "__rows", "__before")
    inside = Window.partitionBy(part).orderBy(order)
    return (
        ranged.join(sizes.drop("__rows"), part)
        .withColumn(rank, F.row_number().over(inside) - 1 + F.col("__before"))
        .drop(part, "__before")
    )
