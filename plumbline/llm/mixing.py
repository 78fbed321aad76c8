"""Mixing sources to target weights by systematic sampling (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.ranks import block_offsets, global_rank, hash_block, rank_in_blocks, sub_blocks
from plumbline.llm.shared import checkpointed
from plumbline.llm.text import WORD_PATTERN

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2


def word_count(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """Target words of each source, from rows (src, source_size) with distinct ``src``.

    Sources in code point order take the weights in turn. Together they get
    ``share`` times all words; no target exceeds ``limit`` times its source, and
    what is cut off goes to the others by weight until none is above. Each pass
    reads four sums; passes end when no further source is cut off.
    """
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("r") % len(weights) + 1).cast("int"))
    ranked = checkpointed(
        global_rank(sizes, "src", "r").select("src", "source_size", turn.alias("w"), (F.col("source_size") * limit).alias("most"))
    )
    total, weight = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    level, cut = (share * total / weight, 0) if total else (0.0, 0)
    while total:
        above = F.col("most") <= F.col("w") * F.lit(level)
        n, gone, left = ranked.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)), F.sum(F.when(~above, F.col("w")))
        ).first()
        if n == cut or not left:
            break
        level, cut = (share * total - gone) / left, n
    target = F.least(F.col("most").cast("double"), F.col("w") * F.lit(level))
    return ranked.select("src", "source_size", target.alias("target"))


def offset_of(source: Column) -> Column:
    """The source's random offset in [0, 1), in steps of 2**-20."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix"), source)), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)


def mix_sources(
    docs: DataFrame, keep: list[str] | None = None, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """How many copies of each document a mix with target weights takes.

    Within a source every document is expected ``target / source_size`` times.
    The prefix sum of these expectations, shifted by one random offset, crosses
    an integer once for every copy to emit. Documents stand by size class, a
    hash of the id, size and id, so that the copies are spread evenly over sizes
    and the words taken come close to the target.

    Returns the columns ``keep`` (all by default) and ``size``, ``source_size``,
    ``target``, ``copies``, ``taken``; these replace columns of the same name.
    A null source is a source of its own, the last in order. Null or empty texts
    have size 0, and a source of size 0 takes none. Repeated rows are documents
    of their own; rows that agree in id, size and source may swap their copies.
    An empty table gives an empty result.
    """
    keep = docs.columns if keep is None else keep
    blocks = sub_blocks(docs.count())
    size = word_count(F.col(text_col))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.coalesce(F.concat(F.lit("0"), F.col(source_col)), F.lit("1")).alias("src"),
        F.col(id_col).alias("id"), size.alias("size"), F.xxhash64(text_col).alias("same"),
    )
    kind = F.floor(F.log2(F.col("size") + 1)).cast("bigint")
    base = base.withColumn("block", kind * blocks + hash_block(F.coalesce(F.col("id").cast("string"), F.lit("")), blocks))
    counted = checkpointed(base.groupBy("src", "block").agg(F.count("*").alias("rows"), F.sum("size").alias("words")))
    targets = source_targets(counted.groupBy("src").agg(F.sum("words").alias("source_size")), weights, share, limit)
    placed = checkpointed(
        block_offsets(counted, ["src"], "block", "rows", "before").select("src", "block", "before").join(targets, "src")
    )
    ranked = rank_in_blocks(
        base.join(placed, ["src", "block"]), ["src"], "block", [F.col("size"), F.col("id"), F.col("same")], "before", "k"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = offset_of(F.col("src"))
    crossed = F.floor(start + F.col("rate") * (F.col("k") + 1)) - F.floor(start + F.col("rate") * F.col("k"))
    copies = F.least(crossed, F.ceil(F.col("rate"))).cast("bigint")
    own = ("size", "source_size", "target", "copies", "taken")
    return (
        ranked.withColumn("rate", rate).withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*[F.col(f"row.`{c}`").alias(c) for c in keep if c not in own], *own)
    )


def repeat_documents(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    return (
        mixed.where(F.col("copies") > 0)
        .withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*columns)
    )
