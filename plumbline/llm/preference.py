"""Preference pairs: the shared beginning of two conversations and their masked endings (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.ranks import block_offsets, hash_block, rank_in_blocks, sub_blocks
from plumbline.llm.shared import checkpointed

TRAINED_ROLE = "assistant"


def conversations_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    own = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
        ).alias("t"),
    )
    return own.groupBy("conv_id").agg(F.sort_array(F.collect_set("t")).alias("turns"))


def pair_by_first_turn(conversations: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): conversations with an equal first turn, two by two.

    They are ranked by a hash block and their id, in blocks, so that a first
    turn many conversations share is no single task's; ranks 0 and 1, 2 and 3
    and so on make pairs. The last of an odd number has no partner.
    """
    first = F.get("turns", F.lit(0))
    base = conversations.select(
        "conv_id", F.xxhash64(first["role"], first["text"]).alias("g1"), F.xxhash64(F.lit(1), first["role"], first["text"]).alias("g2")
    )
    base = base.withColumn("block", hash_block(F.col("conv_id"), sub_blocks(conversations.count())))
    counts = base.groupBy("g1", "g2", "block").agg(F.count("*").alias("rows"))
    before = checkpointed(block_offsets(counts, ["g1", "g2"], "block", "rows", "before").select("g1", "g2", "block", "before"))
    ranked = rank_in_blocks(base.join(before, ["g1", "g2", "block"]), ["g1", "g2"], "block", [F.col("conv_id")], "before", "k")
    side = lambda n: F.max(F.when(F.col("k") % 2 == n, F.col("conv_id")))
    pairs = ranked.groupBy("g1", "g2", F.floor(F.col("k") / 2).alias("pair")).agg(side(0).alias("chosen_id"), side(1).alias("rejected_id"))
    return pairs.select("chosen_id", "rejected_id")


def clean(text: Column) -> Column:
    """Texts cannot contain the marks that separate turns."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def segments(turns: Column) -> Column:
    """Pieces of the rendered turns with what is trained: texts of the trained role and the mark that ends them."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit("<|"), clean(t["role"]), F.lit("|>\n")).alias("text"), F.lit(False).alias("train")),
        F.struct(F.concat(clean(t["text"]), F.lit("<|end|>\n")).alias("text"), (t["role"] == TRAINED_ROLE).alias("train")),
    )))


def rendered(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def format_preferences(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Prompt and masked completions of each pair (chosen_id, rejected_id) of conversations.

    The prompt is the longest sequence of turns, by role and text, that both
    begin with, rendered once; the completions are what follows in each, as
    pieces with a mask. Without a rejected conversation nothing is shared: the
    prompt is empty and the chosen one is the completion. Of equal conversations
    all is prompt and both completions are empty.

    Turns are sorted by number, then role and text; repeated rows of a turn count
    once; a null role or text is empty; rows without a conversation id belong to
    none. Other columns are ignored.
    """
    left = conversations.toDF("chosen_id", "a")
    right = conversations.toDF("rejected_id", "b")
    both = pairs.join(left, "chosen_id").join(right, "rejected_id", "left").withColumn("b", F.coalesce("b", F.array_compact(F.slice("a", 1, 0))))
    same = F.zip_with("a", "b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    differ = F.array_position(same, False)
    common = F.when(differ == 0, F.size(same)).otherwise(differ - 1).cast("int")
    both = both.withColumn("n_common", common)
    after = lambda c: segments(F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0))))
    return both.select(
        "chosen_id", "rejected_id", "n_common", rendered(segments(F.slice("a", F.lit(1), F.col("n_common")))).alias("prompt"),
        after("a").alias("chosen"), after("b").alias("rejected"),
    )
