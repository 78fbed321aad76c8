"""Exact rank selection per stratum where the strata are rows of a table.

``rank_cuts`` keeps the strata on the driver and compares with literals, which
suits some hundreds of classes. Here counts, wanted ranks and cuts are tables,
so their number is bounded by the data alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.hashing import HASH_BITS, HASH_SPAN
from plumbline.functions.joins import join_back
from plumbline.functions.ranks import rank_rows
from plumbline.sources.scratch import materialize_once

RADIX_BITS = 12
LEAF_ROWS = 65_536


def stratum_key(stratum: Column) -> Column:
    """A stratum as non-null text; null is a stratum too."""
    return F.when(stratum.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), stratum.cast("string")))


def stratum_counts(rows: DataFrame) -> DataFrame:
    """``s, n`` from rows with a stratum key ``s``."""
    return materialize_once(rows.groupBy("s").agg(F.count("*").alias("n")), "strata")


def largest_remainder(counts: DataFrame, test_size: float) -> DataFrame:
    """``s, n, k``: test rows per stratum, ``ceil(n * test_size)`` of all rows in total, by largest remainder."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    wanted = F.ceil(F.round(F.lit(total * test_size), 9))
    share = wanted.cast("double") * F.col("n") / F.lit(float(max(total, 1)))
    shared = counts.select("s", "n", share.alias("share"), F.floor(share).alias("k"))
    text = F.when(F.col("s") == "0", "None").otherwise(F.substr("s", F.lit(2)))
    ranked = rank_rows(shared.withColumn("gap", F.col("k") - F.col("share")).withColumn("name", text), ["gap", "name", "s"], "place")
    left = shared.agg((wanted - F.sum("k")).alias("left")).first()[0] or 0
    return ranked.select("s", "n", (F.col("k") + (F.col("place") < F.lit(left)).cast("long")).alias("k"))


def stratum_cuts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``s, n, cuts``: for each stratum the hash below which exactly ``rank`` of its rows lie, for an array ``ranks``.

    ``rows`` has ``s`` and the row hash ``h``; ``wanted`` has ``s, n, ranks``. A
    pass counts rows by stratum and the next RADIX_BITS of the hash, and leaves
    one bin open for each rank. When every open bin holds LEAF_ROWS rows at most
    the bins are sorted. After the first pass only rows of open bins take part.
    """
    wanted = materialize_once(wanted.select("s", "n", "ranks"), "ranks")
    ends = F.when(F.col("rank") <= 0, F.lit(0)).when(F.col("rank") >= F.col("n"), F.lit(HASH_SPAN))
    every = wanted.select("s", "n", F.posexplode("ranks").alias("j", "rank")).withColumn("end", ends.cast("long"))
    open_ = materialize_once(
        every.where("end IS NULL").select("s", "j", F.col("rank").cast("long").alias("rank"), F.lit(0).cast("long").alias("bin")), "open"
    )
    shift, inside = HASH_BITS, rows
    while True:
        shift = max(0, shift - RADIX_BITS)
        prefix = F.shiftright("h", shift) if shift else F.col("h")
        before = Window.partitionBy("s", "bin").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        counted = inside.withColumn("bin", F.shiftright("h", shift + RADIX_BITS)) if shift + RADIX_BITS < HASH_BITS else inside.withColumn("bin", F.lit(0).cast("long"))
        bins = counted.groupBy("s", "bin", prefix.alias("next")).agg(F.count("*").alias("rows"))
        bins = bins.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        asked = open_.groupBy("s", "bin").agg(F.collect_list(F.struct("j", "rank")).alias("asked"))
        mine = F.filter("asked", lambda a: (a["rank"] >= F.col("before")) & (a["rank"] < F.col("before") + F.col("rows")))
        found = bins.join(asked, ["s", "bin"]).select("s", "next", "rows", "before", F.explode(mine).alias("a"))
        open_ = materialize_once(
            found.select("s", F.col("a.j").alias("j"), (F.col("a.rank") - F.col("before")).alias("rank"), F.col("next").alias("bin"), "rows"), "open"
        )
        most = open_.agg(F.max("rows")).first()[0]
        if shift == 0 or most is None:
            break
        # rows of the open bins only
        held = open_.select("s", F.col("bin").alias("__bin")).distinct()
        inside = inside.withColumn("__bin", prefix).join(held, ["s", "__bin"]).drop("__bin")
        if most <= LEAF_ROWS:
            order = Window.partitionBy("s", "bin").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
            leaves = inside.withColumn("bin", prefix).groupBy("s", "bin", "h").agg(F.count("*").alias("rows"))
            leaves = leaves.withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0)))
            asked = open_.groupBy("s", "bin").agg(F.collect_list(F.struct("j", "rank")).alias("asked"))
            open_ = leaves.join(asked, ["s", "bin"]).select("s", F.explode(mine).alias("a"), "h").select("s", F.col("a.j").alias("j"), F.col("h").alias("bin"))
            break
        inside = materialize_once(inside, "inside")
    cuts = every.join(open_.select("s", "j", "bin"), ["s", "j"], "left").withColumn("cut", F.coalesce("end", "bin"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("j", "cut"))), lambda c: c["cut"])
    return materialize_once(cuts.groupBy("s").agg(F.first("n").alias("n"), ordered.alias("cuts")), "cuts")


def with_cuts(df: DataFrame, stratum: Column, h: Column, cuts: DataFrame, result: str, of: Column) -> DataFrame:
    """Adds ``result``, an expression ``of`` the row hash ``__h`` and the stratum's ``__cuts``."""
    total = cuts.agg(F.sum("n")).first()[0] or 0
    rows = df.withColumns({"__s": stratum_key(stratum), "__h": h})
    joined = join_back(rows, cuts.toDF("__s", "__n", "__cuts"), ["__s"], ["__cuts"], F.col("__n"), total, F.col("__h"))
    return joined.withColumn(result, of).drop("__s", "__h", "__cuts")
