"""Removing lines that stand earlier in the corpus, up to one edit (DataFrame operations only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import checkpointed, prune

MIN_CHARS = 40
EXACT_CHARS = 12  # a few words
EDITS = 1
SMALL_GROUP = 32
WHITE = " \t\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def edit_distance(x: Column, y: Column, edits: int = EDITS) -> Column:
    """Edit distance of two strings whose lengths differ by ``edits`` at most and reach it; right up to ``edits``.

    Bit-parallel over a band of ``2 * edits + 1`` diagonals: one pass over ``y``
    keeps the vertical differences of the band as bits of two numbers and the
    distance at its lower edge.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    full = F.lit(mask).cast("bigint")
    xs, ys = F.split(x, ""), F.split(y, "")
    m = F.length(x)

    def bit(value: Column, place) -> Column:
        return F.when(value.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), place)) != 0, 1).otherwise(0)

    def column(pair: Column) -> Callable[[Column, Column], Column]:
        def step(state: Column, j: Column) -> Column:
            equal = sum(
                (F.when(F.get(pair["xs"], j - edits + b - 1) == F.get(pair["ys"], j - 1), F.lit(1 << b)).otherwise(0) for b in range(width)), F.lit(0)
            ).cast("bigint")

            def after(d0: Column) -> Column:
                hp = state["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(state["vp"]))).bitwiseAND(full)
                hn = d0.bitwiseAND(state["vp"])
                down = F.shiftright(d0, 1)
                on_diagonal = j <= pair["m"] - edits
                place = (pair["m"] - j + edits).cast("int")
                distance = F.when(on_diagonal, state["d"] + 1 - bit(d0, F.lit(width - 1))).otherwise(
                    state["d"] + bit(hp, F.greatest(place, F.lit(0))) - bit(hn, F.greatest(place, F.lit(0)))
                )
                return F.struct(
                    hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(full).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"), distance.cast("int").alias("d"),
                )

            vp, vn = state["vp"], state["vn"]
            return let(equal, lambda e: let(
                ((e.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(e).bitwiseOR(vn).bitwiseAND(full), after
            ))

        return step

    start = F.struct(
        F.lit((mask << edits) & mask).cast("bigint").alias("vp"), F.lit(0).cast("bigint").alias("vn"), F.lit(edits).cast("int").alias("d")
    )
    pair = F.struct(xs.alias("xs"), ys.alias("ys"), m.alias("m"))
    return let(pair, lambda p: F.aggregate(F.sequence(F.lit(1), F.length(y)), start, column(p), lambda s: s["d"]))


def one_place(x: Column, y: Column) -> Column:
    """Whether two strings can differ in one place only: at every eighth one side of the cut agrees. Cheap, and true for every pair one edit apart."""
    short = F.least(F.length(x), F.length(y))
    agree = F.lit(True)
    for eighth in range(1, 8):
        cut = F.floor(short * eighth / 8).cast("int")
        rest = F.greatest(short - cut, F.lit(0)).cast("int")
        agree = agree & ((F.left(x, cut) == F.left(y, cut)) | (F.right(x, rest) == F.right(y, rest)))
    return agree


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, same, no, line, h1, h2) of every line with ``min_chars`` characters, from (id, text)."""
    exploded = docs.select("id", F.xxhash64("text").alias("same"), F.posexplode(F.split("text", "\n", -1)).alias("no", "raw"))
    line = exploded.select("id", "same", "no", F.btrim("raw", F.lit(WHITE)).alias("line")).where(F.length("line") >= min_chars)
    return line.select("*", F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"))


def segment_keys(lines: DataFrame) -> DataFrame:
    """(h1, key, segment, indexed): halves of a line under its own length, and where they would be in a line one shorter.

    Of two lines one edit apart, one half stands unchanged in both: at the same
    place behind the start, or at the same distance from the end.
    """
    n = F.length("line")

    def key(segment: int, length: Column, start: Column, size: Column, indexed: bool) -> Column:
        part = F.substring(F.col("line"), start, size)
        return F.struct(F.xxhash64(F.lit(segment), length, part).alias("key"), F.lit(segment).alias("segment"), F.lit(indexed).alias("indexed"))

    half, shorter = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    one = F.lit(1)
    keys = F.array(
        key(1, n, one, half, True), key(2, n, half + 1, n, True),
        key(1, n - 1, one, shorter, False), key(2, n - 1, shorter + 2, n, False),
    )
    return lines.select("h1", F.explode(keys).alias("k")).select("h1", "k.*")


def without_character(text: Column, place: Column) -> Column:
    return F.concat(F.substring(text, F.lit(1), place - 1), F.substring(text, place + 1, F.length(text)))


def links_of_large_groups(rows: DataFrame, info: DataFrame) -> DataFrame:
    """Links in groups that share a half, without pairing the members: by the other half less one character.

    Lines that agree but for the character at one place are all one edit apart,
    so each is linked with the earliest of them. A line that loses a character
    and then equals a shorter line is linked with that one.
    """
    n = F.length("line")
    cut = F.floor(F.when(F.col("indexed"), n / 2).otherwise((n - 1) / 2)).cast("int")
    left_size = F.when(F.col("indexed"), cut).otherwise(cut + 1)
    rest = F.when(F.col("segment") == 1, F.substring(F.col("line"), cut + 1, n)).otherwise(F.substring(F.col("line"), F.lit(1), left_size))
    held = rows.join(info, "h1").select("key", "h1", "first", "indexed", rest.alias("rest"))
    shortened = held.select("*", F.explode(F.sequence(F.lit(1), F.length("rest"))).alias("place")).select(
        "key", "h1", "first", "indexed", "place", F.xxhash64(without_character(F.col("rest"), F.col("place"))).alias("less")
    )
    variants = shortened.where("indexed")
    group = ["key", "place", "less"]
    earliest = variants.groupBy(*group).agg(F.min_by("h1", "first").alias("x"), F.count("*").alias("n")).where("n > 1").drop("n")
    swapped = variants.join(earliest, group).select("x", F.col("h1").alias("y")).where("x != y")
    whole = held.where("indexed").select("key", F.xxhash64("rest").alias("less"), F.col("h1").alias("x"))
    inserted = shortened.where("not indexed").join(whole, ["key", "less"]).select("x", F.col("h1").alias("y"))
    return swapped.union(inserted)


def near_lines(lines: DataFrame) -> DataFrame:
    """(h1) of the distinct lines that are one edit from a line standing earlier."""
    keyed = segment_keys(lines)
    shared = checkpointed(
        keyed.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.bool_or("indexed").alias("some"))
        .where("lo != hi and some").select("key")
    )
    rows = checkpointed(keyed.join(shared, "key").distinct())
    wanted = checkpointed(rows.select("h1").distinct())
    info = checkpointed(
        prune(lines, F.col("h1"), wanted, F.col("h1")).join(wanted, "h1")
        .groupBy("h1").agg(F.min(F.struct("id", "same", "no")).alias("first"), F.min("line").alias("line"))
    )
    sized = checkpointed(rows.join(rows.groupBy("key").agg(F.count("*").alias("members")), "key"))
    small, large = sized.where(F.col("members") <= SMALL_GROUP), sized.where(F.col("members") > SMALL_GROUP)
    left = small.where("indexed").select("key", F.col("h1").alias("x"))
    right = small.select("key", F.col("h1").alias("y"), F.col("indexed").alias("other"))
    pairs = left.join(right, "key").where("x != y and (not other or x < y)").select("x", "y")
    pairs = pairs.union(links_of_large_groups(large, info)).distinct()
    sides = pairs.join(info.toDF("x", "fx", "lx"), "x").join(info.toDF("y", "fy", "ly"), "y")
    sides = sides.where((F.abs(F.length("lx") - F.length("ly")) <= EDITS) & one_place(F.col("lx"), F.col("ly")))
    linked = sides.where(edit_distance(F.col("lx"), F.col("ly")) <= EDITS)
    return linked.select(F.when(F.col("fx") < F.col("fy"), F.col("y")).otherwise(F.col("x")).alias("h1")).distinct()


def dedup_lines(
    docs: DataFrame, keep: list[str] | None = None, min_chars: int | None = None, id_col: str = "doc_id", text_col: str = "text",
    exact_chars: int | None = None,
) -> DataFrame:
    """Documents without the lines that stand earlier, in an equal or nearly equal form.

    Lines end at newlines; white space around them does not count. Lines of
    ``exact_chars`` characters or more go if the same line stands earlier: in a
    document of smaller id, or above it. Those of ``min_chars`` or more go also if
    a line of that size one edit away (a character more, less or other) stands
    earlier. By default that is EXACT_CHARS and MIN_CHARS; ``min_chars`` alone
    holds for both. Shorter lines always stay. Of a chain of near lines only the
    first stays, since each has an earlier one beside it.

    Equal lines meet by a 128-bit hash, near ones by a shared half; groups that
    share a half are paired if they are small and resolved by the other half
    with one character left out if they are large, so nothing grows with the
    square of a group. Candidates pass a comparison by eighths and the banded
    edit distance.

    Returns ``keep`` (all columns by default) with the text replaced, and
    ``n_lines`` and ``n_removed``, which replace columns of the same name. A null
    text stays null with no lines. Rows with the same id and text are one
    document: they are treated alike, and lines of it elsewhere go. A row
    without an id counts as the last one.
    """
    if exact_chars is None:
        exact_chars = EXACT_CHARS if min_chars is None else min_chars
    min_chars = MIN_CHARS if min_chars is None else min_chars
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_lines", "n_removed")]
    narrow = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)).alias("id"), F.col(text_col).alias("text"))
    lines = lines_of(narrow.where("text is not null"), min(exact_chars, min_chars))
    place = F.struct("id", "same", "no")
    twice = lines.where(F.length("line") >= exact_chars).groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    twice = checkpointed(twice)
    near = checkpointed(near_lines(lines.where(F.length("line") >= min_chars)))
    spots = lines.select("id", "same", "no", "h1", "h2")
    again = spots.join(twice, ["h1", "h2"]).where(place != F.col("first")).select("id", "same", "no")
    gone = again.union(spots.join(near, "h1").select("id", "same", "no"))
    removed = checkpointed(gone.groupBy("id", "same").agg(F.collect_set("no").alias("gone")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(text_col).alias("same"),
    )
    joined = rows.join(removed, ["id", "same"], "left")
    all_lines = F.split("text", "\n", -1)
    left = let(all_lines, lambda ls: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: F.get(ls, i)), "\n"
    ))
    # a sequence from 0 to 0 is one line; a text is never without lines
    new_text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)
    out = [new_text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in keep]
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(all_lines))
    return joined.select(
        *out, count.cast("bigint").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed")
    )
