"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.joins import join_back
from plumbline.llm.arrow import with_measures
from plumbline.llm.components import connected_components
from plumbline.llm.shared import checkpointed, prune
from plumbline.llm.text import CHUNK_BYTES, mix, rolling, word_hashes

SHINGLE = 5
PERCENT = 75
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 9
BANDS = 32
ROWS = BUCKETS // BANDS
MARGIN = 0.2  # five standard deviations of the estimate at 0.75
SMALL_BUCKET = 64
BLOCK = 2048
TEXT_BUCKETS = 1 << 18
BLOCK_SHINGLES = 1 << 19
SIZE_STEP = 1.34  # a little over 100 / PERCENT: sizes of a link are in the same class or in adjacent ones

# donors of empty buckets: every bucket asks the others in its own random order
_DONORS = np.stack([np.random.default_rng(b).permutation(BUCKETS) for b in range(BUCKETS)])
#: Chance that two different values share a register: 2**-i for the run of zeros, squared and summed, over the mantissas.
COLLISION = 1 / 3 / (1 << MANTISSA_BITS)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text: 5-word windows, or the whole of fewer words."""
    words, rows = word_hashes(texts, fold_case=True)
    windows = rolling(words, SHINGLE)
    out = []
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(windows[a : b - SHINGLE + 1]))
        else:
            out.append(rolling(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a sorted set that is not empty: per bucket the zero run and mantissa of its least hash.

    The top bits name the bucket. A bucket without a hash takes the register of
    the first one in its own order that has any, marked with that bucket.
    """
    bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    value = shingles[first] << np.uint64(BUCKET_BITS)
    log = np.frexp(value.astype(np.float64))[1]
    zeros = np.where(value > 0, np.maximum(64 - log, 0), 64 - BUCKET_BITS).astype(np.uint64)
    mantissa = (value << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA_BITS)
    filled = np.full(BUCKETS, -1, np.int64)
    filled[bucket[first]] = np.minimum(zeros, 63).astype(np.int64) << MANTISSA_BITS | mantissa.astype(np.int64)
    have = filled >= 0
    donor = _DONORS[np.arange(BUCKETS), have[_DONORS].argmax(axis=1)]
    donor[have] = np.flatnonzero(have)
    # the donor's number is folded in, so that borrowed registers agree only if donors do
    return ((filled[donor] + np.where(have, 0, (donor + 1) * 40503)) & 0xFFFF).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ROWS registers; registers is (n, BUCKETS)."""
    r = registers.astype(np.uint64).reshape(len(registers), BANDS, ROWS)
    packed = (r << (np.arange(ROWS, dtype=np.uint64) * np.uint64(16))).sum(axis=2, dtype=np.uint64)
    return mix(packed + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two (n, BUCKETS) register arrays, corrected for chance collisions."""
    return np.clip(((a == b).mean(axis=1) - COLLISION) / (1 - COLLISION), 0, 1)


def measure(texts: pa.Array) -> dict[str, object]:
    sets = shingle_sets(texts)
    size = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero(size)
    registers = np.stack([sketch(sets[i]) for i in some]) if len(some) else np.zeros((0, BUCKETS), np.uint16)
    keys = band_keys(registers).view(np.int64)
    at = np.zeros(len(sets) + 1, np.int32)
    np.cumsum((size > 0) * BANDS, out=at[1:])
    sketches = [None] * len(sets)
    for i, r in zip(some, registers, strict=True):
        sketches[i] = r.tobytes()
    prints = [[int(mix(s + np.uint64(salt)).sum().view(np.int64)) if len(s) else 0 for s in sets] for salt in (1, 2)]
    return {
        "n": size, "f1": prints[0], "f2": prints[1], "sketch": pa.array(sketches, pa.binary()),
        "bands": pa.ListArray.from_arrays(pa.array(at), pa.array(keys.ravel())),
    }


OWN = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()),
    T.StructField("sketch", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


def similar_by_sketch(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose estimate comes near it."""
    sides = pairs.join(sketches.toDF("a", "na", "sa"), "a").join(sketches.toDF("b", "nb", "sb"), "b")
    sides = sides.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT).select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("sa", "sb"))
                near = pa.array(estimate(a, b) >= PERCENT / 100 - MARGIN)
                yield batch.select(["a", "b"]).filter(near)

    return sides.mapInArrow(run, "a bigint, b bigint")


def texts_for(named: DataFrame, ids: list[str], texts: DataFrame) -> DataFrame:
    """The texts (id, th, text) of the documents that columns ``ids`` name, before a join on them."""
    ends = named.select(F.explode(F.array(*ids)).alias("id"))
    return prune(texts, F.col("id"), ends, F.col("id"), TEXT_BUCKETS)


def verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that share PERCENT of their shingles, by the full sets of the texts that stand for them."""
    named = pairs
    for side in ("a", "b"):
        named = named.join(reps.select(F.col("id").alias(side), F.col("doc").alias(f"d{side}"), F.col("th").alias(f"h{side}")), side)
    named = checkpointed(named)
    texts = texts_for(named, ["da", "db"], texts)
    sides = named.join(texts.toDF("da", "ha", "ta"), ["da", "ha"]).join(texts.toDF("db", "hb", "tb"), ["db", "hb"]).select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            step = max(1, len(batch) * CHUNK_BYTES // max(batch.nbytes, 1))
            for i in range(0, len(batch), step):
                part = batch.slice(i, step)
                same = [
                    100 * (both := len(np.intersect1d(x, y, assume_unique=True))) >= PERCENT * (len(x) + len(y) - both)
                    for x, y in zip(shingle_sets(part.column("ta")), shingle_sets(part.column("tb")), strict=True)
                ]
                yield part.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return sides.mapInArrow(run, "a bigint, b bigint")


ANY = -1


def cells_of(open_: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, a, b, side, id, label, n): members of groups (key, part, id, label) dealt to cells so that any two that may be linked meet in one.

    A group is cut by size class and part; a cell is two blocks of the same or of
    adjacent classes, or one with itself. Blocks of one part do not meet, but for
    the part ANY.
    """
    sized = open_.join(sizes, "id").withColumn("size", F.floor(F.log(F.col("n")) / F.log(F.lit(SIZE_STEP))))
    sized = checkpointed(sized.select("key", "part", "id", "label", "n", "size"))
    counts = sized.groupBy("key", "size", "part").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("count")
    )
    counts = checkpointed(counts)
    number = F.xxhash64("size", "part", "block")
    blocks = counts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("block")).select("key", "size", "part", number.alias("a"))
    other = blocks.toDF("key", "other_size", "other_part", "b")
    apart = (F.col("part") == ANY) | (F.col("part") != F.col("other_part"))
    ordered = (F.col("other_size") == F.col("size") + 1) | ((F.col("other_size") == F.col("size")) & (F.col("a") <= F.col("b")))
    cells = checkpointed(blocks.join(other, "key").where(ordered & apart).select("key", "a", "b"))
    placed = checkpointed(
        sized.join(counts, ["key", "size", "part"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("count")))
        .select("key", "id", "label", "n", number.alias("mine"))
    )
    first = placed.join(cells.withColumn("mine", F.col("a")), ["key", "mine"]).withColumn("side", F.lit(0))
    second = placed.join(cells.where("a != b").withColumn("mine", F.col("b")), ["key", "mine"]).withColumn("side", F.lit(1))
    return first.union(second).select("key", "a", "b", "side", "id", "label", "n")


def groups_of(open_: DataFrame) -> DataFrame:
    """(key, part, id, label): the groups whose members must meet, from open buckets (key, id, label).

    A label with BLOCK members of a bucket becomes a group of its own, one for
    all its buckets: its members there are one part, the members of other labels
    in these buckets the other part. So they meet once, however many bands they
    share. What is left of a bucket is a group if it is still mixed.
    """
    sizes = checkpointed(open_.groupBy("key", "label").agg(F.count("*").alias("members"), F.lit(True).alias("big")))
    total = sizes.agg(F.sum("members")).first()[0] or 0
    large = sizes.where(F.col("members") >= BLOCK)
    marked = checkpointed(join_back(open_, large, ["key", "label"], ["big"], F.col("members"), total, F.col("id")))
    hub = F.xxhash64(F.lit("hub"), F.col("hub"))
    own = marked.where("big").select(F.col("label").alias("hub"), "id", "label").distinct()
    hubs = large.select("key", F.col("label").alias("hub"))
    others = marked.join(hubs, "key").where((F.col("label") != F.col("hub")) & (F.col("big").isNull() | (F.col("label") < F.col("hub"))))
    others = others.select("hub", "id", "label").distinct()
    left = marked.where("big is null")
    mixed = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    return (
        left.join(mixed, "key").select("key", F.lit(ANY).alias("part"), "id", "label")
        .union(own.select(hub, F.lit(0), "id", "label")).union(others.select(hub, F.lit(1), "id", "label"))
    )


def candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a cell: its rows on both sides, which of their pairs are candidates, and the labels of all rows."""
    side, label, n = (table.column(c).to_numpy() for c in ("side", "label", "n"))
    registers = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, BUCKETS)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not (side == 1).any() and table.column("a")[0] == table.column("b")[0]
    right = left if alone else right
    agree = np.zeros((len(left), len(right)), np.uint8)
    for x, y in zip(registers[left].T.copy(), registers[right].T.copy(), strict=True):
        agree += x[:, None] == y
    enough = np.clip((np.arange(BUCKETS + 1) / BUCKETS - COLLISION) / (1 - COLLISION), 0, 1) >= PERCENT / 100 - MARGIN
    x, y = n[left][:, None], n[right]
    near = enough[agree] & (label[left][:, None] != label[right]) & (np.minimum(x, y) * 100 >= np.maximum(x, y) * PERCENT)
    return left, right, np.triu(near) if alone else near, label


def promising(table: pa.Table) -> pa.Table:
    """The rows of a cell that have a candidate in it."""
    left, right, near, _ = candidates(table)
    rows = np.union1d(left[near.any(axis=1)], right[near.any(axis=0)])
    return table.take(pa.array(rows)).select(["key", "a", "b", "side", "id", "label", "n", "sketch"])


def cell_links(table: pa.Table) -> pa.Table:
    """Links (a, b) that join the labels of a cell as all its links would: candidates are verified unless earlier links join them."""
    left, right, near, label = candidates(table)
    ids = table.column("id").to_numpy()
    sets = shingle_sets(table.column("text").combine_chunks())
    size = np.array([len(s) for s in sets])
    distinct, place = np.unique(np.concatenate(sets), return_inverse=True)
    places = np.split(place, np.cumsum(size)[:-1])
    marked = np.zeros(len(distinct), bool)
    label, found = label.copy(), []
    for i, x in enumerate(left):
        some = right[near[i]]
        if not len(some):
            continue
        marked[places[x]] = True
        for y in some:
            if label[x] != label[y]:
                both = int(np.count_nonzero(marked[places[y]]))
                if 100 * both >= PERCENT * int(size[x] + size[y] - both):
                    label[label == label[y]] = label[x]
                    found.append(sorted((int(ids[x]), int(ids[y]))))
        marked[places[x]] = False
    return pa.table({k: pa.array([f[i] for f in found], pa.int64()) for i, k in enumerate(("a", "b"))})


def links_of_large_buckets(open_: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join the labels of the open buckets (key, id, label) as all links inside them would.

    Members meet cell by cell on their sketches; those with a candidate meet
    again with their texts. Pairs stay inside the tasks: a cell returns fewer
    links than it has rows.
    """
    cell = ["key", "a", "b"]
    dealt = cells_of(groups_of(open_), reps.select("id", "n")).join(reps.select("id", "sketch"), "id")
    schema = "key bigint, a bigint, b bigint, side int, id bigint, label bigint, n bigint, sketch binary"
    kept = checkpointed(dealt.groupBy(*cell).applyInArrow(promising, schema))
    named = checkpointed(kept.join(reps.select("id", "doc", "th"), "id"))
    texts = texts_for(named, ["doc"], texts)
    found = named.join(texts.toDF("doc", "th", "text"), ["doc", "th"]).groupBy(*cell).applyInArrow(cell_links, "a bigint, b bigint")
    return checkpointed(found.distinct())


def near_duplicates(
    docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Groups of documents linked by a shingle similarity of 0.75 or more.

    Shingles are the distinct windows of five words, A-Z in lower case; of fewer
    words the whole sequence. Documents with equal sets count as one. Others are
    candidates if their sketches agree in a band. In every bucket of a band all
    members are first compared with one of them; candidates pass the size
    bound and the sketch estimate, then their full sets decide. Buckets whose
    members are still in several components follow with all pairs across
    components: small ones by a join, large ones block by block inside tasks. So
    every candidate that no other links join is decided by its sets. The work of
    a large bucket of many components grows with the square of its members, its
    rows with the members times the blocks of BLOCK members.

    A pair at exactly 0.75 shares no band with a chance of 5 in a million.

    Returns ``keep`` (all columns by default), ``n_shingles``, ``component_id``
    and ``kept``. Null and empty texts have no shingles and are linked with
    nothing. Rows that share an id are one document, which all its different texts
    link; ``n_shingles`` is that of the largest. Rows without an id keep null
    results. Columns named like a result are replaced.
    """
    own = ("n_shingles", "component_id", "kept")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    signed = checkpointed(with_measures(narrow, "text", ["id", "th"], OWN, measure))
    sets = signed.where("n > 0 and id is not null")
    first = sets.groupBy("f1", "f2").agg(F.min("id").alias("id"))
    same = sets.join(first, ["f1", "f2", "id"]).groupBy("f1", "f2").agg(
        F.first("id").alias("doc"), F.first("th").alias("th"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands"), F.count("*").alias("rows"),
    )
    # ids may repeat with different texts, so every distinct set gets a number of its own, fixed by the checkpoint
    reps = checkpointed(same.withColumn("id", F.monotonically_increasing_id()))
    size = reps.agg(F.count("*").alias("sets"), F.max("rows").alias("rows")).first()
    texts = narrow.dropDuplicates(["id", "th"]) if (size["rows"] or 0) > 1 else narrow
    groups = reps.select("f1", "f2", "id", "doc")
    rows = reps.select("id", F.explode("bands").alias("key"))
    centres = checkpointed(rows.groupBy("key").agg(F.min("id").alias("c"), F.count("*").alias("members")).where("members > 1"))
    hits = checkpointed(rows.join(centres, "key"))

    def linked(pairs: DataFrame) -> DataFrame:
        return checkpointed(verified(similar_by_sketch(pairs, reps.select("id", "n", "sketch")), reps, texts))

    tried = checkpointed(hits.where("id != c").select(F.col("c").alias("a"), F.col("id").alias("b")).distinct())
    links = linked(tried)
    several = sets.groupBy("id").agg(F.min(F.struct("f1", "f2")).alias("lo"), F.max(F.struct("f1", "f2")).alias("hi")).where("lo != hi").select("id")
    several = checkpointed(sets.join(several, "id").select(F.col("id").alias("owner"), "f1", "f2").distinct())
    if not several.isEmpty():
        # all texts of one id are in one component
        members = checkpointed(several.join(groups, ["f1", "f2"]).select("owner", F.col("id").alias("b")))
        least = members.groupBy("owner").agg(F.min("b").alias("a"), F.count("*").alias("texts"))
        own = join_back(members, least, ["owner"], ["a"], F.col("texts"), members.count(), F.col("b"))
        links = checkpointed(links.union(own.select("a", "b").where("a != b")))
    found = checkpointed(connected_components(links))
    labelled = hits.join(found, "id", "left").select("key", "id", "members", F.coalesce("component", "id").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    open_ = checkpointed(labelled.join(mixed, "key"))
    small, large = open_.where(F.col("members") <= SMALL_BUCKET), open_.where(F.col("members") > SMALL_BUCKET)
    other = small.select("key", F.col("id").alias("b"), F.col("label").alias("lb"))
    across = small.join(other, "key").where("id < b and label != lb").select(F.col("id").alias("a"), "b")
    more = linked(checkpointed(across.distinct().join(tried, ["a", "b"], "left_anti")))
    if not large.isEmpty():
        more = more.union(links_of_large_buckets(large.select("key", "id", "label"), reps, texts))
    # the further links join whole components, so only these meet again
    at = {side: found.select(F.col("id").alias(side), F.col("component").alias(f"c{side}")) for side in ("a", "b")}
    between = more.join(at["a"], "a", "left").join(at["b"], "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    between = checkpointed(between.distinct())
    if not between.isEmpty():
        joined = checkpointed(connected_components(between)).toDF("label", "joined")
        own = found.select("id", F.col("component").alias("label")).union(joined.select("label", "label")).distinct()
        found = checkpointed(own.join(joined, "label", "left").select("id", F.coalesce("joined", "label").alias("component")))
    labels = checkpointed(groups.join(found, "id", "left").select("f1", "f2", "doc", F.coalesce("component", "id").alias("label")))
    # an id of several texts can reach further than its first text's smallest id
    lowest = labels.groupBy("label").agg(F.min("doc").alias("component"), F.count("*").alias("members"))
    spread = F.struct("f1", "f2")
    component = checkpointed(join_back(labels, lowest, ["label"], ["component"], F.col("members"), size["sets"], spread).select("f1", "f2", "component"))
    of = (
        signed.join(component, ["f1", "f2"], "left")
        .where("id is not null").groupBy("id").agg(F.max("n").alias("n_shingles"), F.min(F.coalesce("component", "id")).alias("component_id"))
    )
    if set(keep) == {id_col}:
        per_row = docs.select(F.col(id_col).alias("__id"))
    else:
        per_row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(id_col).alias("__id"))
    joined = per_row.join(of, F.col("__id") == F.col("id"), "left")
    kept = [F.col("__id").alias(id_col)] if set(keep) == {id_col} else [F.col(f"row.`{c}`").alias(c) for c in keep]
    return joined.select(*kept, "n_shingles", "component_id", (F.col("__id") == F.col("component_id")).alias("kept"))
