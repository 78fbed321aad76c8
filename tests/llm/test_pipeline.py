from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_minhash import brute as groups_of
from test_mixing import WORD, targets
from tokenizers import Tokenizer

from plumbline.llm.lines import dedup_lines
from plumbline.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_documents_on(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frames, docs = [], documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == documents.columns and docs.count() > 0, name
        frames.append({(r.doc_id, r.text) for r in docs.collect()})
    ids = [{i for i, _ in f} for f in frames]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3]
    assert len(ids[0]) >= 0.97 * documents.count()  # language keeps clean documents
    assert len(frames[2]) == len(ids[2]) and frames[2] <= frames[1]
    whole = {r.doc_id: r.n_lines for r in dedup_lines(documents).where("n_removed < n_lines").collect()}
    assert ids[1] <= set(whole) | ids[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == ids[3]
    assert sum(r.piece == 0 for r in packed) == docs.count()
    used = len({r.sequence_id for r in packed})
    assert used <= 1.02 * sum(r.length for r in packed) / 1024 + 2


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def small_corpus():
    """Two invented languages, one source with a third of the rows, copies, near copies, repeated lines, odd rows."""
    rng = random.Random(12)
    words = {k: ["".join(rng.choice(a) for _ in range(rng.randint(3, 8))) for _ in range(150)] for k, a in (("xx", "abcdef"), ("yy", "uvwxyz"))}
    line = lambda lang, n=14: " ".join(rng.choice(words[lang]) for _ in range(n))
    shared = {k: line(k, 12) for k in words}
    docs = []
    for i in range(60):
        lang = "xx" if i % 2 else "yy"
        lines = [line(lang) for _ in range(rng.randint(2, 6))]
        lines += [shared[lang]] * (i % 3) + ["short"] * (i % 2)
        docs.append([i, "\n".join(lines), lang, "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), 0])
    for i in range(60, 70):
        text = docs[i - 60][1]
        docs.append([i, text if i % 2 else text.replace("\n", " \n") + "\nmore", docs[i - 60][2], "a", 0])
    docs += [[80, None, "xx", "a", 0], [81, "", "yy", "b", 0], [82, "12 34", "xx", "a", 0], docs[5]]
    return [(i, t, la, so, len(t or "")) for i, t, la, so, _ in docs]


def lines_left(docs):
    """Texts without lines of 12 characters or more that stand earlier; documents of which nothing is left go."""
    spots = sorted((i, no, t, p.strip(" \t\r")) for i, t in {(d[0], d[1]) for d in docs if d[1] is not None} for no, p in enumerate(t.split("\n")))
    seen, gone = set(), set()
    for i, no, t, p in spots:
        if len(p) >= 12:
            if p in seen:
                gone.add((i, no, t))
            seen.add(p)
    out = []
    for d in docs:
        if d[1] is None:
            out.append(d)
            continue
        parts = d[1].split("\n")
        left = [p for no, p in enumerate(parts) if (d[0], no, d[1]) not in gone]
        if left:
            text = "\n".join(left)
            out.append((d[0], text, d[2], d[3], len(text)))
    return out


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_every_stage_equals_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = small_corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    kept = stages["language"](spark, docs, folder).cache()
    # what has no letter goes, clean documents of a learned language stay
    assert rows_of(kept) == sorted((r for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=str)

    cut = stages["lines"](spark, kept, folder).cache()
    assert cut.columns == columns and rows_of(cut) == sorted(lines_left([tuple(r) for r in kept.collect()]), key=str)

    single = stages["near_duplicates"](spark, cut, folder).cache()
    component = groups_of([(r.doc_id, r.text) for r in cut.collect()])
    assert rows_of(single) == sorted((tuple(r) for r in cut.collect() if component[r.doc_id][1] == r.doc_id), key=str)

    mixed = stages["mix"](spark, single, folder).cache()
    size = lambda t: len(WORD.findall(t or ""))
    source_sizes, taken = defaultdict(int), defaultdict(int)
    copies = Counter(tuple(r) for r in mixed.collect())
    before = Counter(tuple(r) for r in single.collect())
    assert set(copies) <= set(before) and all(n <= 2 * before[r] for r, n in copies.items())
    for r in before.elements():
        source_sizes[r[3]] += size(r[1])
    for r, n in copies.items():
        taken[r[3]] += n * size(r[1])
    for s, want in targets(source_sizes).items():
        assert abs(taken[s] - want) <= 2 * max(size(r[1]) for r in before if r[3] == s)

    packed = stages["pack"](spark, mixed, folder).cache()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r, n in copies.items():
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        assert len(ids) <= 1024
        want[(r[0], 0, 0, len(ids), zlib.crc32(ids.tobytes()))] += n
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 1024

    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == want


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_no_documents(spark, name):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, FOLDER).collect() == []
