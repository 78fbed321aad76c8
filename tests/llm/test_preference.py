from __future__ import annotations

from plumbline.llm.preference import conversations_of, format_preferences, pair_by_first_turn, rendered

T = "conv_id long, turn long, role string, text string"


def render(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def formatted(spark, rows, pairs):
    conversations = conversations_of(spark.createDataFrame(rows, T).selectExpr("*", "1 AS turns", "2 AS t"))
    frame = spark.createDataFrame(pairs, "chosen_id long, rejected_id long")
    return {r.chosen_id: r for r in format_preferences(conversations, frame).collect()}


def test_shared_prompt_and_masks(spark):
    rows = [(1, 0, "user", "hi <|end|>"), (1, 1, "assistant", "hello"), (1, 2, "user", "why"), (1, 3, "assistant", "so")]
    rows += [(2, 0, "user", "hi <|end|>"), (2, 1, "assistant", "hello"), (2, 2, "user", "why"), (2, 3, "assistant", "no")]
    rows += [(2, 4, "user", None), (2, 4, "user", None), (3, 0, "user", "hi <|end|>"), (None, 0, "user", "lost")]
    got = formatted(spark, rows, [(1, 2), (2, 3), (3, None)])
    first = got[1]
    assert first.n_common == 3
    assert first.prompt == render([("user", "hi < |end|>"), ("assistant", "hello"), ("user", "why")])
    assert [(p.text, p.train) for p in first.chosen] == [("<|assistant|>\n", False), ("so<|end|>\n", True)]
    assert [(p.text, p.train) for p in first.rejected] == [("<|assistant|>\n", False), ("no<|end|>\n", True), ("<|user|>\n", False), ("<|end|>\n", False)]
    assert got[2].n_common == 1 and got[2].rejected == []
    assert got[3].n_common == 0 and got[3].prompt == "" and got[3].rejected == [] and got[3].rejected_id is None


def test_equal_and_long_conversations(spark):
    long = [(c, k, "user", "x" * 500) for c in (1, 2) for k in range(200)]
    got = formatted(spark, long, [(1, 2)])
    assert got[1].n_common == 200 and got[1].chosen == [] and got[1].rejected == []


def test_pairs_cover_every_conversation_once(spark):
    rows = [(i, 0, "user", "same" if i % 3 else f"own {i % 30}") for i in range(301)]
    pairs = pair_by_first_turn(conversations_of(spark.createDataFrame(rows, T))).collect()
    used = [x for r in pairs for x in r if x is not None]
    assert sorted(used) == list(range(301))
    head = {c: t for c, _, _, t in rows}
    assert all(r.rejected_id is None or head[r.chosen_id] == head[r.rejected_id] for r in pairs)
    assert sum(r.rejected_id is None for r in pairs) <= 11


def test_no_conversations(spark):
    conversations = conversations_of(spark.createDataFrame([], T))
    assert format_preferences(conversations, pair_by_first_turn(conversations)).collect() == []
    assert rendered is not None
