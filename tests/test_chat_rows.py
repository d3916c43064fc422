"""Rendering, augmentation and training-row builders."""

import random

import pytest
from pyspark.sql import functions as F

from weft.functions import tokens as tk
from weft.operators import chat, rows
from weft.operators import vocab as V
from weft.sources.readers import MESSAGE

BV = V.BYTE_VOCAB
S, E = tk.BOS, tk.EOS


def _msgs(spark, convs, tools=None):
    data = [(i, [dict(role=r, content=c, reasoning_content=None, tools=(tools if r == "system" else None), tool_calls=None)
                 for r, c in conv]) for i, conv in enumerate(convs)]
    return spark.createDataFrame(data, f"k INT, messages ARRAY<{MESSAGE}>")


def test_render_basic_and_generation_prompt(spark):
    df = _msgs(spark, [[("system", "sys"), ("user", "hi"), ("assistant", "yo")]])
    r = df.select(chat.render_messages(F.col("messages"), None, False, True).alias("p")).first()["p"]
    assert r == f"{S}system\nsys{E}\n{S}user\nhi{E}\n{S}assistant\nyo{E}\n{S}assistant\n"


def test_render_tools_appended_to_system_or_new_block(spark):
    tools = '[{"name": "a", "description": "x"}, {"name": "b", "description": "y"}]'
    df = _msgs(spark, [[("system", "sys"), ("user", "hi")]], tools)
    t = chat.normalise_tools(chat.last_system_tools(F.col("messages")))
    r = df.select(chat.render_messages(F.col("messages"), t).alias("p")).first()["p"]
    lines = '{"name": "a", "description": "x"}\n{"name": "b", "description": "y"}'
    assert r == f"{S}system\nsys\n{chat.TOOLS_INTRO}\n{lines}{E}\n{S}user\nhi{E}\n"
    df2 = _msgs(spark, [[("user", "hi")]])
    r2 = df2.select(chat.render_messages(F.col("messages"), F.lit(lines)).alias("p")).first()["p"]
    assert r2 == f"{S}system\n{chat.TOOLS_INTRO}\n{lines}{E}\n{S}user\nhi{E}\n"


def test_thinking_wraps_assistant_and_template_drops_roles(spark):
    df = _msgs(spark, [[("user", "q"), ("assistant", "a"), ("observer", "x")]])
    r = df.select(chat.render_messages(F.col("messages"), None, True).alias("p"),
                  chat.render_template(F.col("messages")).alias("t")).first()
    assert f"{tk.THINK_START}a{tk.THINK_END}" in r["p"] and "observer" in r["p"]
    assert "observer" not in r["t"]


def test_system_prompt_ratio_extremes(spark):
    df = _msgs(spark, [[("user", "q")] for _ in range(20)] + [[("system", "s"), ("user", "q")]])
    always = df.select(F.size(chat.add_system_prompt(F.col("messages"), F.col("k"), 1.0)).alias("n")).collect()
    never = df.select(F.size(chat.add_system_prompt(F.col("messages"), F.col("k"), 0.0)).alias("n")).collect()
    assert [r["n"] for r in always[:20]] == [2] * 20 and always[20]["n"] == 2  # existing system kept as is
    assert all(r["n"] in (1, 2) for r in never) and never[0]["n"] == 1
    with_tools = _msgs(spark, [[("system", "s"), ("user", "q")]], '[{"name": "a"}]')
    assert with_tools.select(F.size(chat.add_system_prompt(F.col("messages"), F.col("k"), 1.0))).first()[0] == 2


def test_empty_think_removal_extremes(spark):
    text = f"x{chat.EMPTY_THINK}y{chat.EMPTY_THINK}"
    df = spark.createDataFrame([(i, text) for i in range(10)], "k INT, p STRING")
    removed = df.select(chat.drop_empty_think(F.col("p"), F.col("k"), 0.0).alias("p")).collect()
    kept = df.select(chat.drop_empty_think(F.col("p"), F.col("k"), 1.0).alias("p")).collect()
    assert all(r["p"] == "xy" for r in removed) and all(r["p"] == text for r in kept)


def test_pretrain_rows_pad_and_labels(spark):
    df = spark.createDataFrame([(0, "hello"), (1, "x" * 100)], "k INT, text STRING")
    r = rows.pretrain_rows(df, ["k"], "text", BV, 32).orderBy("k").collect()
    ids, labels = r[0]["input_ids"], r[0]["labels"]
    assert len(ids) == 32 and ids[0] == BV.bos_id and ids[6] == BV.eos_id and ids[7] == BV.pad_id
    assert labels[:7] == ids[:7] and set(labels[7:]) == {-100}
    assert len(r[1]["input_ids"]) == 32 and r[1]["input_ids"][-1] == BV.eos_id


# spans open at 0 5 6 and close at 1 7; the masks were written by hand
MASKS = [
    ([], []),
    ([9, 9], [0, 0]),
    ([0, 5, 6], [0, 0, 0]),
    ([0, 5, 6, 9], [0, 0, 0, 1]),
    ([0, 5, 6, 1, 7], [0, 0, 0, 1, 1]),
    ([0, 5, 6, 9, 9, 1, 7, 9], [0, 0, 0, 1, 1, 1, 1, 0]),
    ([9, 0, 5, 6, 9, 1, 7, 0, 5, 6, 9, 1, 7], [0, 0, 0, 0, 1, 1, 1, 0, 0, 0, 1, 1, 1]),
    ([0, 5, 6, 9, 0, 5, 6, 1, 7], [0, 0, 0, 1, 1, 1, 1, 1, 1]),       # an opener inside a span is content
    ([0, 5, 6, 9, 1, 9, 7], [0, 0, 0, 1, 1, 1, 1]),                   # broken closer: the span runs to the end
    ([1, 7, 0, 5, 6, 9], [0, 0, 0, 0, 0, 1]),                         # a closer outside a span means nothing
    ([0, 5, 9, 0, 5, 6, 7, 1], [0, 0, 0, 0, 0, 0, 1, 1]),             # a broken opener opens nothing
    ([0, 5, 6, 1, 7, 1, 7], [0, 0, 0, 1, 1, 0, 0]),
    ([0, 0, 5, 6, 1, 1, 7], [0, 0, 0, 0, 1, 1, 1]),
]


def test_span_mask_hand_values(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(MASKS)], "k INT, ids ARRAY<INT>")
    bt, et = "".join(map(tk.code_hex, (0, 5, 6))), "".join(map(tk.code_hex, (1, 7)))
    codes = V.ids_to_codes(F.col("ids"))
    got = df.select("k", "ids", rows.loss_mask(codes, bt, et).alias("m"),
                    rows.label_mask(F.col("ids"), codes, bt, et).alias("l")).orderBy("k").collect()
    for r, (ids, mask) in zip(got, MASKS):
        assert r["m"] == mask, ids
        assert r["l"] == [x if m else -100 for x, m in zip(ids, mask)]


def test_span_masks_of_random_arrays_keep_their_invariants(spark):
    rnd = random.Random(7)
    arrays = [[rnd.choice([0, 5, 6, 1, 7, 9]) for _ in range(rnd.randint(0, 40))] for _ in range(400)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "k INT, ids ARRAY<INT>")
    bt, et = "".join(map(tk.code_hex, (0, 5, 6))), "".join(map(tk.code_hex, (1, 7)))
    got = df.select("k", rows.loss_mask(V.ids_to_codes(F.col("ids")), bt, et).alias("m")).orderBy("k").collect()
    for r, a in zip(got, arrays):
        m = r["m"]
        assert len(m) == len(a)
        edges = [i for i in range(len(a)) if m[i] and (i == 0 or not m[i - 1] or (a[i - 2:i] == [1, 7] and i - 2 >= 0 and m[i - 2]))]
        for i in edges:
            if not (i and m[i - 1]):
                assert a[i - 3:i] == [0, 5, 6]                # every run starts right behind an opener
        ends = [i for i in range(len(a)) if m[i] and (i + 1 == len(a) or not m[i + 1])]
        for i in ends:
            assert i + 1 == len(a) or a[i - 1:i + 1] == [1, 7]  # and stops at a closer or the end


def test_sft_rows_mask_assistant_only(spark):
    df = _msgs(spark, [[("user", "hi"), ("assistant", "yo"), ("user", "ok"), ("assistant", "go")]])
    r = rows.sft_rows(df, "k", "messages", BV, 64, add_system_ratio=0.0).first()
    kept = [x for x in r["labels"] if x != -100]
    text = bytes([x - 24 + 33 for x in kept if 24 + 0 <= x - 0 and x >= 24 and x - 24 < 94]).decode()
    assert "yo" in text and "go" in text and "hi" not in text
    assert sum(1 for x in kept if x == BV.eos_id) == 2


def test_preference_rows_shift_lengths(spark):
    pairs = spark.createDataFrame([(0, [dict(role="user", content="q"), dict(role="assistant", content="good")],
                                    [dict(role="user", content="q"), dict(role="assistant", content="bad")])],
                                  "pair_id INT, chosen ARRAY<STRUCT<role: STRING, content: STRING>>, "
                                  "rejected ARRAY<STRUCT<role: STRING, content: STRING>>")
    r = rows.preference_rows(pairs, "pair_id", "chosen", "rejected", BV, 64).first()
    for side in ("chosen", "rejected"):
        assert len(r[f"x_{side}"]) == len(r[f"y_{side}"]) == len(r[f"mask_{side}"]) == 63
    assert sum(r["mask_chosen"]) == len("good") + 2 and sum(r["mask_rejected"]) == len("bad") + 2


def test_rl_prompt_drops_last_message_and_adds_header(spark):
    df = _msgs(spark, [[("user", "q1"), ("assistant", "a1"), ("user", "q2")]])
    r = rows.rl_prompt_rows(df, "k", "messages", add_system_ratio=0.0, thinking_ratio=0.0).first()
    assert r["prompt"].endswith(f"{S}assistant\n") and "q2" not in r["prompt"] and r["answer"] == ""


@pytest.mark.parametrize("n,b,skip", [(10, 2, 0), (10, 2, 2), (10, 2, 5), (10, 3, 1), (10, 3, 4)])
def test_batches_and_resume(spark, n, b, skip):
    df = spark.range(n).withColumnRenamed("id", "i")
    got = rows.resume_batches(rows.batch_numbers(df, ["i"], b), skip).orderBy("i").collect()
    expected = [i for i in range(n) if i // b >= skip]
    assert [r["i"] for r in got] == expected
    length = spark.range(1).select(rows.resume_length(F.lit(n), b, skip).alias("l")).first()["l"]
    assert length == max(0, -(-n // b) - skip)


def test_schedule_and_steps(spark):
    r = spark.range(1).select(rows.learning_rate(F.lit(0), 100, 1.0).alias("a"), rows.learning_rate(F.lit(50), 100, 1.0).alias("b"),
                              rows.learning_rate(F.lit(100), 100, 1.0).alias("c"),
                              rows.optimizer_steps(F.lit(10), 4).alias("s"), rows.optimizer_steps(F.lit(8), 4).alias("t"),
                              rows.rescale_step(F.lit(1000), F.lit(4), F.lit(8)).alias("r")).first()
    assert r["a"] == pytest.approx(1.0) and r["b"] == pytest.approx(0.55) and r["c"] == pytest.approx(0.1)
    assert (r["s"], r["t"], r["r"]) == (3, 2, 500)


def test_empty_conversations_are_counted_not_trained_on(spark):
    df = spark.createDataFrame([(0, []), (1, None), (2, [dict(role="user", content="q", reasoning_content=None, tools=None, tool_calls=None)])],
                               f"k INT, messages ARRAY<{MESSAGE}>")
    assert [r["k"] for r in rows.sft_rows(df, "k", "messages", BV, 64).collect()] == [2]
    assert rows.rejected_conversations(df, "messages").first()["n_rejected"] == 2


def test_trained_anchors_may_be_swallowed_by_a_longer_merge(spark):
    # T5: with a merge of two line feeds the opener's own line feed is not a token any more
    msgs = _msgs(spark, [[("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "\n\na")]])
    vocab = V.Vocab(merges=((10, 10),))
    plain = rows.sft_rows(msgs, "k", "messages", BV, 64, add_system_ratio=0.0).orderBy("k").collect()
    merged = rows.sft_rows(msgs, "k", "messages", vocab, 64, add_system_ratio=0.0).orderBy("k").collect()
    n = [[sum(x != -100 for x in r["labels"]) for r in t] for t in (plain, merged)]
    assert n[0] == [3, 5] and n[1] == [3, 0]


def test_malformed_tools_count_as_none(spark):
    df = _msgs(spark, [[("system", "s"), ("user", "q")]], "[{broken")
    t = df.select(chat.normalise_tools(chat.last_system_tools(F.col("messages"))).alias("t")).first()["t"]
    assert t is None
