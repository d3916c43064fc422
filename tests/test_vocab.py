"""Vocabulary: pair counts, merges, whole-text training, encode/decode, production
training against hand-worked merges, specials, save/load."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weft.functions import merging
from weft.functions import tokens as tk
from weft.operators import training
from weft.operators import vocab as V


def python_presplit(text):
    return regex.findall(tk.PRESPLIT_PATTERN.replace("(?U)", ""), text)


def _ids_df(spark, seqs):
    return spark.createDataFrame([(s,) for s in seqs], "ids ARRAY<INT>")


def _pairs(spark, seqs):
    return {(r["left"], r["right"]): r["count"] for r in V.pair_counts(_ids_df(spark, seqs)).collect()}


def test_pair_counts_hand_values(spark):
    assert _pairs(spark, [[1, 2, 3, 1, 2]]) == {(1, 2): 2, (2, 3): 1, (3, 1): 1}
    assert _pairs(spark, [[1, 2], [1, 2], [3, 4]]) == {(1, 2): 2, (3, 4): 1}
    assert _pairs(spark, [[1]]) == {}
    assert _pairs(spark, [[]]) == {}
    assert _pairs(spark, [[1, 1, 1]]) == {(1, 1): 2}  # overlaps counted


@pytest.mark.parametrize("seq,pair,expected", [
    ([1, 2, 3, 1, 2], (1, 2), [99, 3, 99]),
    ([1, 1, 1], (1, 1), [99, 1]),
    ([1, 2, 1, 2], (1, 2), [99, 99]),
    ([1], (1, 2), [1]),
    ([], (1, 2), []),
])
def test_merge_left_to_right(spark, seq, pair, expected):
    out = _ids_df(spark, [seq]).select(V.merge_pair(F.col("ids"), pair[0], pair[1], 99).alias("m")).first()["m"]
    assert out == expected


# merges worked out by hand: most frequent pair, the one seen first among equals
@pytest.mark.parametrize("texts,size,merges", [
    (["abab", "ab"], 257, [(97, 98)]),
    (["aabb"], 258, [(97, 97), (256, 98)]),
    (["abc"], 258, [(97, 98), (256, 99)]),
    (["hello world", "hold the wall", "a"], 262,
     [(104, 101), (108, 108), (32, 119), (108, 100), (256, 257), (260, 111)]),
    (["x"], 260, []),
])
def test_train_teaching_hand_values(spark, texts, size, merges):
    df = spark.createDataFrame(list(enumerate(texts)), "o INT, text STRING")
    assert list(V.train_teaching(df, "text", "o", size, rewrite=2).merges) == merges


def test_train_teaching_with_a_thousand_ties(spark):
    # every pair occurs once: 1,000 ties, the first pair of the first text wins
    text = "".join(chr(0x4E00 + i) for i in range(334))
    df = spark.createDataFrame([(0, text)], "o INT, text STRING")
    first = text.encode()[:2]
    assert V.train_teaching(df, "text", "o", 257).merges == ((first[0], first[1]),)


def test_teaching_encode_decode_round_trip(spark):
    texts = ["hello hello world", "你好，世界", "mixed 中文 and English!", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "o INT, text STRING")
    vocab = V.train_teaching(df, "text", "o", 262)
    out = df.select("text", V.teaching_encode(F.col("text"), vocab).alias("ids"))
    out = out.select("text", "ids", V.teaching_decode(F.col("ids"), vocab).alias("back")).collect()
    for r in out:
        assert r["back"] == r["text"]
    assert len(out[0]["ids"]) < len("hello hello world".encode())


def test_invalid_utf8_decodes_to_null(spark):
    df = spark.createDataFrame([([0xE4, 0xB8],)], "ids ARRAY<INT>")
    assert df.select(V.teaching_decode(F.col("ids"), V.TEACHING_VOCAB).alias("t")).first()["t"] is None


# words of "ab ab abc": "ab", " ab", " abc"; then ties go to the smaller ids
PRODUCTION = [
    (["ab ab abc"], 10, [(97, 98), (32, 256), (257, 99)]),
    (["xy", "ab"], 10, [(97, 98), (120, 121)]),
    (["<|im_start|>zz zz<|im_end|>zz"], 1, [(122, 122)]),
]


@pytest.mark.parametrize("texts,rounds,merges", PRODUCTION)
@pytest.mark.parametrize("sizes", [{}, {"batch": 1, "rewrite": 1}, {"tracked": 2}])
def test_production_training_hand_values(spark, texts, rounds, merges, sizes):
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    vocab = V.train_production(df, "text", 24 + 256 + rounds, **sizes)
    assert list(vocab.merges) == merges


def _plain_merge(seq, pair, new):
    out = []
    for x in seq:
        if out and (out[-1], x) == pair and out[-1] is not None:
            out[-1] = new
            out.append(None)  # a merged token takes no part in the next pair of this pass
        else:
            out.append(x)
    return [x for x in out if x is not None]


def _one_at_a_time(words, n, place):
    """Merges over (tokens, weight) words; ties go to the pair of smallest ``place``."""
    words, merges = [(list(w), c) for w, c in words], []
    for r in range(n):
        count, first = Counter(), {}
        for w, (seq, c) in enumerate(words):
            for i, p in enumerate(zip(seq, seq[1:])):
                count[p] += c
                first.setdefault(p, (w, i))
        if not count:
            break
        best = min(count, key=lambda p: (-count[p], place(p) if place else first[p]))
        merges.append(best)
        words = [(_plain_merge(s, best, 256 + r), c) for s, c in words]
    return merges


def _corpus(seed, n=60):
    r = random.Random(seed)
    stems = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 7))) for _ in range(80)]
    texts = [" ".join(r.choice(stems) + r.choice(["", "ing", "ed", "s", "'s", "!!", " 42"]) for _ in range(r.randint(5, 40))) for _ in range(n)]
    return texts + ["数据工程" * 7, "aaaaaaaaab aaaa aaa", "<|pad|>x<|im_end|>", "", None]


def _symbol_rank(code):
    """Place of a token in id order: byte-level symbols by code point, then merges."""
    if code >= 256:
        return code
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return plain.index(code) if code in plain else len(plain) + [b for b in range(256) if b not in plain].index(code)


@pytest.mark.parametrize("sizes", [{}, {"tracked": 40, "batch": 7, "rewrite": 25}])
def test_batched_training_equals_one_at_a_time(spark, sizes):
    texts = _corpus(1)
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    words = Counter(w for t in texts if t for p in re.split(r"<\|pad\|>|<\|im_end\|>", t) for w in python_presplit(p))
    want = _one_at_a_time([(w.encode(), c) for w, c in words.items()], 300, lambda p: tuple(map(_symbol_rank, p)))
    assert list(V.train_production(df, "text", 24 + 256 + 300, **sizes).merges) == want and len(want) == 300


@pytest.mark.parametrize("sizes", [{}, {"tracked": 20, "batch": 5, "rewrite": 8}])
def test_whole_text_training_equals_one_at_a_time(spark, sizes):
    texts = _corpus(2, 12)
    df = spark.createDataFrame(list(enumerate(texts)), "o INT, text STRING").repartition(3)
    want = _one_at_a_time([((t or "").encode(), 1) for t in texts], 40, None)
    assert list(V.train_teaching(df, "text", "o", 256 + 40, **sizes).merges) == want


def test_training_needs_few_rounds_and_ends_when_no_pair_is_left(spark):
    df = spark.createDataFrame([(t,) for t in _corpus(3)], "text STRING")
    rows = training.text_rows(V.word_histogram(df, "text").select(F.lit(0).cast("long").alias("o"), F.col("count").alias("n"), F.col("word").alias("text")))
    trainer = training.Trainer(rows, False)
    assert len(trainer.learn(200)) == 200 and trainer.rounds < 60
    tiny = spark.createDataFrame([("ab ab",)], "text STRING")
    assert V.train_production(tiny, "text", 6400).merges == ((97, 98), (32, 256))
    assert V.train_production(tiny.limit(0), "text", 6400).merges == ()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", max_size=12), max_size=6), st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=5, unique=True))
def test_merging_flat_arrays_equals_merging_in_learned_order(words, picks):
    codes = [97, 98, 99]
    pairs = []
    for i, j in picks:  # only pairs of codes that exist by then
        pairs.append((codes[i % len(codes)], codes[j % len(codes)]))
        codes.append(256 + len(pairs) - 1)
    pairs = list(dict.fromkeys(pairs))
    if any(max(p) >= 256 + r for r, p in enumerate(pairs)):
        return
    flat = np.frombuffer("".join(words).encode(), np.uint8)
    got, lengths = merging.merge_words(flat, np.array([len(w) for w in words], np.int64), merging.MergeTable(pairs))
    want = []
    for w in words:
        seq = list(w.encode())
        for r, p in enumerate(pairs):
            seq = _plain_merge(seq, p, 256 + r)
        want.append(seq)
    assert got.tolist() == sum(want, []) and lengths.tolist() == [len(x) for x in want]


def test_nul_and_control_characters_survive_the_special_cut(spark):
    texts = ["a\0b", "\0", "\0\x01a\x01b\0<|im_end|>\0", "\x01<|pad|>\x01a", "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k INT, t STRING")
    got = [r["p"] for r in df.orderBy("k").select(V.special_pieces(F.col("t")).alias("p")).collect()]
    assert got == [["a\0b"], ["\0"], ["\0\x01a\x01b\0", "<|im_end|>", "\0"], ["\x01", "<|pad|>", "\x01a"], ["plain"]]
    n = [r["n"] for r in df.orderBy("k").select(F.size(V.ids_of(V.encode_inline(F.col("t"), V.BYTE_VOCAB), V.BYTE_VOCAB)).alias("n")).collect()]
    assert n == [3, 1, 8, 4, 5]


def test_codes_of_a_large_vocabulary_stay_apart(spark):
    vocab = V.Vocab(merges=tuple((97, 98) for _ in range(70_000)))
    pairs, codes = vocab.merge_strings()
    assert len(codes) == 70_000 * tk.TOKEN_WIDTH and len(set(codes.split())) == 70_000
    assert not set(codes.split()) & {tk.code_hex(tk.SPECIAL_BASE + i).strip() for i in range(24)}
    last = 24 + 256 + 69_999
    df = spark.createDataFrame([([0, 24, 24 + 256, last],)], "ids ARRAY<INT>")
    back = df.select(V.ids_of(V.ids_to_codes(F.transform("ids", lambda i: V.id_to_code(i, vocab))), vocab).alias("i")).first()["i"]
    assert back == [0, 24, 24 + 256, last]
    with pytest.raises(ValueError):
        V.Vocab(merges=tuple((97, 98) for _ in range(tk.MAX_MERGES + 1)))


def test_presplit_matches_python_regex(spark):
    samples = ["Hello world", "a  b   c\n\n d", "it's 12 o'clock!!", "数据 和 text", "tail   "]
    df = spark.createDataFrame([(s,) for s in samples], "t STRING")
    got = [r["w"] for r in df.select(V.presplit_words(F.col("t")).alias("w")).collect()]
    assert got == [python_presplit(s) for s in samples]


def test_specials_are_single_tokens_and_tokens_fewer_than_chars(spark):
    corpus = ["数据工程很有意思。" * 5, "token tokens tokenizer " * 5]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "k INT, text STRING")
    vocab = V.train_production(df, "text", 24 + 256 + 20)
    probe = spark.createDataFrame([(0, "数据工程<|im_end|>很有<|pad|>意思")], "k INT, text STRING")
    enc = V.encode_corpus(probe, "text", vocab, "codes")
    ids = enc.select(V.ids_of(F.col("codes"), vocab).alias("ids")).first()["ids"]
    assert ids.count(1) == 1 and ids.count(2) == 1
    assert len(ids) < len("数据工程<|im_end|>很有<|pad|>意思")
    back = enc.select(V.decode_ids(V.ids_of(F.col("codes"), vocab), vocab, False).alias("t")).first()["t"]
    assert back == "数据工程<|im_end|>很有<|pad|>意思"
    skipped = enc.select(V.decode_ids(V.ids_of(F.col("codes"), vocab), vocab, True).alias("t")).first()["t"]
    assert skipped == "数据工程很有意思"


def test_vocab_save_load_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("aaa bbb aaa bbb ab ab",)], "text STRING")
    vocab = V.train_production(df, "text", 24 + 256 + 4)
    V.save_vocab(spark, vocab, str(tmp_path / "v"))
    assert V.load_vocab(spark, str(tmp_path / "v")) == vocab
    assert V.load_vocab(spark, str(tmp_path / "v" / "merges")) == vocab
    table = V.vocab_table(spark, vocab)
    assert table.count() == vocab.size
    assert table.where("id = 0").first()["token"] == "<|im_start|>"


def test_truncation_and_wrapping(spark):
    df = spark.createDataFrame([("abcdef",), (None,)], "text STRING")
    codes = V.encode_inline(F.col("text"), V.BYTE_VOCAB)
    r = df.select(tk.n_tokens(V.truncate_if(codes, 3)).alias("a"), tk.n_tokens(V.truncate_if(codes, 3, False)).alias("b"),
                  V.wrap_bos_eos(V.ids_of(codes, V.BYTE_VOCAB), F.col("text"), V.BYTE_VOCAB, True).alias("w")).collect()
    assert (r[0]["a"], r[0]["b"]) == (3, 6)
    assert r[0]["w"][0] == 0 and r[0]["w"][-1] == 1 and len(r[0]["w"]) == 8
    assert r[1]["w"] == []


def test_tokenizing_keeps_rows_of_equal_and_null_keys(spark):
    vocab = V.Vocab(merges=((97, 98), (32, 256), (256, 99)))
    rows = [(1, "ab ab"), (1, "abc"), (None, " ab"), (None, "abc<|pad|>ab"), (2, None), (2, ""), (1, "ab ab")]
    df = spark.createDataFrame(rows, "k INT, text STRING")
    got = V.encode_corpus(df, "text", vocab).collect()
    m = [tk.code_hex(256 + i) for i in range(3)]
    want = {"ab ab": m[0] + m[1], "abc": m[2], " ab": m[1], "abc<|pad|>ab": m[2] + tk.code_hex(tk.SPECIAL_BASE + 2) + m[0], None: "", "": ""}
    assert sorted(((r["k"], r["text"], r["codes"]) for r in got), key=str) == sorted(((k, t, want[t]) for k, t in rows), key=str)


def test_merging_a_word_equals_replacing_in_learned_order(spark):
    vocab = V.train_production(spark.createDataFrame([("banana bandana anna nab ban ana",)], "text STRING"), "text", 24 + 256 + 12)
    df = spark.createDataFrame([(w,) for w in "banana bandana anna nabanna xyz aaaa".split()], "w STRING")
    got = V.encode_corpus(df, "w", vocab).withColumn("other", V.apply_merges(tk.utf8_codes(F.col("w")), vocab)).collect()
    assert all(r["codes"] == r["other"] for r in got)


def test_tokenizer_file_gives_the_ids_of_the_common_library(spark, tmp_path):
    from tokenizers import Tokenizer
    texts = [t for t in _corpus(4) if t is not None] + ["naïve 東京 🙂\n\n  x\ty  ", "<|im_start|>user\nhi<|im_end|>", "it's they'll 42", "\0\x01a"]
    df = spark.createDataFrame(list(enumerate(texts)), "k INT, text STRING").repartition(3)
    vocab = V.train_production(df, "text", 24 + 256 + 150)
    library = Tokenizer.from_str(V.tokenizer_json(vocab))
    got = {r["k"]: r["ids"] for r in V.encode_ids(df, "text", vocab).collect()}
    assert [got[k] for k in range(len(texts))] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert library.decode(got[len(texts) - 4]) == texts[-4]
    V.save_tokenizer_file(spark, vocab, str(tmp_path / "t"))
    assert V.load_tokenizer_file(spark, str(tmp_path / "t")) == vocab
    library.save(str(tmp_path / "tokenizer.json"), pretty=True)
    assert V.load_tokenizer_file(spark, str(tmp_path / "tokenizer.json")) == vocab
    with pytest.raises(ValueError):
        V.vocab_of_json(V.tokenizer_json(vocab).replace('"ByteLevel"', '"Whitespace"'))


def test_ids_equal_codes_and_byte_vocabulary(spark):
    rows = [(0, "ab ab<|pad|>abc"), (1, None), (2, ""), (3, "<|im_end|>"), (4, "äb " * 50)]
    df = spark.createDataFrame(rows, "k INT, text STRING")
    for vocab in (V.BYTE_VOCAB, V.Vocab(merges=((97, 98), (32, 256), (256, 99)))):
        both = V.encode_ids(V.encode_corpus(df, "text", vocab), "text", vocab)
        assert all(r["ids"] == r["other"] for r in both.withColumn("other", V.ids_of(F.col("codes"), vocab)).collect())
        assert all(r["back"] == (r["text"] or "") for r in both.withColumn("back", V.decode_ids(F.col("ids"), vocab, False)).collect())


def test_code_on_workers_from_another_folder(tmp_path):
    """Python workers find the package wherever the driver was started."""
    import subprocess
    import sys
    root = __file__.rsplit("/tests/", 1)[0]
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from weft.session import local_session\n"
            "from weft.operators import vocab as V\n"
            "s = local_session(cores=2)\n"
            "df = s.createDataFrame([('ab ab',)], 'text STRING')\n"
            "print(V.encode_ids(df, 'text', V.Vocab(merges=((97, 98),))).first()['ids'])\n")
    out = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("[280, 244, 280]"), out.stderr[-2000:]


def test_training_learns_many_merges_a_round(spark):
    """The changes of dropped merges tell the next round which new pairs come up."""
    rng = random.Random(5)
    parts = ["".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(60)]
    words = [("".join(rng.choice(parts[:1 + int(60 * rng.random() ** 2)]) for _ in range(3)), rng.randint(1, 99)) for _ in range(2000)]
    rows = training.text_rows(spark.createDataFrame([(0, n, w) for w, n in words], "o LONG, n LONG, text STRING"))
    trainer = training.Trainer(rows, False)
    assert len(trainer.learn(400)) == 400
    one_by_one = training.Trainer(rows, False, batch=1)
    assert one_by_one.learn(40) == trainer.merges[:40]
    assert trainer.rounds <= 20


def test_python_workers_handle_a_batch_in_bounded_slices(spark, monkeypatch):
    """Rows come back in order, no slice longer than the limit unless it is one row."""
    monkeypatch.setattr(V, "SLICE", 64)
    texts = pa.array(["ab cd abab " * (i % 5) for i in range(40)] + ["x" * 300, None, ""])
    vocab = V.Vocab(((97, 98), (99, 100)), specials=())
    teaching = V.Vocab(((97, 98), (99, 100)), "teaching", (), False)
    whole = [None if t is None else "".join(t).replace("ab", "Ā").replace("cd", "ā") for t in texts.to_pylist()]
    ids = list(V._ids_udf(teaching).func(iter([texts.cast(pa.binary())])))
    assert [x for a in ids for x in a.to_pylist()] == [None if t is None else list(map(ord, t)) for t in whole]
    back = list(V._bytes_udf(teaching, False, True).func(iter([pa.concat_arrays(ids)])))
    assert [x for a in back for x in a.to_pylist()] == [None if t is None else t.encode() for t in texts.to_pylist()]
    words = pa.array([None if t is None else t.split(" ") for t in texts.to_pylist()], pa.list_(pa.string()))
    coded = list(V._WordCache(vocab).encode(words))
    assert "".join(chr(c) for codes, _ in coded for c in codes) == "".join(t.replace(" ", "") for t in whole if t)
    assert sum(len(lengths) for _, lengths in coded) == len(texts)
    plain = list(V._WordCache(V.Vocab(specials=())).encode(words))
    assert "".join(chr(c) for codes, _ in plain for c in codes) == "".join(t.replace(" ", "") for t in texts.to_pylist() if t)
    for slices in ([len(a.flatten()) for a in ids if len(a) > 1], [len(c) for c, n in plain if len(n) > 1]):
        assert len(slices) > 5 and max(slices) <= 64


def test_workers_give_memory_back_after_each_batch(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(V.M, "release", lambda: calls.append(1))
    vocab = V.Vocab(((97, 98),))
    words = pa.array([["ab", "c"], ["ab"]], pa.list_(pa.string()))
    for make in (V._codes_udf, V._word_ids_udf):
        calls.clear()
        rows = [x for a in make(vocab).func(iter([words, words])) for x in a.to_pylist()]
        assert len(rows) == 4 and rows[:2] == rows[2:] and len(calls) == 2
