"""Operators that judge or write each row by itself: 1, 2, 4, 5, 6, 10."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weft.llm import decontam, langid, licenses, packing, perspectives, separators, subword
from weft.llm import textvec as tv

DOCS = "doc_id LONG, text STRING, lang STRING, score STRING, item_id STRING"


def _docs(spark, rows):
    """Rows (doc_id, text, lang) plus columns whose names clash with results."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS).repartition(2)


def _held(i, mod):
    return i is not None and zlib.crc32(str(i).encode()) % mod == 2


# --- 1 -----------------------------------------------------------------------------------

WORDS = {"aa": "der und nicht schön zwölf ungern Straße", "bb": "the and with thing other whole", "cc": "que para niño señal corazón los"}


def _sentences(lang, n, seed):
    r = np.random.default_rng(seed)
    return [" ".join(r.choice(WORDS[lang].split(), 12)) + "." for _ in range(n)]


def test_language_id_learns_decodes_and_keeps_rows(spark):
    rows = [(i * 3 + k, t, lang) for k, lang in enumerate(WORDS) for i, t in enumerate(_sentences(lang, 40, k))]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !!", "cc"), (903, "und nicht schön " * 20_000, None), (None, "the other thing", None),
           (904, "the whole thing", "und"), (1, rows[1][1], "bb"), (1, rows[1][1], "bb")]
    got = langid.language_id(_docs(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang in rows}
    for r in got:
        assert r["held_out"] == _held(r["doc_id"], 4) and 0 <= r["score"] <= 1
        if r["doc_id"] in truth:
            assert r["lang_pred"] == truth[r["doc_id"]] or r["doc_id"] == 1
    by = {r["doc_id"]: r for r in got if r["doc_id"] in (None, 900, 901, 902, 903, 904)}
    assert [by[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and by[900]["score"] == 0
    assert (by[903]["lang_pred"], by[None]["lang_pred"], by[904]["lang_pred"]) == ("aa", "bb", "bb")


def test_language_id_of_mixed_text_is_ambiguous_and_filtered(spark):
    rows = [(i * 3 + k, t, lang) for k, lang in enumerate(WORDS) for i, t in enumerate(_sentences(lang, 30, k))]
    model = langid.fit(_docs(spark, rows))
    mixed = _docs(spark, [(1, WORDS["aa"], None), (2, "!!", None), (3, None, None)])
    kept = langid.keep_known(mixed, model, ambiguous_below=0.5)
    assert kept.columns == mixed.columns and [r["doc_id"] for r in kept.collect()] == [1]
    best = np.array([[0.0] * model["code"].shape[1]])
    assert langid.decode(best, model)[2][0] == pytest.approx(1 / 3)  # no margin at all: all languages alike


def test_language_id_without_anything_to_learn(spark):
    none = langid.language_id(_docs(spark, [(1, "abc", None), (2, None, None)])).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert langid.language_id(_docs(spark, [(1, "abc", None)]).limit(0)).count() == 0
    one = langid.language_id(_docs(spark, [(i, "abc def", "zz") for i in range(9)])).collect()
    assert {r["lang_pred"] for r in one} == {"zz"}


@pytest.mark.parametrize("n", [2, 3, 5, 6, 9, 40])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    assert code.shape[0] == n and len({tuple(r) for r in code}) == n


# --- 2 -----------------------------------------------------------------------------------

def test_licences_match_brute_force(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    texts = ["plain words of no interest", None, "", "%%% ...", notice, "x " * 30_000 + notice.upper(), "CC BY, cc-by 4.0 and cc\nby!",
             "cc x by, gnu general public licence", "Licensed under the Apache License, Version 2.0. MIT LICENSE", "mit license mit license",
             "Licensed under CC BY-NC 4.0.", "apachelicense Épache license", "All rights reserved.", notice, notice]
    rows = licenses.scan(_docs(spark, [(i if i != 7 else None, t, None) for i, t in enumerate(texts)])).collect()
    assert len(rows) == len(texts)
    by = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(texts):
        r = by[i if i != 7 else None]
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at, labels = [], set()
        for p, label in licenses.BASE.items():
            p = p.split()
            hits = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            at += hits
            labels |= {label} if hits else set()
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert by[4]["labels"] == "gpl" and by[8]["labels"] == "apache,apache-2.0,mit" and by[10]["labels"] == "cc-by,cc-by-nc"
    assert by[12]["labels"] == "proprietary" and by[4]["score"] == pytest.approx(1)


def test_licences_of_several_notices_in_one_text(spark):
    groups = [("mit", "bsd"), ("gpl", "mit"), ("mit", "apache-2.0", "bsd", "mpl-2.0"), ("mit", "isc", "unlicense", "proprietary"), ("gpl", "mit", "bsd")]
    filler = " some prose about nothing at all, " * 200
    rows = [(i, filler.join(licenses.TEMPLATES[t][0] + "." for t in g), None) for i, g in enumerate(groups)]
    rows += [(100 + i, "plain prose of other things", None) for i in range(200)]
    got = {r["doc_id"]: r for r in licenses.scan(_docs(spark, rows)).collect()}
    for i, g in enumerate(groups):
        assert set(g) <= set(got[i]["labels"].split(",")) and got[i]["score"] == pytest.approx(1)


def test_licences_of_an_empty_table(spark):
    assert licenses.scan(_docs(spark, [(1, "x", None)]).limit(0)).count() == 0


# --- 4 and 10 ----------------------------------------------------------------------------

def _texts():
    r = np.random.default_rng(4)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    return [" ".join(r.choice(words, n)) for n in r.integers(1, 700, 30)] + [None, "", "same same", "same same", "Ünïcode 漢字 … " * 900, "z" * 30_000]


def test_packing_covers_every_id_once_and_pads_nothing(spark):
    texts = _texts()
    t = Tokenizer.from_file(subword.default_path())
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}
    rows = packing.pack(_docs(spark, [(i, x, None) for i, x in enumerate(texts)])).collect()
    cover, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r["doc_id"]]
        part = ids[r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        cover[r["doc_id"]].append((r["start"], r["length"]))
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in want.items():
        end = 0
        for a, n in sorted(cover[i]):
            assert a == end and n > 0
            end += n
        assert end == len(ids)
    for parts in seq.values():
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end & (end - 1) == 0 and end <= 2048


def test_packing_of_repeated_rows_null_ids_and_nothing(spark):
    docs = _docs(spark, [(7, "a b", None), (7, "a b", None), (None, None, None)])
    ids = defaultdict(int)
    for r in packing.pack(docs).collect():
        ids[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert ids == {(7, 3): 6, (None, 1): 1}
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_prefers_lexical_neighbours():
    a, b = list(range(10, 40)), list(range(50, 80))
    docs = [a * 10, b * 10, a * 9, b * 9, a * 8, b * 8]
    first = np.cumsum([0, *map(len, docs)])
    out = packing.pack_shard(np.concatenate(docs).astype(np.int32), first, window=512)
    assert {d % 2 for d, _, _ in out[0]} == {0}  # the first window holds documents of one kind


def test_token_counts_equal_the_tokenizers(spark):
    texts = _texts()
    t = Tokenizer.from_file(subword.default_path())
    rows = separators.token_counts(_docs(spark, [(i, x, None) for i, x in enumerate(texts)] + [(3, texts[3], None)])).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert r["n_tokens"] == len(t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids)
    assert separators.token_counts(_docs(spark, [(1, "x", None)]).limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_separators_across_blocks_match_a_plain_split(spark, tmp_path, block):
    r = np.random.default_rng(5)
    files = {"part-0": [5, 6, 1, 7, 1, 1, 8, 8, 8, 8, 8, 8, 8, 1], "part-1": [9, 9], "part-2": [], "part-3": [1, 1, 4],
             "part-4": r.choice([1, 2, 3], 200, p=[0.1, 0.45, 0.45]).tolist()}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes() + (b"\x01" if name == "part-3" else b""))
    found = defaultdict(list)
    for x in separators.documents(separators.blocks(spark, str(tmp_path), block=block)).collect():
        found[x["path"].rsplit("/", 1)[1]].append((x["document"], x["start"], x["n_tokens"], x["closed"]))
    for name, ids in files.items():
        want, start = [], 0
        for i, v in enumerate(ids):
            if v == 1:
                want.append((len(want), start, i - start, True))
                start = i + 1
        if start < len(ids):
            want.append((len(want), start, len(ids) - start, False))
        assert sorted(found[name]) == want, name


# --- 5 -----------------------------------------------------------------------------------

def _prose(r, n):
    return " ".join("".join(r.choice(list("abcdefghij"), r.integers(2, 7))) for _ in range(n))


def test_decontamination_finds_planted_items_only(spark):
    r = np.random.default_rng(6)
    items = [(i, _prose(r, 30)) for i in range(30)] + [(30, None), (31, ""), (32, "... !!"), (33, "which one is it? the small green one over there"),
                                                     (34, _prose(r, 200)), (5, "repeated id"), (None, _prose(r, 25))]
    bench = spark.createDataFrame([(*x, "q") for x in items], "item_id LONG, text STRING, words STRING")
    texts = {0: _prose(r, 300), 1: None, 2: "", 3: _prose(r, 400) + " " + items[4][1].upper().replace(" ", ",\n") + ". " + _prose(r, 300),
             4: items[34][1], 5: items[-1][1], 6: _prose(r, 20_000) + " " + items[9][1], 7: " ".join(items[3][1].split()[:9]),
             8: "Which one is it? The small green one over there!", 9: "which one is it, the large red one over there", 10: items[0][1]}
    rows = [(k, t, None) for k, t in texts.items()] + [(10, texts[10], None), (None, texts[10], None)]
    got = decontam.match(_docs(spark, rows), bench).collect()
    assert len(got) == len(rows)
    assert sorted((x["doc_id"] if x["doc_id"] is not None else -1) for x in got if x["contaminated"]) == [-1, 3, 4, 5, 6, 8, 10, 10]
    by = {x["doc_id"]: x for x in got}
    assert (by[3]["item_id"], by[4]["item_id"], by[6]["item_id"], by[10]["item_id"]) == (4, 34, 9, 0)
    kept = decontam.decontaminate(_docs(spark, rows), bench)
    assert len(kept.columns) == 5 and sorted(x["doc_id"] for x in kept.collect()) == [0, 1, 2, 7, 9]
    small = decontam.build(bench, shard_postings=200)  # several shards find the same
    assert len(small) > 1 and sum(len(s["items"]) for s in small) == sum(len(s["items"]) for s in decontam.build(bench))
    assert decontam.match(_docs(spark, rows), bench.limit(0)).where("contaminated").count() == 0
    assert decontam.match(_docs(spark, rows).limit(0), bench).count() == 0


def test_pruned_search_equals_scoring_every_passage(spark):
    r = np.random.default_rng(7)
    bench = spark.createDataFrame([(i, _prose(r, 20)) for i in range(60)], "item_id LONG, text STRING")
    ix = decontam.build(bench)[0]
    mix = " ".join(t["text"] if r.random() < 0.3 else _prose(r, 15) for t in bench.collect() * 3)
    data = np.frombuffer(mix.encode(), np.uint8)
    _, _, h, first = tv.words(data, np.array([0, len(data)]))
    found, count = decontam.search(h, first, ix, 0.4)
    want = []
    for p in range(int(count[0])):
        lo = p * decontam.PASSAGE // 2
        terms = np.unique(h[lo:lo + decontam.PASSAGE])
        score = np.zeros(ix["n_seg"])
        for t in terms:
            k = np.searchsorted(ix["term"], t)
            if k < len(ix["term"]) and ix["term"][k] == t:
                for j in range(ix["ptr"][k], ix["ptr"][k + 1]):
                    score[ix["seg"][j]] += ix["w"][j]
        want += [(lo, s) for s in np.flatnonzero(score >= 0.4 - 1e-12)]
    assert [(int(a), int(s)) for _, a, _, s in found] == want and want


def test_search_scores_many_passages_at_once(spark, monkeypatch):
    r = np.random.default_rng(3)
    bench = spark.createDataFrame([(i, _prose(r, 80)) for i in range(40)], "item_id LONG, text STRING")
    ix = decontam.build(bench)[0]
    text = " ".join(t["text"] for t in bench.collect() * 8).encode()
    _, _, h, first = tv.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    calls, take = [], decontam._take
    monkeypatch.setattr(decontam, "_take", lambda *a: calls.append(1) or take(*a))
    found, count = decontam.search(h, first, ix, 0.3)
    assert count[0] > 300 and len(calls) < count[0] // 8
    for postings in (1, 10 ** 5):
        monkeypatch.setattr(decontam, "POSTINGS", postings)
        assert found and [tuple(map(int, x)) for x in decontam.search(h, first, ix, 0.3)[0]] == [tuple(map(int, x)) for x in found]


# --- 6 -----------------------------------------------------------------------------------

def test_perspectives_rotate_and_mask(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob b", "yo"), (1, 3, "ann", None), (1, 3, "ann", None),
            (2, 0, "system", "alone"), (None, None, None, "x"), (None, 1, " ", "y"), (3, 5, "z", "late"), (3, None, "z", "early")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id LONG, turn LONG, role STRING, text STRING, segment STRING").repartition(3)
    seg = perspectives.rotate(df)
    got = {(r["conv_id"], r["participant"]): r for r in perspectives.whole(seg).collect()}
    assert set(got) == {(1, "ann"), (1, "bob_b"), (None, "unknown"), (3, "z")}
    ann = got[(1, "ann")]
    s, e = perspectives.START, perspectives.STOP
    assert ann["rendering"] == (f"{s}system\nBe kind.{e}\n{s}assistant\nhi <| im_end|>{e}\n{s}user name=bob_b\nyo{e}\n"
                                f"{s}assistant\n{e}\n{s}assistant\n{e}\n")
    assert [ann["rendering"][a:b] for a, b in ann["spans"]] == [f"hi <| im_end|>{e}", e, e]
    assert [got[(1, "bob_b")]["rendering"][a:b] for a, b in got[(1, "bob_b")]["spans"]] == [f"yo{e}"]
    assert got[(3, "z")]["rendering"].index("early") < got[(3, "z")]["rendering"].index("late")
    assert perspectives.rotate(df.limit(0)).count() == 0


def test_perspectives_of_a_hot_conversation(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1)).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("text"))
    hot = perspectives.rotate(df).where("conv_id = -1 and participant = 'a'").orderBy("turn_index").collect()
    assert [r["turn_index"] for r in hot] == list(range(2000))
    end = 0
    for r in hot:
        assert r["seg_start"] == end and r["seg_length"] == len(r["segment"])
        end += r["seg_length"]


def test_benchmark_ties_go_to_the_smaller_item_over_shards_and_long_items_are_no_crash(spark, monkeypatch):
    text = "which of the seven rivers runs north of the old town? answer: the green one beside the mill"
    items = spark.createDataFrame([(i, text) for i in range(3, 43)] + [(99, "w " + " ".join(f"x{i}" for i in range(3000)))], "item_id LONG, text STRING")
    docs = _docs(spark, [(1, text, "aa"), (2, "nothing of that kind here", "aa")])
    for size in (500_000, 200, 10):
        monkeypatch.setattr(decontam.shards_of, "__defaults__", (size,))
        got = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontam.match(docs, items).collect()}
        assert got == {1: (True, 3), 2: (False, None)}
