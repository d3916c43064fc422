"""Operators that gather from the whole table: 3, 7, 8, 9, and the pipeline."""

import itertools
import math
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weft.llm import attention, blocks, components, dedup, kneserney, langid, nndescent, subword
from weft.llm import textvec as tv
from weft.session import shared_path

DOCS = "doc_id LONG, text STRING, lang STRING, node STRING, block STRING"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS).repartition(3)


def _prose(r, n, letters="abcdefghij"):
    return " ".join("".join(r.choice(list(letters), r.integers(2, 7))) for _ in range(n))


# --- 3 -----------------------------------------------------------------------------------

def test_neighbours_reach_recall_and_settle_ties(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((1200, 24)).astype(np.float32)
    x[300:700] = x[300]                                             # a vector a third of the rows share
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2050, [0.0] * 24), (2100, [1.0, None] * 12), (2150, [float("nan")] * 24), (None, x[1].tolist()),
             (2200, [1.0, 2.0]), (2250, [float("inf")] + [1.0] * 23), (5, x[5].tolist()), (2300, [])]
    df = spark.createDataFrame([(*v, 1) for v in rows], "vec_id LONG, embedding ARRAY<FLOAT>, node INT").repartition(4)
    got = defaultdict(list)
    for v in nndescent.nearest(df).orderBy("query_id", "rank").collect():
        got[v["query_id"]].append((v["vec_id"], v["score"]))
    ids = np.arange(1200)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = 0
    assert set(got) == {i for i in ids if i % 50 == 0}
    for q, found in got.items():
        s = unit @ unit[q]
        s[300:700] = s[300]
        s[q] = -9
        want = np.lexsort((ids, -s))[:5]
        hit += len({v for v, _ in found} & set(want.tolist()))
        assert all(score == pytest.approx(1.0 if 300 <= v < 700 and 300 <= q < 700 else s[v], abs=1e-9) for v, score in found)
        if 300 <= q < 700:
            assert [v for v, _ in found] == [i for i in range(300, 306) if i != q][:5]
    assert hit / (5 * len(got)) >= 0.9


def test_neighbours_within_a_dense_group_are_ranked_exactly(spark):
    """Cosines that half precision cannot tell apart: all that may be among the nearest are ranked exactly."""
    r = np.random.default_rng(4)
    x = r.standard_normal(16) + 1e-3 * r.standard_normal((60, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = defaultdict(list)
    for v in nndescent.nearest(df, every=7).orderBy("query_id", "rank").collect():
        got[v["query_id"]].append(v["vec_id"])
    assert set(got) == set(range(0, 60, 7))
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        assert found == np.argsort(-s)[:5].tolist()


def test_neighbours_of_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id LONG, embedding ARRAY<FLOAT>")
    assert [(r["vec_id"], r["rank"]) for r in nndescent.nearest(df).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nndescent.nearest(df.limit(0)).count() == 0 and nndescent.nearest(df.limit(1)).count() == 0


# --- 7 -----------------------------------------------------------------------------------

def _kn(counts, order):
    """Interpolated modified Kneser-Ney by dictionaries: a function of a run of ``order`` bytes."""
    tables = {order: Counter(counts)}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts, contexts = {}, {}
    for k, t in tables.items():
        n = [sum(1 for c in t.values() if c == i) for i in (1, 2, 3, 4)]
        d = [0.0, 0.0, 0.0]
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.0]
        cuts[k] = [min(max(x, 0.1), i + 0.9) for i, x in enumerate(d)]
        contexts[k] = defaultdict(lambda: [0, 0.0])
        for g, c in t.items():
            contexts[k][g[:-1]][0] += c
            contexts[k][g[:-1]][1] += cuts[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k, c = len(g), tables[len(g)][g]
        if g[:-1] not in contexts[k]:
            return p(g[1:])
        total, cut = contexts[k][g[:-1]]
        return (c - cuts[k][min(c, 3) - 1] if c else 0) / total + cut / total * p(g[1:])
    return p


def test_kneserney_probabilities_match_dictionaries(spark):
    r = np.random.default_rng(2)
    texts, order = [_prose(r, 60, "abcd") for _ in range(6)] + [""], 3
    seqs = [bytes([1] * (order - 1)) + t.encode() + b"\x02" for t in texts]
    counts = Counter(s[i:i + order] for s in seqs for i in range(len(s) - order + 1))
    p = _kn(counts, order)
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    table = df.mapInArrow(kneserney._count(order), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    assert {x["gram"].to_bytes(order, "big"): x["n"] for x in table.collect()} == counts
    probe = [*list(counts)[:30], b"abz", b"zzz", b"\x01\x01q", b"dd\x02"]
    keys = spark.createDataFrame([(int.from_bytes(g, "big"),) for g in probe], "gram LONG")
    model = kneserney.levels(table, order, shared_path(spark, f"levels-{uuid.uuid4().hex}"))
    got = {x["gram"].to_bytes(order, "big"): x["logp"] for x in kneserney.probabilities(keys, model).collect()}
    for g in probe:
        assert got[g] == pytest.approx(math.log(p(g)))
    every = spark.createDataFrame([(int.from_bytes(b"ab" + bytes([c]), "big"),) for c in range(256)], "gram LONG")
    total = kneserney.probabilities(every, model).agg(F.sum(F.exp("logp"))).first()[0]
    assert total == pytest.approx(1.0)


def test_quality_rejects_noise_and_keeps_the_rest(spark):
    r = np.random.default_rng(3)
    good = [(i, _prose(r, int(n)), "aa" if i % 2 else None) for i, n in enumerate(r.integers(5, 200, 150))]
    noise = [(500 + i, "".join(r.choice(list("%$#@!ÄÖÜ{}[]"), 400)), "aa") for i in range(10)]
    odd = [(600, None, "aa"), (601, "", None), (None, _prose(r, 50), "aa"), (3, good[3][1], "aa"), (602, _prose(r, 20_000), "aa")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(500, 0, 0), (100, 1, 1), (None, 1, 0), (101, None, None)],
                                   "doc_id LONG, quality INT, toxic INT")
    docs = _docs(spark, good + noise + odd)
    rows = kneserney.quality(docs, labels).collect()
    assert len(rows) == len(good) + len(noise) + len(odd)
    bad = {x["doc_id"] for x in rows if not x["accepted"]}
    assert {i for i, _, _ in noise} <= bad and len(bad - {i for i, _, _ in noise}) <= 2
    same = [x["perplexity"] for x in rows if x["doc_id"] == 3]
    assert len(same) == 2 and same[0] == same[1]
    kept = kneserney.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len([x for x in rows if not x["accepted"]])
    assert kneserney.quality(docs, labels.limit(0)).where("not accepted").count() == 0
    assert kneserney.quality(docs.limit(0), labels).count() == 0


def test_fences_come_from_every_trusted_document_that_was_not_counted(spark):
    r = np.random.default_rng(4)
    docs = _docs(spark, [(i, _prose(r, 40), "aa" if i < 150 else "bb") for i in range(200)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id LONG, quality INT, toxic INT")
    _, all_of_them = kneserney.score(docs, labels, ["doc_id", "lang"])
    scored, rest = kneserney.score(docs, labels, ["doc_id", "lang"], trusted=20)
    ids = {x[0] for x in rest.collect()}
    assert all_of_them.count() < 60 and len(ids) >= 180  # at most 20 are counted, however many are trusted
    # the second language has a fence of its own, though none or few of its documents are among the 20
    limits = {x["lang"]: x["__limit"] for x in kneserney.fences(scored, rest, enough=30).select("lang", "__limit").distinct().collect()}
    own = sorted(math.log2(x["__ppl"]) for x in scored.where("lang = 'bb'").collect() if x["doc_id"] in ids)
    assert len(own) >= 30 and limits["bb"] > 2 ** own[-len(own) // 4]


def test_all_trusted_documents_take_part_however_many(spark):
    docs = spark.range(26_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("aa").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    _, rest = kneserney.score(docs, labels, ["doc_id", "lang"])
    fifth = docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    assert {x[0] for x in rest.collect()} == {x[0] for x in fifth.select("doc_id").collect()}


def test_quality_does_not_shuffle_all_texts_to_count_or_to_set_fences(spark, capsys):
    docs = spark.range(20_000).select(F.col("id").alias("__id"), F.concat(F.lit("t"), "id").alias("text")).union(
        spark.createDataFrame([(None, "x"), (7, "again")], "__id LONG, text STRING"))
    for every in (10, 40_000):
        ids = spark.range(0, 40_000, every).select(F.col("id").alias("__id"))
        got = [tuple(x) for x in kneserney.likely(docs, ids).collect()]
        want = {(i, f"t{i}") for i in range(0, 20_000, every)}
        assert want <= set(got) and len(got) < len(want) + 2_000
    assert kneserney.likely(docs, ids.limit(0)).count() == 0
    scored = docs.selectExpr("__id doc_id", "'aa' lang", "text", "1000L __n", "0D __logp", "2D + __id % 7 __ppl")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        capsys.readouterr()
        kneserney.fences(scored, spark.range(0, 20_000, 5).select(F.col("id").alias("__id"))).explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert plan.count("BroadcastHashJoin [__lang") == 2 and "SortMergeJoin [__lang" not in plan


def test_blocks_follow_rows_and_spread_repeats(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows.unionByName(spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))).write.parquet(str(tmp_path / "d"))
    packed, n = blocks.pack(spark.read.parquet(str(tmp_path / "d")), block_rows=1000)
    sizes = Counter()
    for row in packed.toArrow().to_pylist():
        sizes[row["block"]] += sum(b.num_rows for b in blocks.unpack(pa.table({"blob": pa.array([row["blob"]], pa.binary())})))
    assert n == len(sizes) == 41 and sum(sizes.values()) == 40_000 and max(sizes.values()) < 1300


def test_stages_take_columns_of_any_name(spark):
    r = np.random.default_rng(9)
    odd = ["__letter", "__block", "__id", "__n", "__logp", "__keep_id", "__keep_rows", "__limit", "c0", "c9"]
    texts = [_prose(r, 60) for _ in range(60)]
    rows = [(i, t, "aa", *["v"] * len(odd)) for i, t in enumerate([*texts, texts[0]])]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, " + ", ".join(f"`{c}` STRING" for c in odd))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id LONG, quality INT, toxic INT")
    assert dedup.keep_one(docs).columns == docs.columns and dedup.keep_one(docs).count() == 60
    assert kneserney.keep_good(docs, labels).columns == docs.columns
    kept = langid.keep_known(docs, langid.fit(docs))
    assert kept.columns == docs.columns and set(kept.select("__letter", "c9").distinct().first()) == {"v"}


# --- 8 -----------------------------------------------------------------------------------

def _runs(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))] if w else []


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def _copies(r, n, edits):
    """n texts made from one by 0 to ``edits`` changed words."""
    base = _prose(r, 140).split()
    out = []
    for _ in range(n):
        w = list(base)
        for p in r.choice(len(w), int(r.integers(0, edits + 1)), replace=False):
            w[p] = "edit" + _prose(r, 1)
        out.append(" ".join(w))
    return out


def test_alignment_matches_a_full_table():
    r = np.random.default_rng(4)
    for _ in range(200):
        a = r.integers(0, 30, int(r.integers(1, 60))).astype(np.uint64)
        b = a.copy()
        for p in r.choice(len(b), min(len(b), int(r.integers(0, 6))), replace=False):
            b[p] = r.integers(0, 40)
        b = np.delete(b, r.choice(len(b), int(r.integers(0, 2))))
        if not len(b):
            continue
        n = _lcs(a.tolist(), b.tolist())
        exact, got = n / (len(a) + len(b) - n), dedup.aligned(a, b, 0.8)
        assert got == pytest.approx(exact) if exact >= 0.8 else got < 0.8


def test_classes_match_brute_force_on_families_of_copies(spark):
    r = np.random.default_rng(5)
    texts = _copies(r, 60, 8) + _copies(r, 5, 2) + _copies(r, 25, 12) + [_prose(r, 100) for _ in range(30)]
    texts += [texts[0]] * 20 + [texts[70].upper() + "!!"] + ["tiny text"] * 3 + ["a b c d e f g h i j", "x b c d e f g h i j"]
    common = _prose(r, 60)
    texts += [f"{_prose(r, 40)} {common} {_prose(r, 40)}" for _ in range(20)]
    rows = [(1000 + i, t, None) for i, t in enumerate(texts)]
    odd = [(1, None, None), (2, "", None), (3, " ", None), (4, "%%%", None), (5, "%%%", None), (None, texts[0], None), (1003, texts[3], None),
           (6, _prose(r, 30_000), None)]
    got = dedup.classes(_docs(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    label = {x["doc_id"]: x["class_id"] for x in got}
    runs = {i: _runs(t) for i, t, _ in rows}
    parent = {i: i for i in runs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(runs)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(set(runs[a]) & set(runs[b])) * 9 >= 3.9 * (len(runs[a]) + len(runs[b])):
                n = _lcs(runs[a], runs[b])
                if n / (len(runs[a]) + len(runs[b]) - n) >= 0.8:
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    wrong = [i for i in ids if label[i] != find(i)]
    assert not wrong
    assert (label[1], label[2], label[3], label[4], label[5], label[6]) == (1, 2, 3, 4, 4, 6)
    assert label[None] == label[1000]


def test_only_kmers_that_can_meet_become_rows(spark):
    r = np.random.default_rng(6)
    rows, alone = [], itertools.count(1 << 40)
    for i in range(300):  # of two centres; a tenth of the nodes lie in other components; 40 k-mers that many have
        rest = [*map(int, r.choice(40, 4, replace=False)), *(next(alone) for _ in range(20))]
        rows.append((i % 2, 1000, i, 1000 if i % 10 else i, 100, 76, int(r.choice([0, 5, 21, 22, 23, 24])), rest))
    left = spark.createDataFrame(rows, dedup._LEFT).repartition(3)
    nodes = defaultdict(list)
    for centre, own, _, component, _, _, _, rest in rows:
        for k in rest:
            nodes[centre, k].append(component != own)
    got = {x["id"]: x for x in dedup._meeting(left).collect()}
    assert len(got) == 300
    for centre, _, i, _, _, _, needed, rest in rows:
        can = [k for k in rest if len(nodes[centre, k]) > 1 and any(nodes[centre, k])]
        new = list(got[i]["rest"])
        assert got[i]["needed"] >= max(0, needed - len(rest) + len(can))
        assert not got[i]["needed"] and not new or set(can) <= set(new) and got[i]["needed"] == needed - len(rest) + len(new)
    assert sum(len(x["rest"]) for x in got.values()) < 1500  # of 7,200
    must = set()  # pairs that share so many k-mers that neither's prefix may miss them
    for a, b in itertools.combinations(rows, 2):
        need = [len(x[7]) - x[6] + 1 for x in (a, b)]
        if a[0] == b[0] and a[3] != b[3] and len(set(a[7]) & set(b[7])) >= max(need):
            must.add((a[2], b[2]))
    assert len(must) > 20 and must <= {tuple(x) for x in dedup._undecided(dedup._residues(dedup._meeting(left)), 0.8).collect()}
    assert dedup._meeting(left.limit(0)).count() == 0


def test_copies_edited_in_other_places_are_no_pairs(spark):
    r = np.random.default_rng(7)
    centre = tv.mix(np.arange(1, 301, dtype=np.uint64))
    common = tv.mix(np.arange(1000, 1012, dtype=np.uint64))  # an addition that all copies have
    texts = []
    for i in range(120):
        own = np.delete(centre, r.choice(300, 45, replace=False))
        texts.append(np.r_[own, common, tv.mix(np.arange(10_000 + 100 * i, 10_018 + 100 * i, dtype=np.uint64))])
    texts += [np.r_[x[:200], tv.mix(np.arange(50_000 + 100 * i, 50_003 + 100 * i, dtype=np.uint64)), x[200:]] for i, x in enumerate(texts[:40])]
    rows = [(i, 1000, i, 1000, dedup._packed(x), dedup._packed(centre)) for i, x in enumerate(texts)]
    both = spark.createDataFrame(rows, "id long, centre long, component long, own long, left binary, right binary")
    left = dedup._residues(dedup._meeting(both.mapInArrow(dedup._against(0.8), dedup._SIGNED)))
    pairs = {tuple(x) for x in dedup._undecided(left, 0.8).collect()}
    like = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2)
            if len(set(texts[a].tolist()) & set(texts[b].tolist())) * 1.8 >= 0.8 * (len(texts[a]) + len(texts[b]))}
    assert {(i, 120 + i) for i in range(40)} <= like <= pairs and len(pairs) < 2 * len(like)
    # before they become rows: without the bitmaps far more meet
    plain = dedup._undecided(left.drop("whole", "lacks", "beyond"), 0.8)
    assert plain.count() > 50 * len(pairs)


def test_classes_of_short_texts_with_a_word_more(spark):
    rows, n = [], 0
    for words in (8, 9, 10, 11, 12, 13):
        for k in range(40):
            text = [f"w{n}x{j}" for j in range(words + 1)]
            rows += [(2 * n, " ".join(text[1:] if k % 2 else text[:-1]), None), (2 * n + 1, " ".join(text), None)]
            n += 1
    got = {r["doc_id"]: r["class_id"] for r in dedup.classes(_docs(spark, rows)).collect()}
    assert all(got[2 * k] == got[2 * k + 1] == 2 * k for k in range(n))


def test_keep_one_keeps_the_least_of_each_class(spark):
    r = np.random.default_rng(6)
    t = _copies(r, 4, 1)
    rows = [(i + 10, x, None) for i, x in enumerate(t)] + [(50, _prose(r, 30), None), (60, None, None), (60, None, None), (61, "", None), (10, t[0], None)]
    docs = _docs(spark, rows)
    kept = dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(x["doc_id"] for x in kept.collect()) == [10, 50, 60, 60, 61]
    assert dedup.keep_one(docs.limit(0)).count() == 0 and dedup.classes(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(500, 501), (501, 500), (7, 7)]
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(links, "a LONG, b LONG"), "a", "b").collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(30)} == {0} and got[501] == 500
    assert components.components(spark.createDataFrame([], "a LONG, b LONG"), "a", "b").count() == 0


# --- 9 -----------------------------------------------------------------------------------

def _lm_docs():
    r = np.random.default_rng(7)
    words = [_prose(r, 1) for _ in range(40)]
    return [" ".join(r.choice(words, int(n))) + "." for n in r.integers(1, 90, 60)] + [None, "", " \n", "NEW words — here É", words[0] * 3000]


def test_attention_is_causal_and_scores_each_id_once():
    texts = [x.split() for x in _lm_docs() if x]
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    coded = [np.array([ids[w] for w in t], np.int64) for t in texts]
    end = len(ids)
    m = attention.Model(attention.train(coded, end + 1, end, epochs=2))
    first = np.cumsum([0, *map(len, coded)])
    logp, at = m.logp(np.concatenate(coded), first)
    assert len(logp) == sum(len(c) + 1 for c in coded)
    for k in (0, 3, len(coded) - 2):
        own = logp[at[k]:at[k + 1]]
        alone, _ = m.logp(coded[k], np.array([0, len(coded[k])]))
        assert own == pytest.approx(alone, abs=1e-4)
        n = max(1, len(coded[k]) // 2)
        head, _ = m.logp(coded[k][:n], np.array([0, n]))
        assert head[:n] == pytest.approx(own[:n], abs=1e-4)          # what follows changes nothing
    p = m.p
    total = sum(math.exp(m.logp(np.array([3, v]), np.array([0, 2]))[0][1]) for v in range(end + 1))
    assert total == pytest.approx(1.0, abs=1e-3) and p["e"].shape[1] == attention.WIDTH


def test_attention_by_explicit_loops():
    coded = [np.arange(70) % 11, np.array([4])]
    m = attention.Model(attention.train(coded, 12, 11, epochs=1))
    logp, at = m.logp(np.concatenate(coded), np.array([0, 70, 71]))
    p, x = m.p, np.r_[11, coded[0]]
    y = np.r_[coded[0], 11]
    e = p["e"][p["compact"][x]]
    for t in (0, 5, 23, 24, 30, 55, 70):
        lo = max(0, t // attention.STRIDE * attention.STRIDE - attention.LAP)
        s = np.array([e[t] @ p["wq"] @ (e[j] @ p["wk"]) + p["rel"][t - j] for j in range(lo, t + 1)])
        a = np.exp(s - s.max())
        z = (a / a.sum()) @ np.array([e[j] @ p["wv"] for j in range(lo, t + 1)])
        logits = e[t] @ p["wr"] + p["b"] + z @ p["o"]
        want = logits[p["cls"][y[t]]] - np.log(np.exp(logits).sum()) + p["inner"][y[t]]
        assert logp[t] == pytest.approx(want, abs=1e-4)


def test_neighbour_counts_take_bounded_memory():
    import tracemalloc
    r = np.random.default_rng(4)
    first = np.r_[0, np.cumsum(np.full(2000, 600))].astype(np.int64)
    ids = r.integers(0, 500, first[-1]).astype(np.uint16)
    compact, col = np.arange(600), attention._columns(np.bincount(ids, minlength=500).astype(float))
    col = np.r_[col, np.full(100, -1)]
    tracemalloc.start()
    at, n = attention._neighbours(ids, first, compact, 501, col)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    _, inputs, targets, _ = attention._windows(compact[ids], first, 501)
    want, much = np.unique(attention._cells(inputs, targets, col), return_counts=True)
    assert (at == want).all() and (n == much).all()
    assert most < 40 * len(ids)  # the whole block at once took more than 100 bytes an id



def test_attention_scores_carry_exact_base_scores(spark):
    texts = _lm_docs()
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(3, texts[3], None), (None, texts[5], None)]
    got = attention.score(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    ink = re.compile(r"[^\x20\x09-\x0D]+")
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for _, t, _ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows]
    count = Counter(w for t, h in zip(low, held) if not h for w in [*ink.findall(t), None])
    n, v = sum(count.values()), len(count)
    want = defaultdict(list)
    for (i, _, _), t, h in zip(rows, low, held):
        w = [*ink.findall(t), None]
        want[i].append((h, len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    for r in got:
        w = want[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4]) and r["score"] < 0


def test_attention_beats_id_shares_on_held_out_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").toArrow().to_pylist()
    coded = {h: [ids[first[i]:first[i + 1]] for lo, hi, ids, first in subword.encode_column(
        pa.array([r["text"] for r in rows if (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) == h])) for i in range(hi - lo)] for h in (False, True)}
    size = subword.encoder().size()
    m = attention.Model(attention.train(coded[False][:400], size, size - 1, epochs=1))
    flat = np.concatenate(coded[True])
    logp, _ = m.logp(flat, np.cumsum([0, *map(len, coded[True])]))
    share = np.bincount(np.concatenate(coded[False]), minlength=size) + 0.5
    assert logp.mean() > np.log(share / share.sum())[flat].mean() + 0.7


def test_attention_steps_in_pieces_and_on_touched_rows_only():
    rng = np.random.default_rng(1)
    for n in (1, attention.RUN, 3 * attention.RUN + 5):
        a, b = rng.standard_normal((n, 4)), rng.standard_normal((n, 7))
        assert np.allclose(attention._across(a, b), a.T @ b)
    value, m, own = np.ones((5, 2), np.float32), np.array([[0.5, -2.0], [0.0, 3.0]], np.float32), np.array([1, 3])
    one, two = np.zeros_like(value), np.zeros_like(value)
    attention._adam(value, one, two, m, 0.1, 1, own)
    assert np.allclose(value[own], [[0.9, 1.1], [1.0, 0.9]], atol=1e-5)  # a first step is the rate, towards less
    assert (value[[0, 2, 4]] == 1).all() and not one[[0, 2, 4]].any() and not two[[0, 2, 4]].any()


def test_attention_without_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = attention.score(_docs(spark, [(held, "ab cd", None)])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and r["score"] < 0
    assert attention.score(_docs(spark, [(held, "ab", None)]).limit(0)).count() == 0


def test_attention_learns_from_every_training_document(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [letters[i // 676 % 26] + letters[i // 26 % 26] + letters[i % 26] for i in range(0, 17576, 7)]
    p = attention.fit(_docs(spark, [(i, t, None) for i, t in enumerate(texts)]).select("doc_id", "text"), block_bytes=2000, epochs=1)
    used = np.unique(np.concatenate([ids for _, _, ids, _ in subword.encode_column(pa.array(texts))]))
    assert (p["compact"][used] < len(p["e"]) - 1).all() and np.isfinite(p["e"]).all()


def test_attention_of_averaged_blocks_beats_id_shares(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    both = {h: [t for i, t in rows.collect() if (zlib.crc32(str(i).encode()) % 7 == 2) == h] for h in (False, True)}
    p = attention.fit(spark.createDataFrame(list(enumerate(both[False])), "doc_id LONG, text STRING"), block_bytes=1 << 20)
    flat, first = [], [0]
    for lo, hi, ids, at in subword.encode_column(pa.array(both[True])):
        flat.append(ids)
        first += (at[1:] + first[-1]).tolist()
    logp, place = attention.Model(p).logp(np.concatenate(flat), np.array(first))
    share = np.full(subword.encoder().size(), 0.5)
    for _, _, ids, _ in subword.encode_column(pa.array(both[False])):
        share += np.bincount(ids, minlength=len(share))
    assert logp.mean() > np.log(share / share.sum())[np.concatenate(flat)].mean() + 0.7


def test_word_counts_of_a_block_and_of_its_shards():
    words = "a b a c".split()
    data, off = tv.utf8(pa.array([" ".join(words)]))
    keys = attention._distinct(attention._words(data, off)[2])
    assert [k for _, lo, hi in attention._shards(keys, 3) for k in keys[lo:hi]] == keys.tolist()
    assert subword.encoder().size() == 49408


def test_pass_over_texts_takes_bounded_memory():
    import tracemalloc
    r = np.random.default_rng(6)
    first = np.r_[0, np.cumsum(np.full(500, 600))].astype(np.int64)
    ids, cls = r.integers(0, 400, first[-1]).astype(np.uint16), np.arange(401) % 8
    p = attention._start(np.ones(401), cls, 8, r)
    attention._epoch(p, ids[:600], first[:2], 400, cls, r, {}, 0, 1)  # what a pass takes however few the ids
    tracemalloc.start()
    attention._epoch(p, ids, first, 400, cls, r, {}, 0, 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < (10 << 20) and np.isfinite(p["e"]).all()  # every window's places at once took 20 MB more


def test_padding_and_first_windows_are_not_seen():
    texts = [[3], [1, 2], list(range(30)), [5] * 24]
    first = np.r_[0, np.cumsum([len(t) for t in texts])]
    flat, at = attention._joined(np.concatenate(texts), first, 99)
    starts, stops, leads = attention._spread(at)
    x, place, ok, lead = attention._inputs(flat, starts, stops, leads, 99)
    got = [[] for _ in texts]
    for k in np.flatnonzero(ok):
        got[np.searchsorted(at, place[k], "right") - 1].append((x[:, attention.LAP:].ravel()[k], flat[place[k] + 1]))
    assert got == [list(zip([99, *t], [*t, 99])) for t in texts]      # every target once
    assert (x[lead, :attention.LAP] == 99).all() and len(lead) == len(texts)
    assert (x[:, attention.LAP:].ravel()[~ok] == 99).all()
    assert x[leads.nonzero()[0][2] + 1, :attention.LAP].tolist() == list(range(15, 23))


def test_rows_of_ids_are_small_and_whole():
    texts = [("ab " * 90000), "x y", None, *["some words here"] * 50, "cd " * 200000]
    rows = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts), "key": pa.array(range(len(texts)), pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    got = attention._encode(None)(pa.table({"block": pa.array([4], pa.int32()), "blob": [sink.getvalue().to_pybytes()]}))
    parts = [x for _, _, *x in attention._pieces(got.to_batches(), "<u2")]
    assert len(parts) == 2 and all(len(ids) <= attention.SLICE or len(first) == 2 for ids, first in parts)
    back = [ids[a:b].tolist() for ids, first in parts for a, b in zip(first[:-1], first[1:])]
    assert back == [ids[first[i]:first[i + 1]].tolist() for lo, hi, ids, first in subword.encode_column(pa.array(texts)) for i in range(hi - lo)]
    sums = attention._merged((np.array([1, 4]), np.array([2, 3])), (np.array([0, 4]), np.array([5, 6])))
    assert [x.tolist() for x in sums] == [[0, 1, 4], [5, 2, 9]]


def test_merges_equal_the_library():
    from tokenizers import Tokenizer
    r = np.random.default_rng(11)
    wide = [*map(chr, range(32, 127)), *map(chr, range(0xC0, 0x100)), *"aeiounrst" * 9]
    texts = ["".join(r.choice(wide, int(n))) for n in r.integers(0, 120, 800)]
    texts += ["".join(r.choice([*"aAbBeéÉßÿ"], int(n))) for n in r.integers(0, 60, 400)]
    texts += ["".join(r.choice([*wide, *"漢字كتاب😀́’"], int(n))) for n in r.integers(0, 80, 400)]
    texts += ["a" * n for n in (1, 2, subword.LONGEST, subword.LONGEST + 1)] + ["1234567890", "!!!???", "_-_", "hahahaha", ""]
    enc = subword.Encoder()
    ids, first = enc.encode(*tv.utf8(pa.array(texts)))
    want = [x.ids for x in Tokenizer.from_file(subword.default_path()).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want
    assert enc._merges is not None


def test_other_tokenizer_files_are_left_to_the_library(tmp_path):
    import json
    d = json.load(open(subword.default_path(), encoding="utf-8"))
    d["normalizer"] = None
    path = tmp_path / "other.json"
    path.write_text(json.dumps(d))
    enc = subword.Encoder(str(path))
    ids, _ = enc.encode(*tv.utf8(pa.array(["hello world"])))
    assert enc._merges is None and ids.tolist() == enc._tokenizer.encode("hello world", add_special_tokens=False).ids


# --- the pipeline ------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline
    r = np.random.default_rng(8)
    item = _prose(r, 30)
    rows = [(i, _prose(r, 120), "aa", "s", 1) for i in range(60)]
    rows += [(100, "123 456", "aa", "s", 1), (101, "".join(r.choice(list("%$#@!{}"), 600)) + " a", "aa", "s", 1), (102, rows[7][1] + " end", "aa", "s", 1),
             (103, f"{_prose(r, 60)} {item} {_prose(r, 60)}", "aa", "s", 1), (104, None, None, None, None)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id LONG, text STRING").write.parquet(f"{sf}/benchmark.parquet")
    docs, gone = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(f"{sf}/{name}")
        out = spark.read.parquet(f"{sf}/{name}")
        assert out.columns == docs.columns
        gone.append({x["doc_id"] for x in docs.collect()} - {x["doc_id"] for x in out.collect()})
        docs = out
    assert gone[0] == {100, 104} and 101 in gone[1] and 102 in gone[2] and gone[3] == {103}
    assert len(gone[1]) <= 3
    packed = corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()
    assert {x["doc_id"] for x in packed} == {x["doc_id"] for x in docs.collect()}
