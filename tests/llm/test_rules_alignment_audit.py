"""Operators 11, 12 and 13 against brute force."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weft.llm import audit, crosstoken, urlrules

# --- 11 ----------------------------------------------------------------------------------

PAGES = "page_id LONG, url STRING, host STRING, verdict STRING, url_rule STRING"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "v", "r") for r in rows], PAGES).repartition(3)


def _split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def _judged(url, rules, default="allow"):
    host, path = _split(url)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, default, None)
    return host, path, best[3], best[2]


URLS = [None, "", "no scheme", "http://a.com", "http://a.com/", "HTTP://WWW.Example.COM/en/1?x#y", "https://example.com/en/", "https://example.com/en",
        "x://badexample.com/en/2", "y://Ä.net/es/1", "y://net/fr/", "y://net/frx", "y://a.net?/es/", "y://a.net#/fr/", "z://com/a://b.net/es/", "q://a.com:80/x",
        "q://.com/x", "q://com./x", "q://u@example.com/en/x", "q:///en/", "p://a.net/es/" + "z/" * 30_000, "p://" + "a." * 5_000 + "com/", "p://x.example.com/en//"]


def test_url_rules_equal_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://b.net/fr/1"), (3, "http://a.com"), (3, "http://a.com")]
    got = urlrules.judge(_pages(spark, rows))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, got.collect())) == Counter((i, *_judged(u, urlrules.RULES)) for i, u in rows)
    assert urlrules.judge(_pages(spark, rows).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "a", "b.a", "c.b.a", "b"]), st.sampled_from(["", "/", "/x", "/x/", "/x/y", "/x/yy/", "/x/y/z/"]),
                          st.sampled_from(["allow", "block"])), max_size=8),
       st.sampled_from(["a", "b.a", "d.c.b.a", "cb.a", "", "b"]), st.sampled_from(["", "/", "/x", "/xy", "/x/", "/x/yy/z", "/x/y/z/q", "/x/y"]))
def test_trie_finds_the_longest_rule(rules, host, path):
    found = urlrules.Trie(rules).find(host, path)
    assert _judged(f"s://{host}{path}", rules)[2:] == ((found or (None, "allow"))[0], (found or (None, "allow"))[1])


def test_rule_lists_beyond_the_trie_give_the_same_verdicts(spark):
    rules = [(h, p, v) for h, p, v in urlrules.RULES] + [("", "/en", "block"), ("a.com", "", "block"), ("a.com", "", "allow"), ("Net", "/es/z", "allow")]
    rows = [(i, u) for i, u in enumerate(URLS)] + [(99, "http://b.com/hot")] * 500
    trie = urlrules.judge(_pages(spark, rows), rules).collect()
    joined = urlrules.judge(_pages(spark, rows), rules, trie_bytes=0).collect()
    assert Counter(map(tuple, trie)) == Counter(map(tuple, joined)) and len(trie) == len(rows)
    low = [(h.lower(), p, v) for h, p, v in rules]
    assert Counter(map(tuple, trie)) == Counter((i, *_judged(u, low)) for i, u in rows)


def test_allowed_pages_keep_their_columns_and_bad_rules_are_refused(spark):
    pages = _pages(spark, [(1, "http://a.net/es/1"), (2, "http://www.example.com/en/"), (3, None)])
    kept = urlrules.keep_allowed(pages)
    assert kept.columns == pages.columns and sorted(r[0] for r in kept.collect()) == [2, 3]
    assert [r[0] for r in urlrules.keep_allowed(pages, default="block").collect()] == [2]
    for bad in [("a", "/", "maybe"), ("a", None, "allow"), (None, "/", "allow"), ("a", "/", None)]:
        with pytest.raises(ValueError):
            urlrules.judge(pages, [bad])


# --- 12 ----------------------------------------------------------------------------------

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [None, "", " ", "hello world", "Straße über naïve café 東京 🙂🙂", "<s>a<|endoftext|>b</s><unk><0x41>", "a▁b", "x\n\n\ty  z   ", "z" * 3000, " " * 2500, "\n" * 1500 + "q",
         "the quick brown fox " * 400, "ﬁ ½ é", "1234567890 12.5%", "\u200b\ufeff", "hello world"]


def _tokens(text):
    """[(id, bytes)] of both tokenizations by the libraries themselves, or two empty lists."""
    if not text:
        return [], []
    want = (" " + text).encode()
    back = {}
    for b in range(256):  # byte-level symbols
        back[chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(256 + sum(not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174) for x in range(b)))] = b
    a = [(i, bytes(back[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def _brute(texts):
    rows, count = [], Counter()
    for text in texts:
        a, b = _tokens(text)
        ends_a, ends_b = (list(itertools.accumulate(len(x) for _, x in t)) for t in (a, b))
        links = [(a[i][0], b[ends_b.index(e)][0]) for i, e in enumerate(ends_a) if e in set(ends_b)]
        groups, lo = [], 0
        for e in sorted(set(ends_a) & set(ends_b)):
            groups.append("|".join(",".join(str(t[k][0]) for k, x in enumerate(ends) if lo < x <= e) for t, ends in ((a, ends_a), (b, ends_b))))
            lo = e
        count.update(links)
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(na, nb, g, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), sha) for na, nb, g, links, sha in rows]


def _documents(spark, rows, schema="doc_id LONG, text STRING, n_a STRING, links STRING"):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3)


def test_alignment_equals_brute_force(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "hello there world"), (3, "hello world")]
    want = Counter((i, *x) for (i, _), x in zip(rows, _brute([t for _, t in rows])))
    got = crosstoken.score(_documents(spark, rows))
    assert got.columns == crosstoken.OUT
    assert Counter(map(tuple, got.collect())) == want
    assert crosstoken.score(_documents(spark, rows).limit(0)).count() == 0


def test_links_are_the_products_of_the_incidence_matrices(spark):
    texts = [t for t in TEXTS if not t or len(t) < 200]
    docs = _documents(spark, list(enumerate(texts)))
    overlap, groups = set(), set()
    for d, text in enumerate(texts):
        a, b = _tokens(text)
        spans = [[(e - len(x[1]), e) for e, x in zip(itertools.accumulate(len(x) for _, x in t), t)] for t in (a, b)]
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        for (i, (s, e)), (j, (u, v)) in itertools.product(enumerate(spans[0]), enumerate(spans[1])):
            if min(e, v) > max(s, u):
                overlap.add((d, i, j, a[i][0], b[j][0], min(e, v) - max(s, u), e == v))
            g = [sum(c < x for c in common) for x in (e, v)]
            if g[0] == g[1]:
                groups.add((d, i, j, a[i][0], b[j][0], g[0]))
    assert {tuple(r) for r in crosstoken.overlap_links(docs).collect()} == overlap
    assert {tuple(r) for r in crosstoken.shared_group_links(docs).collect()} == groups


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 9))
def test_row_products_equal_dense_products(seed, limit):
    r = np.random.default_rng(seed)
    x, y = (r.random((int(n), int(m))) < 0.4 for n, m in (r.integers(1, 7, 2), (1, 1)))
    y = r.random((x.shape[1], int(r.integers(1, 7)))) < 0.4

    def csr(m):
        return crosstoken.Csr(np.r_[0, np.cumsum(m.sum(1))], np.nonzero(m)[1], m.shape[1])
    out = np.zeros((x.shape[0], y.shape[1]), int)
    for i, j, n in crosstoken.products(csr(x), csr(y), limit):
        out[i, j] += n
    assert (out == x.astype(int) @ y.astype(int)).all()
    t = csr(x).transposed()
    assert [t.start.tolist(), t.col.tolist()] == [csr(x.T).start.tolist(), csr(x.T).col.tolist()]


def test_linked_pairs_are_bounded_by_the_vocabularies():
    v = crosstoken.vocabularies()
    assert v._fast is not None and 100_000 < v.pair_bound() < 1_000_000
    texts = [t for t in TEXTS if t]
    assert v.encode_a(texts) == [x.ids for x in A.encode_batch(texts, add_special_tokens=False)]


# --- 13 ----------------------------------------------------------------------------------

def _fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}


def _audited(rows, labels):
    """Rows of the audit, filter by filter over the documents themselves."""
    docs = []
    for i, t, lang in rows:
        t = t or ""
        fails = {k for k, x in _fails(t).items() if x}
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            fails.add("E")
        docs.append((lang or "", fails, any(x[0] == i and x[1] == 1 for x in labels if i is not None), any(x[0] == i and x[2] == 1 for x in labels if i is not None)))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shares = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, k in enumerate(order, 1):
                gone = [d for d in left if k in d[1]]
                left = [d for d in left if k not in d[1]]
                shares[k] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(k in d[1] for d in own) - len(gone), sum(d[1] == {k} for d in own),
                                          sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(shares[order[step - 1]])
    return Counter((*k, *v) for k, v in out.items())


def test_audit_equals_filtering_in_every_order(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(1, long, "aa"), (2, long, "aa"), (3, long + " #", "aa"), (4, "AB " * 130, "aa"), (5, None, "aa"), (6, "", None), (7, long, None), (7, long, None),
            (7, long + " x", "bb"), (None, long, "bb"), (None, None, "bb"), (8, "x\x0b\x0c\r\n\ty " * 60, ""), (9, "a\u00a0b $", "bb"), (10, long + " ÄÖÜ", "bb"), (11, "Q " * 50_000, "bb")]
    rows += [(100 + i, "copy of a hot text", "aa") for i in range(40)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 1), (3, None, 1), (7, 1, None), (9, 0, 1), (105, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id LONG, text STRING, lang STRING, part STRING, bits INT").repartition(4)
    marks = spark.createDataFrame([(*x, 5) for x in labels], "doc_id LONG, quality INT, toxic INT, n INT")
    got = audit.audit(docs, marks)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert Counter(map(tuple, got.collect())) == _audited(rows, labels)
    assert audit.audit(docs.limit(0), marks).count() == 0
    assert audit.audit(docs, marks.limit(0)).count() == 600 * 3


def test_copies_are_marked_alike_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 7}", "aa") for i in range(60)], "doc_id LONG, text STRING, lang STRING")
    want = sorted(range(7, 60))
    assert sorted(r[0] for r in audit.marked_copies(docs).collect()) == want
    monkeypatch.setattr(audit, "TWINS_BROADCAST", -1)
    assert sorted(r[0] for r in audit.marked_copies(docs).collect()) == want
