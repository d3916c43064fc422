"""Vectorised words, hash maps and subword ids against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from weft.llm import subword
from weft.llm import textvec as tv


@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_words_and_their_hashes(monkeypatch, piece):
    monkeypatch.setattr(tv, "PIECE", piece)
    r = random.Random(1)
    for _ in range(100):
        docs = ["".join(r.choice("aB9 .\n'éÉ日-Z") for _ in range(r.randrange(0, 40) * r.choice([0, 1, 1, 8]))) for _ in range(r.randrange(0, 9))]
        docs = [None if r.random() < 0.1 else d for d in docs]
        data, off = tv.utf8(pa.array(docs, pa.string()))
        s, e, h, first = tv.words(data, off)
        for i, d in enumerate(docs):
            low = bytes(tv.lowered(np.frombuffer((d or "").encode(), np.uint8)))
            want = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
            assert [bytes(tv.lowered(data)[a:z]) for a, z in zip(s[first[i]:first[i + 1]], e[first[i]:first[i + 1]])] == want
            assert [tv.word_hash(w.decode()) for w in want] == [int(x) for x in h[first[i]:first[i + 1]]]


def test_positions_find_what_was_added():
    rng = np.random.default_rng(2)
    known, keys = tv.Positions(4), np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    rng.shuffle(keys)
    for part in np.array_split(keys, 7):
        known.add(part)
    assert known.find(keys).tolist() == list(range(len(keys)))
    assert (known.find(rng.integers(1 << 63, 1 << 64, 100, dtype=np.uint64)) == -1).all()


@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_ids_equal_the_tokenizers(monkeypatch, piece):
    monkeypatch.setattr(tv, "PIECE", piece)
    t = Tokenizer.from_file(subword.default_path())
    r = random.Random(3)
    signs = ["a", "B", "é", "É", "'", "s", "'s", "'T", "ll", " ", "\n", "\t", "9", "0", ".", "!", "<|endoftext|>", "<|", "|>", "ENDOFTEXT",
             "—", "́", "̸", "я", "Я", "日", " ", "　", "×", "ß", "İ", "K", "\x0b", "\x85", "\x1f", "\x00", "=", "<", "ﬁ", "J", "I"]
    rows = ["".join(r.choice(signs) for _ in range(r.randrange(0, 60))) for _ in range(1500)] + ["", None, " ", "x" * 5000, "a. " * 4000]
    got = [ids[first[i]:first[i + 1]].tolist() for lo, hi, ids, first in subword.encode_column(pa.array(rows)) for i in range(hi - lo)]
    assert got == [t.encode(x or "", add_special_tokens=False).ids for x in rows]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(subword, "CACHE", 50)
    enc = subword.Encoder()
    t = Tokenizer.from_file(subword.default_path())
    for k in range(5):
        texts = [f"w{k}x{i} and w{i}" for i in range(60)]
        data, off = tv.utf8(pa.array(texts))
        ids, first = enc.encode(data, off)
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
