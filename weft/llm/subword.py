"""Subword ids of whole Arrow columns, by a public tokenizer file.

The tokenizer lower-cases, splits at white space and between letters, digits and other
signs, so the ids of a text are the ids of its pieces in order. A batch is cut into pieces
with numpy, each distinct piece is encoded once (a cache of bounded size lives in the
Python worker), and the ids are gathered. Plain pieces (ASCII and Latin-1 letters, digits, ASCII
signs) are merged many at a time with numpy, all others by the library. Pieces are cut only where the tokenizer itself
must cut: at ASCII white space, and between runs of letters (ASCII, Latin-1), of digits and
of plain ASCII signs; whatever else stands in a text stays with its neighbours.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np

from . import textvec as tv

CACHE = 1_500_000
CHUNK = 2 << 20
LONGEST = 48
_OTHER, _LETTER, _DIGIT, _SIGN, _SPACE = 0, 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
for _c in range(33, 127):
    if not chr(_c).isalnum() and chr(_c) not in "'<>|":
        _KIND[_c] = _SIGN
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: What the numpy merges stand for; a file of another kind is left to the library.
_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "truncation": None, "padding": None}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>",
          "byte_fallback": False, "ignore_merges": False}


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {b: chr(b) for b in own}
    return [sign.get(b) or chr(256 + sum(c not in sign for c in range(b))) for b in range(256)]


class Merges:
    """Byte-pair merges of many plain pieces at once, in the library's own order: each round merges, in every
    piece that has one left, the pair learned first (of equal ones the leftmost)."""

    def __init__(self, vocab: dict, merges: list):
        signs = _byte_signs()
        self.inner = np.array([vocab[c] for c in signs], np.int64)
        self.last = np.array([vocab[c + "</w>"] for c in signs], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._rank = tv.Positions()
        self._rank.add(self._key(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs])))

    @classmethod
    def of(cls, path: str) -> Merges | None:
        """The merges of a tokenizer file; None if it is not of the kind that they stand for."""
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        m = d.get("model") or {}
        if any(d.get(k) != v for k, v in _RULES.items()) or any(m.get(k) != v for k, v in _MODEL.items()):
            return None
        if any(not {"<", ">", "|"} & set(t["content"]) for t in d.get("added_tokens") or []):
            return None
        try:
            return cls(m["vocab"], m["merges"])
        except KeyError:
            return None

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return tv.mix((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))

    def _ranks(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Each pair's place in learned order, then its place in the array, as one number; all ones for no pair."""
        rank = self._rank.find(self._key(a, b)).astype(np.int64).view(np.uint64)
        return np.where(rank >> np.uint64(63), _NONE, (rank << np.uint64(32)) | at.astype(np.uint64))

    def __call__(self, raw: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, of ``n`` (at least one) lower-cased bytes each, and their numbers."""
        ids = self.inner[raw]
        begin = np.cumsum(n) - n
        end = begin + n - 1
        ids[end] = self.last[raw[end]]
        alone = _KIND[raw] == _DIGIT
        ids[alone] = self.last[raw[alone]]
        out, count = ids.copy(), n.copy()
        word, start = np.arange(len(n)), begin
        pair = np.full(len(ids), _NONE)
        inside = np.ones(len(ids), bool)
        inside[end] = False
        at = np.flatnonzero(inside)
        pair[at] = self._ranks(ids[at], ids[at + 1], at)
        while len(word):
            best = np.minimum.reduceat(pair, start)
            go = best != _NONE
            if not go.all():
                size = np.diff(np.r_[start, len(ids)])
                done = ~go
                k = size[done]
                step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                out[np.repeat(begin[word[done]], k) + step] = ids[np.repeat(start[done], k) + step]
                count[word[done]] = k
                keep = np.repeat(go, size)
                # places are kept within pairs: those of what stays move down
                moved = np.repeat(np.cumsum(np.where(go, 0, size))[go], size[go])
                ids, pair = ids[keep], pair[keep]
                pair = np.where(pair == _NONE, pair, pair - moved.astype(np.uint64))
                word, size = word[go], size[go]
                start = np.cumsum(size) - size
                if not len(word):
                    break
                best = best[go] - (moved[start]).astype(np.uint64)
            at = (best & _LOW).astype(np.int64)
            ids[at] = self.made[(best >> np.uint64(32)).astype(np.int64)]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            pair[at] = _NONE  # set anew below, where a neighbour follows
            ids, pair = ids[keep], pair[keep]
            gone = np.arange(len(start))  # one place in each piece before
            at, start = at - gone, start - gone
            stop = np.r_[start[1:], len(ids)]
            pair = np.where(pair == _NONE, pair, (pair & ~_LOW) | np.arange(len(pair), dtype=np.uint64))
            left = at[at > start] - 1
            right = at[at + 1 < stop]
            new = np.concatenate((left, right))
            pair[new] = self._ranks(ids[new], ids[new + 1], new)
        total = np.cumsum(count) - count
        return out[np.repeat(begin - total, count) + np.arange(count.sum())], count


_NONE, _LOW = np.uint64((1 << 64) - 1), np.uint64((1 << 32) - 1)


def _plain(raw: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of pieces, and which pieces hold letters, digits or signs only and are not too long."""
    fine = _KIND[raw] != _OTHER
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] >= 0x80) & (raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
    fine[lead] = fine[lead + 1] = True
    return tv.lowered(raw), np.logical_and.reduceat(fine, np.cumsum(n) - n) & (n <= LONGEST)


class Encoder:
    """Encodes columns with one tokenizer file."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path or default_path())
        self._merges = Merges.of(path or default_path())
        self._clear()

    def _clear(self):
        self._known = tv.Positions()
        self._at = np.zeros(0, np.int64)
        self._n = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def size(self) -> int:
        return self._tokenizer.get_vocab_size()

    def _learn(self, keys: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray):
        n = e - s
        raw = data[np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        low, plain = _plain(raw, n) if self._merges else (raw, np.zeros(len(n), bool))
        count = np.zeros(len(n), np.int64)
        own = np.repeat(plain, n)
        if plain.any():
            some, count[plain] = self._merges(low[own], n[plain])
        odd, raw = np.flatnonzero(~plain), raw.tobytes()
        at = np.cumsum(n) - n
        ids = [x.ids for x in self._tokenizer.encode_batch_fast(
            [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[odd].tolist(), (at + n)[odd].tolist())], add_special_tokens=False)]
        count[odd] = np.fromiter(map(len, ids), np.int64, len(ids))
        flat, own = np.empty(int(count.sum()), np.int32), np.repeat(plain, count)
        if plain.any():
            flat[own] = some
        flat[~own] = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(count[odd].sum()))
        self._known.add(keys)
        self._at = np.r_[self._at, len(self._ids) + np.cumsum(count) - count]
        self._n = np.r_[self._n, count]
        self._ids = np.r_[self._ids, flat]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the first id of each text (n+1)."""
        return self.encode_pieces(data, off)[:2]

    def encode_pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As encode; and each piece's start and number of ids."""
        s, e, key = pieces(data, off)
        at = self._known.find(key)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            if len(self._known) > CACHE:
                self._clear()
                miss = np.arange(len(key))
            new, first = np.unique(key[miss], return_index=True)
            self._learn(new, data, s[miss[first]], e[miss[first]])
            at = self._known.find(key)
        n = self._n[at]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        ids = self._ids[np.repeat(self._at[at] - (end - n), n) + np.arange(total)]
        return ids, np.r_[0, end][np.searchsorted(s, off)], s, n


def pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the pieces of all texts."""
    starts, ends, keys = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + tv.PIECE)
        while hi < n and _KIND[data[hi]] != _SPACE:
            gap = np.flatnonzero(_KIND[data[hi:hi + 65536]] == _SPACE)
            hi = hi + int(gap[0]) if len(gap) else min(n, hi + 65536)
        b = data[lo:hi]
        kind = _KIND[b]
        if len(b) > 1:
            lead = np.flatnonzero(b[:-1] == 0xC3)
            lead = lead[(b[lead + 1] != 0x97) & (b[lead + 1] != 0xB7)]
            kind[lead] = kind[lead + 1] = _LETTER
        cut = np.zeros(len(b) + 1, bool)
        cut[0] = cut[-1] = True
        x, y = kind[:-1], kind[1:]
        cut[1:-1] = (x != y) & (((x != _OTHER) & (y != _OTHER)) | (x == _SPACE) | (y == _SPACE))
        cut[off[np.searchsorted(off, lo):np.searchsorted(off, hi)] - lo] = True
        edge = np.flatnonzero(cut)
        s, e = edge[:-1], edge[1:]
        ink = kind[s] != _SPACE
        s, e = s[ink], e[ink]
        low = tv.lowered(b)
        odd = np.r_[0, np.cumsum(kind == _OTHER)]
        odd = np.flatnonzero(odd[e] > odd[s])
        for a, z in zip(s[odd].tolist(), e[odd].tolist()):
            low[a:z] = b[a:z]  # only plain pieces are folded
        starts.append(s + lo)
        ends.append(e + lo)
        keys.append(tv.hashes(low, s, e))
        lo = hi
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(keys)


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The Python worker's encoder for this file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_column(col, path: str | None = None):
    """(lo, hi, ids, first) for ranges of texts of a column, of bounded size."""
    enc = encoder(path)
    data, off = tv.utf8(col)
    for lo, hi in tv.spans(off, CHUNK):
        yield lo, hi, *enc.encode(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
