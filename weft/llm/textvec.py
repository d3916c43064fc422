"""Vectorised word and hash helpers over Arrow string buffers.

They run inside Spark tasks on one Arrow batch at a time. Work arrays are sized by
``PIECE`` bytes, not by the batch, so a very long text costs no more memory than many
short ones.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

# Python workers share an executor's memory with its JVM: freed batches go back to the system.
pa.set_memory_pool(pa.system_memory_pool())

PIECE = 1 << 20
_P = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
U64 = np.uint64

#: ASCII lower-casing of bytes; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[65:91] = WORD[128:] = True
#: Bytes of ``[^\x20\x09-\x0D]+``.
INK = np.ones(256, dtype=bool)
INK[9:14] = INK[32] = False

_powers: list[np.ndarray] = []
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give this worker's freed memory back to the system; where the C library has no such call, it stays."""
    if _trim is not None:
        _trim(0)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, PIECE + 4096)
        tabs = []
        for p in (_P, pow(_P, -1, 1 << 64)):
            t = np.full(n, p, dtype=U64)
            t[0] = 1
            tabs.append(np.cumprod(t, dtype=U64))
        _powers[:] = tabs
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (in place)."""
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n+1) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    _, off, data = col.buffers()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def spans(offsets: np.ndarray, limit: int):
    """Ranges (lo, hi) of whole documents of about ``limit`` bytes; a longer one is alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _cut(data: np.ndarray, lo: int, n: int, is_word: np.ndarray) -> int:
    hi = min(n, lo + PIECE)
    while hi < n and is_word[data[hi]]:
        w = np.flatnonzero(~is_word[data[hi:hi + 65536]])
        if len(w):
            return hi + int(w[0])
        hi = min(n, hi + 65536)
    return hi


def lowered(b: np.ndarray, accents: bool = True) -> np.ndarray:
    """Bytes with A-Z in lower case; with ``accents`` the Latin-1 letters of UTF-8 too."""
    out = LOWER[b]
    if accents and len(b) > 1:
        tail = b[1:]
        capital = (b[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        out[1:] += capital.astype(np.uint8) * np.uint8(32)
    return out


def hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans s..e of bytes b."""
    pw, inv = _tables(len(b) + 1)
    v = b.astype(U64)
    v += U64(1)
    v *= pw[:len(b)]
    total = np.empty(len(b) + 1, U64)
    total[0] = 0
    np.cumsum(v, out=total[1:])
    h = (total[e] - total[s]) * inv[s]
    h ^= (e - s).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = WORD,
          accents: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of all (lower-cased) words; and the first word of each document (n+1)."""
    starts, ends, keys = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = _cut(data, lo, n, is_word)
        b = data[lo:hi]
        w = is_word[b]
        first = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
        edge = np.zeros(len(b), dtype=bool)
        edge[0] = True
        edge[1:] = ~w[:-1]
        edge[first] = True
        s = np.flatnonzero(w & edge)
        edge[:-1] = ~w[1:]
        edge[-1] = True
        edge[first[first > 0] - 1] = True
        e = np.flatnonzero(w & edge) + 1
        starts.append(s + lo)
        ends.append(e + lo)
        keys.append(hashes(lowered(b, accents), s, e))
        lo = hi
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    starts, ends, keys = map(np.concatenate, (starts, ends, keys))
    return starts, ends, keys, np.searchsorted(starts, offsets)


def word_hash(word: str) -> int:
    """The hash that :func:`words` gives this (already lower-cased) word."""
    b = word.encode()
    h = 0
    for i, x in enumerate(b):
        h = (h + (x + 1) * pow(_P, i, 1 << 64)) & _M64
    h ^= (len(b) * 0xD6E8FEB86659FD93) & _M64
    return int(mix(np.array([h], U64))[0])


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each document (a shorter document is one run),
    and the first run of each document (n+1)."""
    n = np.diff(first)
    runs = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    at = np.concatenate([[0], np.cumsum(runs)])
    if not at[-1]:
        return np.zeros(0, U64), at
    begin = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], runs)
    last = np.repeat(first[1:], runs)
    out = np.full(at[-1], 0x2545F4914F6CDD1D, U64)
    for j in range(k):
        p = begin + j
        word = h[np.minimum(p, len(h) - 1)]
        out = np.where(p < last, (out ^ word) * U64(0x9FB21C651E98DF25) + (out >> U64(29)), out)
    return mix(out), at


def isin_sorted(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the sorted ``table`` and whether each value is there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return at, table[at] == values


class Positions:
    """A map from 64-bit hashes to positions 0, 1, ... in order of arrival, probed in bulk."""

    def __init__(self, bits: int = 16):
        self._clear(bits)

    def _clear(self, bits: int):
        self._shift, self.n = U64(64 - bits), 0
        self._key, self._at = np.zeros(1 << bits, U64), np.full(1 << bits, -1, np.int32)

    def __len__(self) -> int:
        return self.n

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is not there."""
        slot = (keys >> self._shift).astype(np.int64)
        out = self._at[slot]
        left = np.flatnonzero((out >= 0) & (self._key[slot] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self._key) - 1)
            at = self._at[slot[left]]
            out[left] = at
            left = left[(at >= 0) & (self._key[slot[left]] != keys[left])]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Append distinct keys that are not there."""
        if (self.n + len(keys)) * 2 > len(self._key):
            full = self._at >= 0
            old = self._key[full][np.argsort(self._at[full])]
            self._clear(int(2 * (self.n + len(keys))).bit_length() + 1)
            self.add(old)
        at = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        self.n += len(keys)
        slot = (keys >> self._shift).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self._at[slot[left]] < 0]
            self._at[slot[free]] = at[free]
            done = free[self._at[slot[free]] == at[free]]
            self._key[slot[done]] = keys[done]
            left = left[self._at[slot[left]] != at[left]]
            slot[left] = (slot[left] + 1) & (len(self._key) - 1)
