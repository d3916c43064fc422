"""Byte-pair merges on flat arrays of token codes, many words at a time.

Words (or whole texts) lie one behind the other in one array of codes; a flag marks the last
token of each. ``merge`` applies a table of merges in learned order. It keeps, per merge, the
positions where its pair stands, so every merge touches only those; a merge can only bring
forth pairs with its own new code, which are learned later, so one sweep over the merges in
order is enough. Work arrays are sized by the tokens handed in; callers hand in chunks.
"""

from __future__ import annotations

import ctypes
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .tokens import DIGITS, MERGE_BASE

CODE_BITS = 4 * DIGITS
NONE = np.iinfo(np.int32).max
CHUNK = 1 << 20


def pair_key(left, right):
    """One integer for a pair of codes."""
    return (left << CODE_BITS) | right


def split_key(key: int) -> tuple[int, int]:
    return int(key) >> CODE_BITS, int(key) & ((1 << CODE_BITS) - 1)


class MergeTable:
    """Merges in learned order: pair number r becomes the code ``MERGE_BASE + r``. Those before number
    ``first`` have been applied already: only later ones are looked for."""

    def __init__(self, pairs, first: int = 0):
        pairs = np.asarray(list(pairs), np.int64).reshape(-1, 2)
        self.left, self.right = pairs[:, 0].astype(np.int32), pairs[:, 1].astype(np.int32)
        self.keys, ranks = np.unique(pair_key(pairs[first:, 0], pairs[first:, 1]), return_index=True)
        self.ranks = ranks + first
        self.is_left, self.is_right = (np.zeros(1 << CODE_BITS, bool) for _ in range(2))
        self.is_left[self.left[first:]] = self.is_right[self.right[first:]] = True

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place in learned order of each pair; NONE where it was not learned."""
        out = np.full(len(left), NONE, np.int32)
        maybe = np.flatnonzero(self.is_left[left] & self.is_right[right])
        if len(maybe):
            key = pair_key(left[maybe].astype(np.int64), right[maybe].astype(np.int64))
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[maybe[hit]] = self.ranks[at[hit]]
        return out


def last_flags(lengths: np.ndarray) -> np.ndarray:
    """True at the last token of each word; words without tokens have none."""
    last = np.zeros(int(lengths.sum()), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    return last


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of equal neighbours (``aaa``) every second place, from the left."""
    new_run = np.r_[True, after[:-1] != at[1:]]
    k = np.arange(len(at))
    return (k - np.maximum.accumulate(np.where(new_run, k, 0))) % 2 == 0


def merge(codes: np.ndarray, last: np.ndarray, table: MergeTable, watch_from: int = NONE,
          weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list]:
    """(codes, kept, changes): the merged codes at their first positions, which positions are left,
    and for each merge from number ``watch_from`` on (rank, pairs, how many more there are),
    where a pair at a position counts ``weight`` of that position."""
    n = len(codes)
    codes = codes.astype(np.int32, copy=True)
    kept = np.ones(n, bool)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    after[last] = -1
    if n:
        before[np.r_[0, np.flatnonzero(last)[:-1] + 1]] = -1
    changes: list = []
    places: dict[int, list] = {}
    due: list[int] = []

    def put(at: np.ndarray, rank: np.ndarray):
        known = rank != NONE
        at, rank = at[known], rank[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        edge = np.r_[0, np.flatnonzero(rank[1:] != rank[:-1]) + 1, len(rank)]
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
            r = int(rank[lo])
            if r not in places:
                places[r] = []
                heapq.heappush(due, r)
            places[r].append(at[lo:hi])

    def around(at: np.ndarray, r: int, sign: int) -> tuple:
        """The pairs that begin at these positions, each once."""
        at = np.unique(at[at >= 0])
        at = at[after[at] >= 0]
        return pair_key(codes[at].astype(np.int64), codes[after[at]].astype(np.int64)), sign * (1 if weight is None else weight[at])

    start = np.flatnonzero(~last)
    put(start, table.ranks_of(codes[start], codes[start + 1]))
    while due:
        r = heapq.heappop(due)
        chunks = places.pop(r)
        at = chunks[0] if len(chunks) == 1 else np.unique(np.concatenate(chunks))
        at = at[kept[at] & (codes[at] == table.left[r])]
        nxt = after[at]
        good = (nxt >= 0) & (codes[nxt] == table.right[r])
        at, nxt = at[good], nxt[good]
        if not len(at):
            continue
        if table.left[r] == table.right[r]:
            apart = _apart(at, nxt)
            at, nxt = at[apart], nxt[apart]
        if r >= watch_from:
            old, less = around(np.concatenate([before[at], at, nxt]), r, -1)
        codes[at] = MERGE_BASE + r
        kept[nxt] = False
        beyond = after[nxt]
        after[at] = beyond
        before[beyond[beyond >= 0]] = at[beyond >= 0]
        if r >= watch_from:
            new, more = around(np.concatenate([before[at], at]), r, 1)
            changes.append((r, *sum_by(np.concatenate([old, new]), np.concatenate([np.broadcast_to(less, old.shape), np.broadcast_to(more, new.shape)]))))
        right = at[beyond >= 0]
        put(right, table.ranks_of(codes[right], codes[after[right]]))
        lead = before[at]
        lead = lead[lead >= 0]
        put(lead, table.ranks_of(codes[lead], codes[after[lead]]))
    return codes, kept, changes


def sum_by(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sum of the values of each."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[edge], np.add.reduceat(value[order], edge)


def merge_words(codes: np.ndarray, lengths: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """The merged codes of words that lie one behind the other, and the words' new lengths."""
    if not len(table.keys) or not len(codes):
        return codes.astype(np.int32), lengths
    out, sizes = [], []
    for lo, hi, a, z in spans(lengths):
        merged, kept, _ = merge(codes[a:z], last_flags(lengths[lo:hi]), table)
        count = np.r_[0, np.cumsum(kept)]
        edge = np.r_[0, np.cumsum(lengths[lo:hi])]
        out.append(merged[kept])
        sizes.append(np.diff(count[edge]))
    return np.concatenate(out), np.concatenate(sizes)


def spans(lengths: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, int, int]]:
    """(first word, beyond the last, first token, beyond the last) of runs of about ``limit`` tokens;
    a longer word is alone."""
    end = np.r_[0, np.cumsum(lengths)]
    lo, n = 0, len(lengths)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(end, end[lo] + limit, "right")) - 1))
        yield lo, hi, int(end[lo]), int(end[hi])
        lo = hi


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n+1) of a string or binary array; null counts as empty."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    _, off, data = col.buffers()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def gather(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of slices [at, at + size) one behind the other."""
    end = np.cumsum(size)
    return np.repeat(at - (end - size), size) + np.arange(end[-1] if len(end) else 0)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give this worker's freed memory back to the system; where the C library has no such call, it stays."""
    if _trim is not None:
        _trim(0)


def per_worker(build: Callable):
    """Keep what ``build`` makes for as long as the Python worker lives, one value per argument."""
    made: dict = {}

    def get(key):
        if key not in made:
            made.clear()
            made[key] = build(key)
        return made[key]
    return get
