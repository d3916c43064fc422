"""Vocabulary training in batches of merges (B4 over whole texts, B7 over weighted words).

The corpus lies as written rows (order, weight, codes) in the shared folder. A round is one
Spark job: the driver predicts the next merges, the pairs that are most frequent now, and those
that come up as it carries on with the changes that the last round's dropped merges made;
every task applies them to its rows one after the other and reports, per merge, how the
pair counts change, which is summed over the tasks. The driver then replays the merges: as
long as the predicted pair is the best one by exact counts and the tie rule, it is learned; the
rest of the prediction is dropped. So the merges equal those of one-at-a-time training.

The driver holds the ``TRACKED`` most frequent pairs and pairs that came up since. All others
have at most the count ``floor``: a pair without a new code only ever loses occurrences, and
a new one is born with all of its own. When the best pair is no longer above the floor, the
pairs are counted anew. Rows are written again, merged so far, every ``REWRITE`` merges or ``ROUNDS``
rounds; nothing depends on executors' memory between jobs.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import merging as M
from ..functions import tokens as tk
from ..session import shared_path, ship

BATCH = 256
TRACKED = 1 << 16
REWRITE, ROUNDS = 256, 32
ROWS = "o long, n long, codes binary"


def _wide(codes: int) -> str:
    """The narrowest type that holds so many codes."""
    return "<u2" if codes <= 1 << 16 else "<u4"


def _load(batch: pa.RecordBatch, dtype: str):
    """(order, weight, codes, lengths) of an Arrow batch of rows."""
    data, off = M.text_bytes(batch.column("codes"))
    codes = np.frombuffer(data.tobytes(), dtype).astype(np.int32)
    return batch.column("o").to_numpy(zero_copy_only=False), batch.column("n").to_numpy(zero_copy_only=False), codes, np.diff(off) // np.dtype(dtype).itemsize


def _rows(o, n, codes: np.ndarray, lengths: np.ndarray, dtype: str) -> pa.RecordBatch:
    data = codes.astype(dtype)
    off = np.r_[0, np.cumsum(lengths * data.itemsize)].astype(np.int32)
    binary = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()), pa.array(n, pa.int64()), binary], names=["o", "n", "codes"])


def text_rows(df: DataFrame) -> DataFrame:
    """(o, n, text) rows as (o, n, codes of the text's bytes), where at least one pair is left."""
    ship(df.sparkSession)
    dtype = _wide(256)

    def run(batches):
        for b in batches:
            data, off = M.text_bytes(b.column("text"))
            o, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("o", "n"))
            for lo, hi, a, z in M.spans(np.diff(off), 16 * M.CHUNK):
                size = np.diff(off[lo:hi + 1])
                yield _rows(o[lo:hi], n[lo:hi], data[a:z], size, dtype)
    return df.select("o", "n", "text").where(F.octet_length("text") > 1).mapInArrow(run, ROWS)


class Trainer:
    """Learns merges over written rows."""

    def __init__(self, rows: DataFrame, first_seen: bool, batch: int = BATCH, tracked: int = TRACKED, rewrite: int = REWRITE):
        self._spark = rows.sparkSession
        self._first_seen, self._batch, self._tracked, self._rewrite = first_seen, batch, tracked, rewrite
        self.merges: list[tuple[int, int]] = []
        self.rounds = 0
        self._dtype = _wide(256)
        self._guess = 8.0
        self._dropped, self._dropped_from = [], 0   # (code, pair, pairs changed, by how much) of the last round's merges that were not learned
        self._keep(rows)

    # rows ---------------------------------------------------------------------------

    def _keep(self, rows: DataFrame):
        path = shared_path(self._spark, f"merged-{uuid.uuid4().hex}")
        rows.write.parquet(path)
        self._state = self._spark.read.parquet(path)
        self._written, self._since = len(self.merges), 0

    def _run(self, todo, schema: str, extra=()) -> DataFrame:
        """One pass over the rows, merged as far as learned, and by ``extra`` merges that are watched.
        todo gets (order, weights, codes, lengths, changes) of a chunk and yields Arrow batches."""
        merges, written, learned, dtype = [*self.merges, *extra], self._written, len(self.merges), self._dtype

        def run(batches):
            table = M.MergeTable(merges, written)
            for b in batches:
                order, weights, codes, lengths = _load(b, dtype)
                for lo, hi, a, z in M.spans(lengths):
                    size = lengths[lo:hi]
                    heavy = np.repeat(weights[lo:hi], size)
                    out, kept, changes = M.merge(codes[a:z], M.last_flags(size), table, learned, heavy)
                    count = np.r_[0, np.cumsum(kept)][np.r_[0, np.cumsum(size)]]
                    yield from todo(order[lo:hi], weights[lo:hi], out[kept], np.diff(count), changes)
        return self._state.mapInArrow(run, schema)

    def _write_again(self):
        dtype = _wide(tk.MERGE_BASE + len(self.merges) + 2 * self._rewrite)

        def todo(order, weights, codes, lengths, _):
            left = lengths > 1
            yield _rows(order[left], weights[left], codes[np.repeat(left, lengths)], lengths[left], dtype)
        rows = self._run(todo, ROWS)
        self._keep(rows)
        self._dtype = dtype

    # counts -------------------------------------------------------------------------

    def _count(self):
        """The most frequent pairs, counted anew."""
        def todo(order, weights, codes, lengths, _):
            at, key = _pairs(codes, lengths)
            key, n = M.sum_by(key, np.repeat(weights, lengths)[at])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["pair", "n"])
        counts = self._run(todo, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.orderBy(F.col("n").desc(), *_tie_columns()).limit(self._tracked + 1).toArrow()
        keys, n = (top.column(c).to_numpy() for c in ("pair", "n"))
        self._floor, self._edge = (int(n[-1]), int(_tie(keys[-1:])[0])) if len(n) > self._tracked else (0, 0)
        order = np.argsort(keys)
        self._keys, self._n = keys[order], n[order].astype(np.int64)

    def _earliest(self, tied: np.ndarray | None) -> int:
        """Of the most frequent pairs (``tied``, or all that are) the one seen first."""
        def todo(order, weights, codes, lengths, _):
            at, key = _pairs(codes, lengths)
            if tied is not None:
                own = np.isin(key, tied)
                at, key = at[own], key[own]
            word = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            by = np.lexsort((place[at], order[word[at]], key))
            key, at = key[by], at[by]
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key[edge]), pa.array(np.diff(np.r_[edge, len(key)])), pa.array(order[word[at[edge]]], pa.int64()),
                                              pa.array(place[at[edge]])], names=["pair", "n", "o", "place"])
        found = self._run(todo, "pair long, n long, o long, place long").groupBy("pair").agg(
            F.sum("n").alias("n"), F.min(F.struct("o", "place")).alias("first"))
        return found.orderBy(F.col("n").desc(), "first").first()["pair"]

    def _top(self) -> np.ndarray:
        """The tracked pairs that have the largest count."""
        if not len(self._n) or self._n.max() <= 0:
            return np.zeros(0, np.int64)
        return self._keys[self._n == self._n.max()]

    def _best(self, ask: bool) -> int | None:
        """The next pair to learn; None if the tracked counts don't tell. ``ask`` lets a job tell ties apart."""
        top = self._top()
        if not len(top):
            return None
        above = self._n.max() > self._floor
        if not self._first_seen:
            tie = _tie(top)
            # of pairs as frequent as the floor, those before the first one left out are all here
            sure = above or (self._n.max() == self._floor and tie.min() < self._edge)
            return int(top[np.argmin(tie)]) if sure else None
        if len(top) == 1 and above:
            return int(top[0])
        return self._earliest(top if above else None) if ask else None

    def _predict(self, best: int, n: int) -> list[int]:
        """The next n merges, should the merges dropped last round change the counts as they did there."""
        live = np.flatnonzero(self._n > 0)
        if len(live) > 4 * n:
            live = live[np.argpartition(-self._n[live], 4 * n)[:4 * n]]
        count = dict(zip(self._keys[live].tolist(), self._n[live].tolist()))
        least = min(count.values())
        heap = [(-c, t, k) for c, t, k in zip(count.values(), _tie(self._keys[live]).tolist(), count)]
        heap.append((-np.inf, 0, best))
        count[best] = np.inf
        heapq.heapify(heap)
        codes: dict[int, int] = {}
        place: dict[int, int] = {}
        out: list[int] = []

        def now(key: int) -> int | None:
            """A pair of the last round in the codes of this one; None where it has none yet."""
            pair = [codes.get(c) if c >= self._dropped_from else c for c in M.split_key(key)]
            return None if None in pair else M.pair_key(*pair)

        def look(code: int | None):
            """Where the dropped merges lie that hold ``code``, or no code of the last round."""
            for i, (_, pair, *_) in enumerate(self._dropped):
                if code is None or code in M.split_key(pair):
                    place[now(pair)] = i
        look(None)
        while heap and len(out) < n:
            c, _, key = heapq.heappop(heap)
            if count.get(key) != -c:
                continue
            count[key] = 0
            out.append(key)
            if key not in place:
                continue
            code, _, pairs, more = self._dropped[place[key]]
            codes[code] = tk.MERGE_BASE + len(self.merges) + len(out) - 1
            look(code)
            fresh = (pairs & ((1 << M.CODE_BITS) - 1) >= self._dropped_from) | (pairs >> M.CODE_BITS >= self._dropped_from)
            known = (more < 0) & (fresh | np.isin(pairs, self._keys[live])) | (more >= least)
            for old_pair, m in zip(pairs[known].tolist(), more[known].tolist()):
                pair = now(old_pair)
                was = count.get(pair, 0)
                if pair is None or pair in out or not was and m < least:
                    continue
                count[pair] = was + m
                if was + m > 0:
                    heapq.heappush(heap, (-was - m, int(_tie(np.array([pair]))[0]), pair))
        return out

    # learning -----------------------------------------------------------------------

    def learn(self, n: int) -> list[tuple[int, int]]:
        """Learn up to n merges in all; fewer if no pair is left."""
        if n <= len(self.merges):
            return self.merges
        self._count()
        while len(self.merges) < n:
            best = self._best(True)
            if best is None:
                self._count()
                best = self._best(True)
                if best is None:
                    break
            before = len(self.merges)
            # three times as many as were right of late: the rest tells the next round what to predict
            self._round(self._predict(best, min(self._batch, int(3 * self._guess) + 8, n - before)))
            self._guess = (self._guess + len(self.merges) - before) / 2
            if len(self.merges) - self._written >= self._rewrite or self._since >= ROUNDS:
                self._write_again()
        return self.merges

    def _round(self, predicted: list[int]):
        learned = len(self.merges)

        def todo(order, weights, codes, lengths, changes):
            for r, key, more in changes:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), r - learned), pa.int32()), pa.array(key), pa.array(more.astype(np.int64))],
                                                 names=["k", "pair", "more"])
        table = (self._run(todo, "k int, pair long, more long", map(M.split_key, predicted))
                 .groupBy("k", "pair").agg(F.sum("more").alias("more")).where("more <> 0").toArrow())
        k, key, more = (table.column(c).to_numpy() for c in ("k", "pair", "more"))
        new = np.setdiff1d(key, self._keys)
        keys = np.concatenate([self._keys, new])
        order = np.argsort(keys)
        self._keys, self._n = keys[order], np.concatenate([self._n, np.zeros(len(new), np.int64)])[order]
        by = np.argsort(k, kind="stable")
        key, more, edge = key[by], more[by], np.searchsorted(k[by], np.arange(len(predicted) + 1))
        for j, pair in enumerate(predicted):
            if j and self._best(False) != pair:
                break
            np.add.at(self._n, np.searchsorted(self._keys, key[edge[j]:edge[j + 1]]), more[edge[j]:edge[j + 1]])
            self.merges.append(M.split_key(pair))
        right = len(self.merges) - learned
        self._dropped_from = tk.MERGE_BASE + len(self.merges)
        self._dropped = [(tk.MERGE_BASE + learned + j, predicted[j], key[edge[j]:edge[j + 1]], more[edge[j]:edge[j + 1]])
                         for j in range(right, len(predicted))]
        live = self._n > 0
        self._keys, self._n = self._keys[live], self._n[live]
        self.rounds, self._since = self.rounds + 1, self._since + 1


def _pairs(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs begin, and the pairs."""
    at = np.flatnonzero(~M.last_flags(lengths))
    wide = codes.astype(np.int64)
    return at, M.pair_key(wide[at], wide[at + 1])


_BYTE_ORDER = np.array([b + 188 if b <= 32 else b - 33 if b <= 126 else b + 94 if b <= 160 else b - 67 if b <= 172 else 255 if b == 173 else b - 68
                        for b in range(256)])


def _tie(keys: np.ndarray) -> np.ndarray:
    """Order of equally frequent pairs: by the ids of the left, then of the right token."""
    def place(code):
        return np.where(code < 256, _BYTE_ORDER[np.minimum(code, 255)], code)
    return M.pair_key(place(keys >> M.CODE_BITS), place(keys & ((1 << M.CODE_BITS) - 1)))


def _tie_columns():
    left, right = F.shiftright("pair", M.CODE_BITS), F.col("pair").bitwiseAND(F.lit((1 << M.CODE_BITS) - 1))
    return [F.when(c < 256, tk.alphabet_rank(c)).otherwise(c) for c in (left, right)]


def written_parts(df: DataFrame, bytes_col: str) -> int:
    """Partitions for rows of that text, at about 16 MB each."""
    size = df.agg(F.sum(F.octet_length(bytes_col) + 16)).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, int(size >> 24) + 1)
