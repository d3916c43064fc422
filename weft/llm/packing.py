"""4. Packing by lexical retrieval: a sharded BM25 index fills a seed document's window.

A shard is a run of documents of one input partition, of ``SHARD_IDS`` ids or so; it is
tokenized, indexed and packed inside one task, without a shuffle, and its memory does not
depend on the corpus. Within a shard, each seed (the lowest unused document, or what is left
of one that was cut) queries the BM25 inverted index of subword ids with its ``QUERY`` ids of
largest weight; its best unused neighbours fill the window: those that fit, best first, then
the best of the others, cut to the rest of the window. What a cut leaves is the next seed.
When nothing unused is left, the last window is closed as sequences of falling powers of two,
which need no padding. So every sequence is full.

Defined results: null and empty texts are one id long (the closing id); every id of every
row lies in exactly one piece, longer documents lie in several; equal scores go to the
earlier row; repeated rows and null ids are packed row by row; an empty table gives no rows;
further columns are ignored. ``sequence_id`` is the partition's number times 2**32 plus the
sequence's number within it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subword

WINDOW, CLOSE, QUERY, NEIGHBOURS = 2048, 1, 24, 8
SHARD_IDS = 2_000_000
K1, B = 1.2, 0.75
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long")


class Index:
    """BM25 postings of the documents of one shard."""

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        n, size = len(first) - 1, np.diff(first)
        doc = np.repeat(np.arange(n), size)
        key = np.sort(ids.astype(np.int64) * n + doc)
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        tf = np.diff(np.r_[edge, len(key)])
        term, self.doc = key[edge] // n, key[edge] % n
        new = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[new, len(term)])
        self.ptr = np.r_[new, len(term)]
        idf = np.repeat(np.log(1 + (n - df + 0.5) / (df + 0.5)), df)
        self.weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.doc] / size.mean()))
        # the terms of largest weight of each document: its query
        of = np.repeat(np.arange(len(df)), df)
        order = np.lexsort((of, -self.weight, self.doc))
        begin = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.query = [of[order[a:min(z, a + QUERY)]] for a, z in zip(begin[:-1], begin[1:])]
        self.n = n

    def neighbours(self, doc: int, unused: np.ndarray) -> list[int]:
        """The unused documents of largest score, best first."""
        terms = self.query[doc]
        at = np.concatenate([np.arange(self.ptr[t], self.ptr[t + 1]) for t in terms])
        score = np.bincount(self.doc[at], self.weight[at], minlength=self.n)
        score[~unused] = 0
        best = np.argpartition(score, -NEIGHBOURS)[-NEIGHBOURS:] if self.n > NEIGHBOURS else np.arange(self.n)
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))].tolist()


def pack_shard(ids: np.ndarray, first: np.ndarray, window: int = WINDOW):
    """Sequences, each a list of (document, start, length), of one shard."""
    index, size = Index(ids, first), np.diff(first)
    unused, low, n = np.ones(len(size), bool), 0, len(size)
    rest: tuple[int, int] | None = None
    out: list[list[tuple[int, int, int]]] = []
    now: list[tuple[int, int, int]] = []
    room = window

    def put(doc: int, start: int):
        nonlocal room, rest, now
        take = min(room, int(size[doc]) - start)
        now.append((doc, start, take))
        room -= take
        rest = (doc, start + take) if start + take < size[doc] else None
        if not room:
            out.append(now)
            now, room = [], window

    while True:
        if rest:
            seed, start = rest
        else:
            while low < n and not unused[low]:
                low += 1
            if low == n:
                break
            seed, start = low, 0
            unused[seed] = False
        put(seed, start)
        while room < window and not rest:
            best = index.neighbours(seed, unused)
            if not best:
                break  # another seed goes on in this window
            whole = []
            for d in best:
                if size[d] <= room - sum(size[x] for x in whole):
                    whole.append(d)
            cut = [d for d in best if d not in whole]
            for d in whole + cut[:1]:
                if room == window:
                    break
                unused[d] = False
                put(d, 0)
    while now:  # the last window: falling powers of two
        left = 1 << (sum(x[2] for x in now).bit_length() - 1)
        part, keep = [], []
        for doc, start, length in now:
            take = min(left, length)
            if take:
                part.append((doc, start, take))
            if take < length:
                keep.append((doc, start + take, length - take))
            left -= take
        out.append(part)
        now = keep
    return out


def _run(path: str | None, window: int):
    def rows(shard, ids, first, number):
        size = np.diff(first)
        out: dict[str, list] = {k: [] for k in (x.split()[0] for x in SCHEMA.split(", "))}
        for seq in pack_shard(ids, first, window):
            at, total = 0, sum(x[2] for x in seq)
            for doc, start, length in seq:
                own = ids[first[doc] + start:first[doc] + start + length]
                for k, v in zip(out, (shard[doc], start, length, zlib.crc32(own.astype("<u4").tobytes()), int(size[doc]),
                                      number, at, total)):
                    out[k].append(v)
                at += length
            number += 1
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.int64()) for k in out])), number

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        shard: list = []
        parts: list[np.ndarray] = []
        held = 0
        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            for lo, hi, ids, first in subword.encode_column(b.column("text"), path):
                for i in range(hi - lo):
                    parts.append(np.append(ids[first[i]:first[i + 1]], np.int32(CLOSE)))
                    shard.append(doc_ids[lo + i])
                    held += len(parts[-1])
                    if held >= SHARD_IDS:
                        out, number = rows(shard, np.concatenate(parts), np.cumsum([0, *map(len, parts)]), number)
                        shard, parts, held = [], [], 0
                        yield out
        if shard:
            yield rows(shard, np.concatenate(parts), np.cumsum([0, *map(len, parts)]), number)[0]
    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents. ``path`` names the tokenizer file on the executors."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_run(path, window), SCHEMA)
