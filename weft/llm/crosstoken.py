"""12. Cross-tokenizer alignment by sparse products of token-byte incidence matrices.

A text, with a space in front, is tokenized twice: A, a byte-level vocabulary, and B, a piece
vocabulary. Row i of the matrix A marks the bytes that A's token i covers, likewise B; both are
kept as hand-built CSR arrays. Gustavson's row-by-row product A B^T gives the overlap links:
token pairs and how many bytes they share. The byte offsets where tokens of both end cut
the text into groups; the product of the two group-incidence matrices gives the shared-group
links. Overlap links whose tokens end together are the links that are counted over the
corpus.

Products are formed in runs of rows with at most ``PRODUCTS`` terms, and whole texts are
batched to ``CHUNK`` bytes, so work arrays do not grow with the corpus.

How often an id pair is linked, corpus-wide, is summed in Spark and then broadcast: of two
tokens that end together one is a suffix of the other, so a pair is fixed by its longer token
and the shorter one's length. ``pair_bound`` counts the suffixes that are in the other
vocabulary; that bounds the table for any corpus (a few 100,000 rows with the files given).

Defined results: a null or empty text, or one whose joined A or B bytes differ from the space
and the text, has no tokens: zeros, and an empty ``groups_sha256``; repeated rows and null ids
count row by row; an empty table gives no rows; further columns are ignored. A text lies in
one row of a table, so its two lists of ids fit in memory.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.session import shared_path

from . import textvec as tv

CHUNK = 1 << 20
PRODUCTS = 1 << 20
_LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
OVERLAP = "doc_id long, a_at long, b_at long, a_id int, b_id int, shared_bytes long, together boolean"
GROUPS = "doc_id long, a_at long, b_at long, a_id int, b_id int, group long"


# --- the two vocabularies -----------------------------------------------------------------

def _byte_symbols() -> dict[str, int]:
    """Byte-level symbols: printable bytes stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(c): b for c, b in zip([*plain, *range(256, 256 + len(rest))], [*plain, *rest])}


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        symbols = _byte_symbols()
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a_bytes = [b""] * (max([*plain.values(), *special.values()]) + 1)
        for t, i in special.items():
            self.a_bytes[i] = t.encode()
        for t, i in plain.items():
            self.a_bytes[i] = bytes(map(symbols.__getitem__, t))
        # merges in the order of their ids: then a token's id is its rank, and the faster library gives the same ids
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in spec["model"]["merges"]]
        ranked = all(x < y for x, y in itertools.pairwise(plain[m] for m in merged))
        self._fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                       mergeable_ranks={self.a_bytes[i]: i for i in plain.values()}) if ranked else None
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        if len(self.a_bytes) * len(self.b_bytes) >= 1 << 32:
            raise ValueError("id pairs of these vocabularies do not fit in 32 bits")
        #: spelled[3 * id + k]: the id and the separator k
        self.spelled = [f"{i}{x}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for x in ",|;"]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self._fast is None:
            return [x.ids for x in self._a.encode_batch_fast(texts, add_special_tokens=False)]
        # a run without a word break costs the faster library the square of its length
        return [self._a.encode(t, add_special_tokens=False).ids if _LONG_RUN.search(t) else self._fast.encode_ordinary(t) for t in texts]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self._b.encode(texts, num_threads=1)

    def pair_bound(self) -> int:
        """How many id pairs can end together at all."""
        def count(longer, shorter, whole):
            n = {}
            for x in shorter:
                n[x] = n.get(x, 0) + 1
            return sum(n.get(x[k:], 0) for x in longer for k in range(0 if whole else 1, len(x)))
        return count(self.a_bytes, self.b_bytes, True) + count(self.b_bytes, self.a_bytes, False)


_vocabularies: dict[tuple, Vocabularies] = {}


def vocabularies(a_path: str | None = None, b_path: str | None = None) -> Vocabularies:
    """The Python worker's vocabularies for these files."""
    if (a_path, b_path) not in _vocabularies:
        _vocabularies[a_path, b_path] = Vocabularies(a_path, b_path)
    return _vocabularies[a_path, b_path]


# --- sparse matrices ----------------------------------------------------------------------

class Csr(NamedTuple):
    """A matrix of zeros and ones: the columns of row i are col[start[i]:start[i + 1]]."""

    start: np.ndarray
    col: np.ndarray
    width: int

    def transposed(self) -> "Csr":
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        order = np.argsort(self.col, kind="stable")
        return Csr(np.r_[0, np.cumsum(np.bincount(self.col, minlength=self.width))], row[order], len(self.start) - 1)


def intervals(sizes: np.ndarray) -> Csr:
    """Row i covers the sizes[i] columns that follow those of the rows before it."""
    start = np.r_[0, np.cumsum(sizes)]
    return Csr(start, np.arange(start[-1]), int(start[-1]))


def products(a: Csr, b: Csr, limit: int = PRODUCTS):
    """(row, column, value) of the product a b, in row order, for runs of rows.

    Row by row (Gustavson): the rows of b that row i of a names are gathered one behind the
    other, and equal columns are added up. A run has at most ``limit`` terms, or one row."""
    size = np.diff(b.start)[a.col]
    terms = np.r_[0, np.cumsum(size)][a.start]
    n, lo = len(a.start) - 1, 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(terms, terms[lo] + limit, "right")) - 1))
        names, part = a.col[a.start[lo]:a.start[hi]], size[a.start[lo]:a.start[hi]]
        row = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.start[lo:hi + 1])), part)
        end = np.cumsum(part)
        col = b.col[np.repeat(b.start[names] - (end - part), part) + np.arange(len(row))]
        key = row * b.width + col
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            key.sort()
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        yield key[edge] // b.width, key[edge] % b.width, np.diff(np.r_[edge, len(key)])
        lo = hi


class Alignment:
    """Both tokenizations of some texts, one behind the other."""

    def __init__(self, texts: list[bytes], v: Vocabularies):
        words = [t.decode("utf-8", "replace") for t in texts]
        full = [i for i, t in enumerate(texts) if t]
        a = dict(zip(full, v.encode_a([" " + words[i] for i in full])))
        b = dict(zip(full, v.encode_b([words[i] for i in full])))
        for i in full:
            want = b" " + texts[i]
            if b"".join(map(v.a_bytes.__getitem__, a[i])) != want or b"".join(map(v.b_bytes.__getitem__, b[i])) != want:
                a[i] = b[i] = []
        self.n_a = np.fromiter((len(a.get(i, ())) for i in range(len(texts))), np.int64, len(texts))
        self.n_b = np.fromiter((len(b.get(i, ())) for i in range(len(texts))), np.int64, len(texts))
        self.a = np.fromiter(itertools.chain.from_iterable(a.values()), np.int64, int(self.n_a.sum()))
        self.b = np.fromiter(itertools.chain.from_iterable(b.values()), np.int64, int(self.n_b.sum()))
        self.first_a, self.first_b = np.r_[0, np.cumsum(self.n_a)], np.r_[0, np.cumsum(self.n_b)]
        self._bytes_a, self._bytes_b = intervals(v.a_len[self.a]), intervals(v.b_len[self.b])
        end_a, end_b = self._bytes_a.start[1:], self._bytes_b.start[1:]
        self.ends = np.intersect1d(end_a, end_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(self.ends, end_a), np.searchsorted(self.ends, end_b)
        self.end_a, self.end_b = end_a, end_b

    def text_of_a(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_a, at, "right") - 1

    def overlaps(self):
        """(a, b, shared bytes) runs of A B^T: tokens that cover a common byte."""
        return products(self._bytes_a, self._bytes_b.transposed())

    def together(self) -> tuple[np.ndarray, np.ndarray]:
        """The overlap links whose tokens end together."""
        found = [(i[same], j[same]) for i, j, _ in self.overlaps() for same in [self.end_a[i] == self.end_b[j]]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    def members(self, group: np.ndarray) -> Csr:
        """Tokens by groups, as an incidence matrix."""
        return Csr(np.arange(len(group) + 1), group, len(self.ends))

    def shared_groups(self):
        """(a, b, 1) runs of the product of the group-incidence matrices."""
        return products(self.members(self.group_a), self.members(self.group_b).transposed())

    def spelled_groups(self, v: Vocabularies):
        """``a1,a2|b1;a3|b2,b3`` of each text, in order."""
        begin_a = np.searchsorted(self.group_a, np.arange(len(self.ends) + 1))
        begin_b = np.searchsorted(self.group_b, np.arange(len(self.ends) + 1))
        key = np.empty(len(self.a) + len(self.b), np.int64)
        key[np.arange(len(self.a)) + begin_b[self.group_a]] = 3 * self.a + (np.arange(len(self.a)) + 1 == begin_a[self.group_a + 1])
        key[np.arange(len(self.b)) + begin_a[self.group_b + 1]] = 3 * self.b + 2 * (np.arange(len(self.b)) + 1 == begin_b[self.group_b + 1])
        parts = list(map(v.spelled.__getitem__, key.tolist()))
        first = (self.first_a + self.first_b).tolist()
        for lo, hi in zip(first, first[1:]):
            yield "".join(parts[lo:hi])[:-1]


# --- Spark --------------------------------------------------------------------------------

def _alignments(batches, v: Vocabularies):
    """(doc_ids, Alignment) of runs of whole texts."""
    for b in batches:
        data, off = tv.utf8(b.column("text"))
        for lo, hi in tv.spans(off, CHUNK):
            texts = [data[off[i]:off[i + 1]].tobytes() for i in range(lo, hi)]
            yield b.column("doc_id").slice(lo, hi - lo), Alignment(texts, v)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: token, group and link counts, the groups' digest, and the id pairs of the links
    that end together (``a * |B| + b``, 32 bits little-endian). Paths name files on the executors."""
    def run(batches):
        v = vocabularies(a_path, b_path)
        for ids, x in _alignments(batches, v):
            i, j = x.together()
            pairs = (x.a[i] * len(v.b_bytes) + x.b[j]).astype("<u4")
            links = np.searchsorted(i, x.first_a)
            groups = np.searchsorted(x.ends, np.r_[0, x.end_a][x.first_a], "right")
            digest = [hashlib.sha256(s.encode()).hexdigest() if n else "" for n, s in zip(x.n_a.tolist(), x.spelled_groups(v))]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(x.n_a), pa.array(x.n_b), pa.array(np.diff(groups)), pa.array(np.diff(links)), pa.array(digest, pa.string()),
                 pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((links * 4).astype(np.int32).tobytes()), pa.py_buffer(pairs.tobytes())])],
                names=[c.split()[0] for c in ALIGNED.split(", ")])
    return _texts(docs).mapInArrow(run, ALIGNED)


def _link_rows(docs: DataFrame, schema: str, a_path, b_path, runs) -> DataFrame:
    def run(batches):
        v = vocabularies(a_path, b_path)
        for ids, x in _alignments(batches, v):
            for i, j, last in runs(x):
                text = x.text_of_a(i)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text)), pa.array(i - x.first_a[text]), pa.array(j - x.first_b[text]),
                     pa.array(x.a[i].astype(np.int32)), pa.array(x.b[j].astype(np.int32)), *last(text)],
                    names=[c.split()[0] for c in schema.split(", ")])
    return _texts(docs).mapInArrow(run, schema)


def overlap_links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per overlap link: token positions, ids, shared bytes, and whether they end together."""
    def runs(x):
        for i, j, n in x.overlaps():
            yield i, j, lambda text, i=i, j=j, n=n: (pa.array(n), pa.array(x.end_a[i] == x.end_b[j]))
    return _link_rows(docs, OVERLAP, a_path, b_path, runs)


def shared_group_links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per token pair of a common group: positions, ids, and the group's number in its text."""
    def runs(x):
        for i, j, _ in x.shared_groups():
            yield i, j, lambda text, i=i: (pa.array(x.group_a[i] - x.group_a[x.first_a[text]]),)
    return _link_rows(docs, GROUPS, a_path, b_path, runs)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents hold an id pair."""
    def run(batches):
        for b in batches:
            data, _ = tv.utf8(b.column("links"))
            pair, n = np.unique(np.frombuffer(data.tobytes(), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])
    return aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark: SparkSession = docs.sparkSession
    path = shared_path(spark, f"aligned-{uuid.uuid4().hex}")
    align(docs, a_path, b_path).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    v = vocabularies(a_path, b_path)
    width = len(v.b_bytes)
    table = pair_counts(aligned).toArrow()
    if table.num_rows > v.pair_bound():
        raise RuntimeError(f"{table.num_rows} linked id pairs; {v.pair_bound()} can be")
    pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(pair)
    pair, n = pair[order].astype("<u4"), n[order]
    top = np.zeros(width, np.int64)
    np.maximum.at(top, pair % width, n)
    shared = spark.sparkContext.broadcast((pair, n, n == top[pair % width]))

    def run(batches):
        pair, n, best = shared.value
        for b in batches:
            data, off = tv.utf8(b.column("links"))
            sums = np.zeros((2, b.num_rows), np.int64)
            for lo, hi in tv.spans(off, 4 * PRODUCTS):
                at = np.searchsorted(pair, np.frombuffer(data[off[lo]:off[hi]].tobytes(), "<u4"))
                edge = (off[lo:hi + 1] - off[lo]) // 4
                for k, x in enumerate((best, n)):
                    sums[k, lo:hi] = np.diff(np.r_[0, np.cumsum(x[at], dtype=np.int64)][edge])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in OUT[:5]), pa.array(sums[0]), pa.array(sums[1]), b.column("groups_sha256")], names=OUT)
    return aligned.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
