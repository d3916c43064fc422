"""Byte-pair vocabulary training and corpus tokenization.

Texts are cut into specials and words in the JVM; merging is done on flat arrays of codes, a
whole Arrow batch at a time (:mod:`weft.functions.merging`), in :mod:`weft.operators.training` for
training and here for encoding. Between operators, tokens travel as the fixed-width code
text of :mod:`weft.functions.tokens`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import merging as M
from ..functions import tokens as tk
from ..session import shared_path, ship, ship_active
from . import training

PAIR_WIDTH = 2 * tk.TOKEN_WIDTH
SLICE = 1 << 19  # bytes, ids or words that a task works on at once; a longer row is alone


@dataclass(frozen=True)
class Vocab:
    """A byte-pair vocabulary: merges in learned order, as internal codes."""

    merges: tuple = ()
    layout: str = "production"          # "production" (specials + alphabet) or "teaching"
    specials: tuple = field(default=tk.ALL_SPECIAL_TOKENS)
    presplit: bool = True               # production vocabularies never merge across words

    def __post_init__(self):
        if len(self.merges) > tk.MAX_MERGES:
            raise ValueError(f"{len(self.merges)} merges; codes leave room for {tk.MAX_MERGES}")

    @property
    def n_special(self) -> int:
        return len(self.specials) if self.layout == "production" else 0

    @property
    def size(self) -> int:
        return self.n_special + 256 + len(self.merges)

    def special_id(self, token: str) -> int:
        return self.specials.index(token)

    @property
    def bos_id(self) -> int:
        return self.special_id(tk.BOS)

    @property
    def eos_id(self) -> int:
        return self.special_id(tk.EOS)

    @property
    def pad_id(self) -> int:
        return self.special_id(tk.PAD)

    def token_bytes(self) -> list[bytes]:
        """The bytes of every token, by id (a special token's spelling)."""
        codes = [bytes([b]) for b in range(256)]
        for a, b in self.merges:
            codes.append(codes[a] + codes[b])
        if self.layout == "teaching":
            return codes
        order = np.argsort(training._BYTE_ORDER).tolist()
        return [s.encode("utf-8") for s in self.specials] + [codes[b] for b in order] + codes[256:]

    def merge_strings(self) -> tuple[str, str]:
        pairs = "".join(tk.pair_text(a, b) for a, b in self.merges)
        return pairs, "".join(tk.code_hex(tk.MERGE_BASE + r) for r in range(len(self.merges)))


BYTE_VOCAB = Vocab()
TEACHING_VOCAB = Vocab(layout="teaching", specials=(), presplit=False)


# --- B1 / B3 / B5 / B6: column expressions ------------------------------------

def byte_ids(text: Column) -> Column:
    """B1: text -> ARRAY<INT> of UTF-8 byte values 0..255."""
    return tk.codes_array(tk.utf8_codes(text))


def ids_to_codes(ids: Column) -> Column:
    """ARRAY<INT> of internal codes -> code text."""
    return F.array_join(F.transform(ids, lambda x: F.concat(F.lit(" "), F.lpad(F.hex(x), tk.DIGITS, "0"))), "")


def _merge_arrays(vocab: Vocab) -> tuple[Column, Column]:
    """(pairs, new codes) as constant arrays (constant-folded once, O(1) element access)."""
    pairs, news = vocab.merge_strings()
    m = len(vocab.merges)
    p = F.split(F.lit(",".join(pairs[i * PAIR_WIDTH:(i + 1) * PAIR_WIDTH] for i in range(m))), ",")
    n = F.split(F.lit(",".join(news[i * tk.TOKEN_WIDTH:(i + 1) * tk.TOKEN_WIDTH] for i in range(m))), ",")
    return p, n


def apply_merges(code_text: Column, vocab: Vocab) -> Column:
    """Apply every merge once, in learned order (B5 on a code text)."""
    if not vocab.merges:
        return code_text
    p, n = _merge_arrays(vocab)
    return F.aggregate(F.arrays_zip(p.alias("p"), n.alias("n")), code_text,
                       lambda acc, x: F.replace(acc, x["p"], x["n"]))


def merge_pair(ids: Column, left: int, right: int, new_id: int) -> Column:
    """Replace a pair left to right, without overlaps."""
    merged = F.replace(ids_to_codes(ids), F.lit(tk.pair_text(left, right)), F.lit(tk.code_hex(new_id)))
    return tk.codes_array(merged)


def merge_codes(codes: Column, left: int, right: int, new_id: int) -> Column:
    """B3 on code text (no array round trip): one left-to-right, non-overlapping replace."""
    return F.replace(codes, F.lit(tk.pair_text(left, right)), F.lit(tk.code_hex(new_id)))


def teaching_encode(text: Column, vocab: Vocab) -> Column:
    """Bytes of the whole text, then every merge in learned order; null gives null."""
    return _ids_udf(vocab)(F.encode(text, "UTF-8"))


def _ids_udf(vocab: Vocab):
    """Bytes -> ids of the whole text, all merges in one sweep."""
    ship_active()
    pairs, layout, n_special = vocab.merges, vocab.layout, vocab.n_special

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in _sliced(batches, pc.binary_length):
            data, off = M.text_bytes(texts)
            codes, lengths = M.merge_words(data, np.diff(off), _tables(pairs))
            yield _list_array(_ids_of(codes, layout, n_special), lengths, pc.is_null(texts).to_numpy(zero_copy_only=False))
    return encode


def teaching_decode(ids: Column, vocab: Vocab) -> Column:
    """The bytes of all ids, then UTF-8 (NULL where invalid, or where an id is unknown)."""
    raw = _bytes_udf(vocab, False, True)(ids).cast("string")
    return F.when(F.is_valid_utf8(raw), raw)


def _bytes_udf(vocab: Vocab, skip_special_tokens: bool, strict: bool):
    """Ids -> bytes, gathered from one table; unknown ids make the row NULL if strict, else are left out."""
    ship_active()
    table = vocab.token_bytes()
    if skip_special_tokens:
        table = [b""] * vocab.n_special + table[vocab.n_special:]

    @F.arrow_udf(T.BinaryType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        at, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), np.uint8)
        for lists in _sliced(batches, pc.list_value_length):
            ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            row = np.r_[0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))]
            known = (ids >= 0) & (ids < len(table))
            ids = np.where(known, ids, 0)
            size = np.where(known, sizes[ids], 0)
            off = np.r_[0, np.cumsum(size)][row]
            bad = np.diff(np.r_[0, np.cumsum(~known)][row]) > 0 if strict else np.zeros(len(lists), bool)
            yield _var_array(pa.binary(), off, data[M.gather(at[ids], size)].tobytes(), bad | pc.is_null(lists).to_numpy(zero_copy_only=False))
    return decode


# --- Arrow buffers ---------------------------------------------------------------

_tables = M.per_worker(M.MergeTable)


def _sliced(batches: Iterator[pa.Array], length) -> Iterator[pa.Array]:
    """The rows of all batches in slices of about ``SLICE``, so that work arrays don't grow with a batch."""
    for b in batches:
        for lo, hi, _, _ in M.spans(length(b).fill_null(0).to_numpy(zero_copy_only=False), SLICE):
            yield b.slice(lo, hi - lo)
        M.release()


def _mask(null: np.ndarray):
    return pa.py_buffer(np.packbits(~null, bitorder="little").tobytes()) if null.any() else None


def _var_array(kind, off: np.ndarray, data: bytes, null: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(off) - 1, [_mask(null), pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(data)])


def _list_array(ids: np.ndarray, lengths: np.ndarray, null: np.ndarray) -> pa.Array:
    off = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.Array.from_buffers(pa.list_(pa.int32()), len(lengths), [_mask(null), pa.py_buffer(off.tobytes())], children=[pa.array(ids.astype(np.int32))])


def _ids_of(codes: np.ndarray, layout: str, n_special: int) -> np.ndarray:
    """Internal codes -> ids of the layout."""
    if layout == "teaching":
        return codes
    ids = codes + (n_special + 256 - tk.MERGE_BASE)
    byte = codes < 256
    ids[byte] = training._BYTE_ORDER[codes[byte]] + n_special
    return np.where(codes >= tk.SPECIAL_BASE, codes - tk.SPECIAL_BASE, ids)


# --- B2 / B4: pair counting and whole-text training ----------------------------

PAIR_RE = f"( [0-9A-F]{{{tk.DIGITS}}} [0-9A-F]{{{tk.DIGITS}}})"


def pair_table(df: DataFrame, codes_col: str, weight: Column | None = None,
               keep_position: bool = False, key_cols: list[str] | None = None) -> DataFrame:
    """Explode every adjacent pair (overlaps counted) of a code-text column. Linear and
    JVM-native: one regex pass takes the even-aligned pairs, a second pass on the text
    shifted by one token takes the odd-aligned ones (each token is exactly six
    characters and only tokens start with a space, so matches stay aligned)."""
    c = F.col(codes_col)
    even = F.regexp_extract_all(c, F.lit(PAIR_RE), 1)
    odd = F.regexp_extract_all(F.substr(c, F.lit(tk.TOKEN_WIDTH + 1)), F.lit(PAIR_RE), 1)
    cols = [F.col(k) for k in (key_cols or [])]
    w = (weight if weight is not None else F.lit(1)).cast("bigint").alias("w")
    base = df.where(F.length(c) >= PAIR_WIDTH)
    if not keep_position:
        return base.select(*cols, w, F.explode(F.concat(even, odd)).alias("pair"))
    tagged = F.concat(F.transform(even, lambda p, i: F.struct(p.alias("pair"), (2 * i).alias("pos"))),
                      F.transform(odd, lambda p, i: F.struct(p.alias("pair"), (2 * i + 1).alias("pos"))))
    return base.select(*cols, w, F.explode(tagged).alias("_p")).select(
        *[F.col(k) for k in (key_cols or [])], "w", F.col("_p.pair").alias("pair"), F.col("_p.pos").alias("pos"))


def pair_counts(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """B2: adjacent-pair counts over all ARRAY<INT> sequences -> (left, right, count)."""
    return pair_counts_codes(df.select(ids_to_codes(F.col(ids_col)).alias("c")), "c")


def pair_counts_codes(df: DataFrame, codes_col: str) -> DataFrame:
    """B2 on code text: explode pairs, map-side partial counts, one shuffle by pair."""
    pairs = pair_table(df, codes_col)
    agg = pairs.groupBy("pair").agg(F.sum("w").alias("count"))
    left, right = _pair_codes(F.col("pair"))
    return agg.select(left.alias("left"), right.alias("right"),
                      F.col("count").cast("bigint").alias("count"))


def _pair_codes(pair: Column) -> tuple[Column, Column]:
    def code(at: int) -> Column:
        return F.conv(F.substring(pair, at, tk.DIGITS), 16, 10).cast("int")
    return code(2), code(tk.TOKEN_WIDTH + 2)


def _parse_pair(pair: str) -> tuple[int, int]:
    left, right = pair.split()
    return int(left, 16), int(right, 16)


def train_teaching(df: DataFrame, text_col: str, order_col: str, vocab_size: int, **sizes) -> Vocab:
    """Merges over whole texts (no pre-split); ids from 256; ties go to the pair seen
    first in scan order (text order, then position); stops early when no pair is left."""
    n = max(0, vocab_size - 256)
    if not n:
        return TEACHING_VOCAB
    rows = df.select(F.col(order_col).cast("long").alias("o"), F.lit(1).cast("long").alias("n"), F.col(text_col).alias("text"))
    rows = training.text_rows(rows.repartition(training.written_parts(rows, "text")))
    return Vocab(tuple(training.Trainer(rows, True, **sizes).learn(n)), "teaching", (), False)


# --- B7 / B8: production vocabulary --------------------------------------------

def special_pieces(text: Column, specials=tk.ALL_SPECIAL_TOKENS) -> Column:
    """Cut a text into special tokens and the ordinary runs between them, in order
    (longest special first). Linear: mark specials with NUL, split, drop empties. A text
    that holds NUL itself is escaped first (``\\u0001a`` for ``\\u0001``, ``\\u0001b`` for NUL) and
    its pieces are restored."""
    one, nul = F.lit("\u0001"), F.lit("\u0000")

    def cut(t: Column) -> Column:
        marked = F.regexp_replace(t, f"({tk.specials_alternation(specials)})", "\u0000$1\u0000")
        return F.filter(F.split(marked, "\u0000"), lambda p: p != "")
    escaped = F.replace(F.replace(text, one, F.lit("\u0001a")), nul, F.lit("\u0001b"))
    restored = F.transform(cut(escaped), lambda p: F.replace(F.replace(p, F.lit("\u0001b"), nul), F.lit("\u0001a"), one))
    return F.when(F.contains(text, nul), restored).otherwise(cut(text))


def presplit_words(text: Column) -> Column:
    """Byte-level pre-split of ordinary text into words."""
    return F.regexp_extract_all(text, F.lit(tk.PRESPLIT_PATTERN), 0)


def word_histogram(df: DataFrame, text_col: str, specials=tk.ALL_SPECIAL_TOKENS) -> DataFrame:
    """(word, count): the distributed step of vocabulary training (map-side combined)."""
    smap = tk.special_code_text(specials)
    pieces = df.select(F.explode(special_pieces(F.col(text_col), specials)).alias("p"))
    words = (pieces.where(F.try_element_at(smap, F.col("p")).isNull())
             .select(F.explode(presplit_words(F.col("p"))).alias("word")))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def train_production(df: DataFrame, text_col: str, vocab_size: int = 6400,
                     specials=tk.ALL_SPECIAL_TOKENS, **sizes) -> Vocab:
    """Specials first, the 256-symbol alphabet, then merges over the weighted word
    table until ``vocab_size``. Ties: higher count, then smaller (left id, right id)."""
    specials = tuple(specials)
    n = max(0, vocab_size - len(specials) - 256)
    if not n:
        return Vocab(specials=specials)
    spark = df.sparkSession
    path = shared_path(spark, f"words-{uuid.uuid4().hex}")
    word_histogram(df, text_col, specials).write.parquet(path)
    words = spark.read.parquet(path).select(F.lit(0).cast("long").alias("o"), F.col("count").alias("n"), F.col("word").alias("text"))
    rows = training.text_rows(words.repartition(training.written_parts(words, "text"), "text"))
    return Vocab(tuple(training.Trainer(rows, False, **sizes).learn(n)), specials=specials)


# --- B10 / B11 / B12: corpus tokenization --------------------------------------

def encode_inline(text: Column, vocab: Vocab) -> Column:
    """Code text of a text without any shuffle. Exact when the vocabulary has no merges
    (byte vocabulary) or does not pre-split; with merges + pre-split use encode_corpus."""
    if vocab.layout == "production":
        smap = tk.special_code_text(vocab.specials)
        pieces = special_pieces(text, vocab.specials)
        if vocab.merges:
            raise ValueError("production vocabularies with merges need encode_corpus()")
        coded = F.transform(pieces, lambda p: F.coalesce(F.try_element_at(smap, p), tk.utf8_codes(p)))
        return F.array_join(coded, "")
    return apply_merges(tk.utf8_codes(text), vocab)


def word_codes(word: str, vocab: Vocab) -> str:
    """Code text of one pre-split word."""
    raw = np.frombuffer(word.encode("utf-8"), np.uint8)
    codes, _ = M.merge_words(raw, np.array([len(raw)]), M.MergeTable(vocab.merges))
    return "".join(map(tk.code_hex, codes.tolist()))


class _WordCache:
    """Codes of the words a Python worker has met, up to ``LIMIT`` of them."""

    LIMIT, BYTES = 1 << 19, 32 << 20

    def __init__(self, vocab: Vocab):
        self.table, self.specials = M.MergeTable(vocab.merges), vocab.specials
        self.clear()

    def clear(self):
        n = len(self.specials)
        self.words = pa.array(self.specials, pa.string())
        self.at, self.size = np.arange(n), np.ones(n, np.int64)
        self.codes = np.arange(tk.SPECIAL_BASE, tk.SPECIAL_BASE + n, dtype=np.int32)

    def encode(self, lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Codes of all words of some rows, and how many there are in each row; slice by slice."""
        if not len(self.table.keys):
            row = np.r_[0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))]
            size = pc.binary_length(lists.flatten()).fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, _, _ in M.spans(np.diff(np.r_[0, np.cumsum(size, dtype=np.int64)][row]), SLICE):
                yield self._bytes(lists.slice(lo, hi - lo).flatten(), row[lo:hi + 1] - row[lo])
            return
        met = lists.flatten().dictionary_encode()
        words = met.dictionary.cast(pa.string())
        found = pc.index_in(words, value_set=self.words)
        if found.null_count and (len(self.words) + found.null_count > self.LIMIT or self.words.nbytes > self.BYTES):
            self.clear()
            found = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(found))
        if len(new):
            data, off = M.text_bytes(new)
            codes, size = M.merge_words(data, np.diff(off), self.table)
            at = len(self.codes) + np.cumsum(size) - size
            place = found.to_numpy(zero_copy_only=False).copy()
            place[np.isnan(place)] = np.arange(len(self.words), len(self.words) + len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.at, self.size, self.codes = np.r_[self.at, at], np.r_[self.size, size], np.r_[self.codes, codes]
        else:
            place = found.to_numpy(zero_copy_only=False)
        place, indices = place.astype(np.int64), met.indices
        for lo, hi, a, z in M.spans(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), SLICE):
            word = place[indices[a:z].to_numpy(zero_copy_only=False)]
            row = np.r_[0, np.cumsum(pc.list_value_length(lists.slice(lo, hi - lo)).fill_null(0).to_numpy(zero_copy_only=False))]
            size = self.size[word]
            yield self.codes[M.gather(self.at[word], size)], np.diff(np.r_[0, np.cumsum(size)][row])

    def _bytes(self, pieces: pa.Array, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without merges: a special is one token, any other piece its bytes."""
        data, off = M.text_bytes(pieces)
        special = pc.index_in(pieces, value_set=pa.array(self.specials, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
        size = np.where(special >= 0, 1, np.diff(off))
        codes = data[M.gather(off[:-1], size)].astype(np.int32)
        whole = special >= 0
        codes[(np.cumsum(size) - size)[whole]] = tk.SPECIAL_BASE + special[whole]
        return codes, np.diff(np.r_[0, np.cumsum(size)][row])


_caches = M.per_worker(_WordCache)
_HEX = np.frombuffer(b"0123456789ABCDEF", np.uint8)


def _words(text: Column, vocab: Vocab) -> Column:
    if not vocab.merges:
        return special_pieces(text, vocab.specials)
    special = F.array(*map(F.lit, vocab.specials)).cast("array<string>")
    return F.flatten(F.transform(special_pieces(text, vocab.specials), lambda p: F.when(
        F.array_contains(special, p), F.array(p)).otherwise(presplit_words(p))))


def _codes_udf(vocab: Vocab):
    @F.arrow_udf(T.StringType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            for codes, lengths in _caches(vocab).encode(lists):
                text = np.full((len(codes), tk.TOKEN_WIDTH), 32, np.uint8)
                for k in range(tk.DIGITS):
                    text[:, 1 + k] = _HEX[(codes >> (4 * (tk.DIGITS - 1 - k))) & 15]
                yield _var_array(pa.string(), np.r_[0, np.cumsum(lengths)] * tk.TOKEN_WIDTH, text.tobytes(), np.zeros(len(lengths), bool))
            M.release()
    return encode


def _word_ids_udf(vocab: Vocab):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            for codes, lengths in _caches(vocab).encode(lists):
                yield _list_array(_ids_of(codes, vocab.layout, vocab.n_special), lengths, np.zeros(len(lengths), bool))
            M.release()
    return encode


def encode_corpus(df: DataFrame, text_col: str, vocab: Vocab, out_col: str = "codes") -> DataFrame:
    """Tokenize a corpus, row by row: every row keeps its columns, whatever its key. The
    text is cut into specials and words in the JVM; a distinct word is merged once per worker.
    No shuffle, so no hot word either. A null text has no codes."""
    if not vocab.merges or not vocab.presplit:
        return df.withColumn(out_col, F.coalesce(encode_inline(F.col(text_col), vocab), F.lit("")))
    ship(df.sparkSession)
    return df.withColumn(out_col, _codes_udf(vocab)(_words(F.col(text_col), vocab)))


def encode_ids(df: DataFrame, text_col: str, vocab: Vocab, out_col: str = "ids") -> DataFrame:
    """B10 straight to ids (ARRAY<INT>, in the vocabulary's layout)."""
    if not vocab.presplit or vocab.layout != "production":
        return df.withColumn(out_col, F.coalesce(teaching_encode(F.col(text_col), vocab), F.array().cast("array<int>")))
    ship(df.sparkSession)
    return df.withColumn(out_col, _word_ids_udf(vocab)(_words(F.col(text_col), vocab)))


def ids_of(codes: Column, vocab: Vocab) -> Column:
    return tk.codes_to_ids(codes, vocab.layout, vocab.n_special)


def truncate_if(codes: Column, max_length: int | None, truncation: bool | None = None) -> Column:
    """Truncate when max_length is set and truncation is None or true."""
    if max_length is not None and (truncation or truncation is None):
        return tk.truncate_codes(codes, max_length)
    return codes


def wrap_bos_eos(ids: Column, text: Column, vocab: Vocab, add_special_tokens: bool) -> Column:
    """Optional BOS/EOS; non-string (NULL) input gives an empty list."""
    body = F.concat(F.array(F.lit(vocab.bos_id)), ids, F.array(F.lit(vocab.eos_id))) \
        if add_special_tokens else ids
    return F.when(text.isNull(), F.array().cast("array<int>")).otherwise(body)


# --- B6 / B13: decoding -----------------------------------------------------------

def id_to_code(i: Column, vocab: Vocab) -> Column:
    if vocab.layout == "teaching":
        return i
    n_sp = vocab.n_special
    r = i - n_sp
    byte = (F.when(r <= 93, r + 33).when(r <= 105, r + 67).when(r <= 187, r + 68)
            .when(r <= 220, r - 188).when(r <= 254, r - 94).otherwise(F.lit(173)))
    return (F.when(i < n_sp, i + tk.SPECIAL_BASE)
            .when(i < n_sp + 256, byte)
            .otherwise(i - (n_sp + 256) + tk.MERGE_BASE))


def decode_ids(ids: Column, vocab: Vocab, skip_special_tokens: bool = True) -> Column:
    """Ids -> text; specials dropped by default, else rendered by their spelling.
    Production decoding is lossy like the byte-level decoder (bad bytes -> U+FFFD)."""
    if vocab.layout == "teaching":
        return teaching_decode(ids, vocab)
    return F.make_valid_utf8(_bytes_udf(vocab, skip_special_tokens, False)(ids).cast("string"))


# --- B9 / A8: the vocabulary as tables ---------------------------------------------

def byte_symbol(b: Column) -> Column:
    """The byte-level symbol (a one-character string) standing for byte b."""
    cp = F.when((b >= 33) & (b <= 126), b).when((b >= 161) & (b <= 172), b) \
        .when(b >= 174, b).otherwise(F.lit(256) + tk.alphabet_rank(b) - 188)
    return F.decode(F.unhex(F.lpad(F.hex(cp), 4, "0")), "UTF-16BE")


def merges_table(spark: SparkSession, vocab: Vocab) -> DataFrame:
    rows = [(r, a, b) for r, (a, b) in enumerate(vocab.merges)]
    schema = "rank INT, left INT, right INT"
    return spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)


def vocab_table(spark: SparkSession, vocab: Vocab) -> DataFrame:
    """(token, id, is_special). Merge tokens are spelled by expanding to bytes."""
    n_sp = vocab.n_special
    specials = spark.createDataFrame([(s, i, True) for i, s in enumerate(vocab.specials)],
                                     "token STRING, id INT, is_special BOOLEAN") if n_sp else None
    spelled = spark.createDataFrame([(i, list(t)) for i, t in enumerate(vocab.token_bytes()[n_sp:], n_sp)], "id INT, bytes ARRAY<INT>")
    out = spelled.select(F.array_join(F.transform("bytes", byte_symbol), "").alias("token"), "id", F.lit(False).alias("is_special"))
    return specials.unionByName(out) if specials is not None else out


def save_vocab(spark: SparkSession, vocab: Vocab, path: str) -> None:
    """Write ``merges`` and ``vocab`` parquet tables under a directory."""
    merges_table(spark, vocab).coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "/merges")
    vocab_table(spark, vocab).coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "/vocab")


def load_vocab(spark: SparkSession, path: str) -> Vocab:
    """Accepts the directory or its ``merges`` table path. The merges table is
    bounded by the vocabulary size, so the driver may hold it."""
    base = path.rstrip("/")
    if base.endswith("/merges") or base.endswith("/vocab"):
        base = base.rsplit("/", 1)[0]
    merges = spark.read.parquet(base + "/merges").orderBy("rank").collect()
    vocab = spark.read.parquet(base + "/vocab")
    specials = [r["token"] for r in vocab.where("is_special").orderBy("id").collect()]
    layout = "production" if specials else "teaching"
    return Vocab(merges=tuple((r["left"], r["right"]) for r in merges), layout=layout,
                 specials=tuple(specials), presplit=layout == "production")


def tokenizer_json(vocab: Vocab) -> str:
    """The vocabulary in the common JSON format of byte-level tokenizers."""
    if vocab.layout != "production":
        raise ValueError("only vocabularies with pre-split have this format")
    symbol = _symbols()
    spelled = [*vocab.specials, *("".join(map(symbol.__getitem__, t)) for t in vocab.token_bytes()[vocab.n_special:])]
    parts = [None] * 256
    for i, t in enumerate(vocab.token_bytes()[vocab.n_special:vocab.n_special + 256]):
        parts[t[0]] = spelled[vocab.n_special + i]
    parts += spelled[vocab.n_special + 256:]
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "normalizer": None, "pre_tokenizer": level, "post_processor": None,
        "added_tokens": [{"id": i, "content": t, **flags} for i, t in enumerate(vocab.specials)], "decoder": level,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": {t: i for i, t in enumerate(spelled)},
                  "merges": [[parts[a], parts[b]] for a, b in vocab.merges]}}, ensure_ascii=False)


def vocab_of_json(text: str) -> Vocab:
    """A vocabulary from that format. Ids must be laid out as here: specials, the 256 byte
    symbols in code-point order, then the merges in order; anything else is refused."""
    spec = json.loads(text)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("not a byte-level vocabulary without normalizer and prefix space")
    specials = tuple(t["content"] for t in sorted(spec["added_tokens"], key=lambda t: t["id"]))
    code = {s: b for b, s in enumerate(_symbols())}
    merges = []
    for m in model["merges"]:
        left, right = m if isinstance(m, list) else m.split(" ")
        merges.append((code[left], code[right]))
        code[left + right] = tk.MERGE_BASE + len(merges) - 1
    vocab = Vocab(tuple(merges), specials=specials)
    if json.loads(tokenizer_json(vocab))["model"]["vocab"] != {**{t["content"]: t["id"] for t in spec["added_tokens"]}, **model["vocab"]}:
        raise ValueError("the ids are laid out in another way")
    return vocab


def _symbols() -> list[str]:
    """The byte-level symbol of every byte: printable ones stand for themselves, the others follow from 256."""
    other = iter(range(256, 512))
    return [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(other)) for b in range(256)]


def save_tokenizer_file(spark: SparkSession, vocab: Vocab, path: str) -> None:
    """Write the JSON as the one text file of a folder."""
    spark.createDataFrame([(tokenizer_json(vocab),)], "value STRING").coalesce(1).write.text(path)


def load_tokenizer_file(spark: SparkSession, path: str) -> Vocab:
    """Read it from a folder as written here, or from a single ``tokenizer.json``, indented or not."""
    files = spark.read.text(path, wholetext=True).collect()  # one row of vocabulary size
    if len(files) != 1:
        raise ValueError(f"{len(files)} files in {path}")
    return vocab_of_json(files[0]["value"])


def compression_report(df: DataFrame, group_col: str, text_col: str, codes_col: str) -> DataFrame:
    """Tokens per character (and characters per token) per group, counted on code text."""
    return df.groupBy(group_col).agg(
        F.sum(tk.n_tokens(F.col(codes_col))).cast("bigint").alias("n_tokens"),
        F.sum(F.length(text_col)).cast("bigint").alias("n_chars"),
    ).select(group_col, "n_tokens", "n_chars",
             F.round(F.col("n_tokens") / F.col("n_chars"), 6).alias("tokens_per_char"),
             F.round(F.col("n_chars") / F.col("n_tokens"), 6).alias("chars_per_token"))

