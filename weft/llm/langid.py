"""1. Language identification by error-correcting output codes.

Every learned language gets a codeword of +1/-1. For each code bit a binary n-gram
classifier (naive-Bayes log odds over byte trigrams, languages weighted alike) tells the
+1 languages from the -1 ones; a text's margin for a bit is the mean log odds of its
trigrams. Loss-weighted decoding sums, per language, the logistic loss of the margins
against its codeword, weighted by each bit's reliability, and takes the least.

Trigrams are counted over all training rows in one Spark job (map-side sums, then a
``groupBy``); the model has ``languages x 64**3`` entries at most, whatever the corpus.

Defined results: null text or text without a letter gives ``und`` with score 0; with no
training rows every text is ``und``; rows with null ``lang`` are not learned from; equal
losses go to the language first in sort order; repeated rows and repeated or null ids are
scored row by row (a null id counts as not held out); an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .names import numbered

GRAMS = 1 << 18
CHUNK = 1 << 20

#: Byte classes: 0 for anything that is no letter, 1-26 for a-z, 27-63 for bytes over 127.
CLASSES = np.zeros(256, np.int32)
CLASSES[65:91] = CLASSES[97:123] = np.arange(1, 27)
CLASSES[128:] = 27 + np.arange(128) % 37


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One trigram per byte (the byte in the middle); beyond a text's ends stands class 0."""
    c = CLASSES[data]
    prev = np.empty_like(c)
    prev[0], prev[1:] = 0, c[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    prev[first] = 0
    nxt = np.empty_like(c)
    nxt[-1], nxt[:-1] = 0, c[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    nxt[last] = 0
    return (prev << 12) | (c << 6) | nxt


def _pieces(col):
    """(document range, bytes, offsets) of bounded size; a long text comes in several."""
    data, off = tv.utf8(col)
    for lo, hi in tv.spans(off, CHUNK):
        for a in range(int(off[lo]), int(off[hi]), CHUNK) if hi - lo == 1 else [int(off[lo])]:
            b = min(int(off[hi]), a + CHUNK) if hi - lo == 1 else int(off[hi])
            if b > a:
                yield lo, hi, data[a:b], np.array([0, b - a]) if hi - lo == 1 else off[lo:hi + 1] - a


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lo, hi, data, off in _pieces(batch.column("text")):
            g, size = _grams(data, off), np.diff(off)
            for name in set(langs[lo:hi]):
                one = g[np.repeat(langs[lo:hi] == name, size)]
                sums[name] = sums.get(name, 0) + np.bincount(one, minlength=GRAMS)
    for name, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
            names=["lang", "gram", "n"])


def codewords(n: int) -> np.ndarray:
    """A (languages x bits) matrix of +1/-1: all columns for few languages, else drawn ones."""
    if n <= 5:
        cols = [[1 if i == 0 or (b >> (i - 1)) & 1 else -1 for i in range(n)] for b in range(2 ** max(n - 1, 0) - 1)]
        return np.array(cols, np.float64).reshape(len(cols), n).T
    rng, bits = np.random.default_rng(11), 6 * math.ceil(math.log2(n))
    draws = [np.where(rng.random((n, bits)) < 0.5, -1.0, 1.0) for _ in range(64)]
    draws = [d for d in draws if (abs(d.sum(0)) < n).all()]
    return max(draws, key=lambda d: (bits - (d @ d.T - 2 * bits * np.eye(n)).max()))


def fit(docs: DataFrame) -> dict:
    """Model from all rows (lang, text) with non-null lang."""
    rows = (docs.select("lang", "text").where(F.col("lang").isNotNull() & (F.col("lang") != "und"))
            .mapInArrow(_count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(rows.column("lang").to_pylist()))
    at = {x: i for i, x in enumerate(names)}
    n = np.zeros((len(names), GRAMS))
    n[[at[x] for x in rows.column("lang").to_pylist()], rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    n[:, 0] = 0
    p = (n + 0.5) / (n.sum(1, keepdims=True) + 0.5 * GRAMS)
    code = codewords(len(names))
    w = np.zeros((GRAMS, code.shape[1]), np.float32)
    alpha = np.ones(code.shape[1])
    for b in range(code.shape[1]):
        plus, minus = p[code[:, b] > 0].mean(0), p[code[:, b] < 0].mean(0)
        odds = np.log(plus / minus)
        odds[n.sum(0) == 0] = 0
        w[:, b] = odds
        seen = n / np.maximum(n.sum(1, keepdims=True), 1)
        alpha[b] = max(1e-3, float((code[:, b] * (seen @ odds)).min()))
    return {"names": names, "code": code, "w": w, "alpha": alpha / alpha.sum() if len(alpha) else alpha}


def decode(margins: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best and second language, and the best one's share (0 to 1), of (rows x bits) margins."""
    code, n = model["code"], len(model["names"])
    z = margins[:, None, :] * code[None, :, :]
    loss = (np.logaddexp(0, -4 * z) * model["alpha"]).sum(2)
    order = np.argsort(loss, axis=1, kind="stable")
    share = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
    share = 1 / share.sum(1)
    return order[:, 0], order[:, min(1, n - 1)], share


def scores(text, has_letter, model: dict, ambiguous_below: float):
    """Arrow arrays lang_pred, score, runner_up, ambiguous of one batch."""
    n, bits = len(text), model["w"].shape[1]
    names = model["names"]
    letter = np.array(has_letter.fill_null(False).to_numpy(zero_copy_only=False), bool)
    if not names:
        letter[:] = False
    best = second = np.zeros(n, np.int64)
    share = np.ones(n)
    if len(names) > 1:
        total, count = np.zeros((n, bits)), np.zeros(n)
        for lo, hi, data, off in _pieces(text):
            g = _grams(data, off)
            full = np.flatnonzero(np.diff(off)) + lo
            at = off[:-1][np.diff(off) > 0]
            for b in range(bits):
                total[full, b] += np.add.reduceat(model["w"][:, b][g], at, dtype=np.float64)
            count[full] += np.add.reduceat((g != 0).astype(np.int64), at)
        best, second, share = decode(total / np.maximum(count, 1)[:, None], model)
    pred = [names[b] if ok else "und" for b, ok in zip(best, letter)]
    runner = [names[b] if ok and len(names) > 1 else None for b, ok in zip(second, letter)]
    share = np.where(letter, share, 0.0)
    return [pa.array(pred, pa.string()), pa.array(share), pa.array(runner, pa.string()),
            pa.array(letter & (share < ambiguous_below))]


def keep_known(docs: DataFrame, model: dict, ambiguous_below: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose language is neither ``und`` nor ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, back = numbered(docs, "text")

    def run(batches):
        for b in batches:
            pred, _, _, unsure = scores(b.column("text"), b.column("__letter"), shared.value, ambiguous_below)
            good = pa.compute.and_(pa.compute.not_equal(pred, "und"), pa.compute.invert(unsure))
            yield b.drop_columns(["__letter"]).filter(good)
    return back(rows.withColumn("__letter", F.col("text").rlike(r"\p{L}")).mapInArrow(run, rows.schema))


def predict(docs: DataFrame, model: dict, ambiguous_below: float = 0.5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, runner_up, ambiguous of every row of docs.

    The broadcast model holds 64**3 weights for each code bit (about 7 MB for four
    languages), whatever the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            out = scores(b.column("text"), b.column("letter"), shared.value, ambiguous_below)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *out],
                                             names=["doc_id", "held_out", "lang_pred", "score", "runner_up", "ambiguous"])
    rows = docs.select("doc_id", held_out("doc_id", 4), F.col("text"),
                       F.col("text").rlike(r"\p{L}").alias("letter"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, "
                                "runner_up string, ambiguous boolean")


def held_out(col: str, mod: int):
    """Whether crc32 of the id as text leaves 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % mod == 2, F.lit(False)).alias("held_out")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    return predict(docs, fit(docs.where(~held_out("doc_id", 4))))
