"""7. Quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

The model counts runs of ``ORDER`` bytes (lower-cased, digits alike, padded at a text's
start, closed by an end symbol). Counts, continuation counts, the three discounts of each
order and the interpolation weights are tables grouped and joined in Spark, sharded by
their keys. Documents ask these tables block by block (see ``blocks``) and get their
cross-entropy per byte and perplexity. A document is accepted up to a fence above its
language's quantiles: the upper quartile plus ``FENCE`` quartile ranges of the trusted
documents that the model has not seen, within the document's class of length (where too
few of them are, of the language, else of all, with a range widened for short texts, whose
means scatter more).

Trusted rows: quality 1 and not toxic; of all these, four fifths (by id hash) to count, one
fifth to set the fences.

Defined results: null and empty texts are scored as their end symbol alone; without trusted
rows nothing is rejected and the model is uniform; null ``lang`` is a language of its own;
every row is scored by itself, so repeated rows and null ids keep their rows; equal to the
fence is accepted; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path

from . import blocks, marks, textvec as tv
from .names import numbered

ORDER, FENCE, ENOUGH, SHORT = 5, 6.0, 30, 400
CHUNK = 1 << 20
BEGIN, END = 1, 2
SYMBOLS = tv.LOWER.copy()
SYMBOLS[:32] = 32
SYMBOLS[48:58] = 48


def _grams(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of ``order`` symbols (first symbol highest), and each text's first one (n+1)."""
    n = np.diff(off)
    pad = order - 1
    seq = np.full(len(data) + len(n) * (pad + 1), BEGIN, np.uint8)
    own = np.ones(len(seq), bool)
    sym, p = SYMBOLS[data], 0
    for a, b in zip(off[:-1], off[1:]):
        own[p:p + pad] = False
        p += pad
        seq[p:p + b - a] = sym[a:b]
        p += b - a
        seq[p] = END
        p += 1
    key = seq.astype(np.uint64)
    for k in range(1, order):
        key[k:] |= seq[:-k].astype(np.uint64) << np.uint64(8 * k)
    return key[own], np.concatenate([[0], np.cumsum(n + 1)])


def _texts(col):
    """(range of texts, bytes, offsets) of bounded size."""
    data, off = tv.utf8(col)
    for lo, hi in tv.spans(off, CHUNK):
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[edge], np.diff(np.r_[edge, len(keys)])


def _count(order: int):
    def run(batches):
        keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(sums)], names=["gram", "n"])
        for b in batches:
            for _, _, data, off in _texts(b.column("text")):
                k, n = _distinct(_grams(data, off, order)[0])
                both, back = np.r_[keys, k], np.r_[sums, n]
                at = np.argsort(both, kind="stable")
                both, back = both[at], back[at]
                edge = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
                keys, sums = both[edge], np.add.reduceat(back, edge)
                if len(keys) > 2_000_000:
                    yield out()
                    keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            tv.release()
        yield out()
    return run


def levels(counts: DataFrame, order: int, base: str) -> list[dict]:
    """Per order from 1: its discounts, its contexts (ctx, gamma), and (gram, p), the interpolated
    probability of every counted run's last symbol. Each order's tables are written under ``base`` before
    the next is built from them, so no plan holds more than one order."""
    spark = counts.sparkSession

    def written(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        low = F.col("gram").bitwiseAND((1 << (8 * k)) - 1).alias("gram")
        tables[k] = written(tables[k + 1].groupBy(low).agg(F.count("*").alias("n")), f"counts{k}")
    out: list[dict] = []
    for k in range(1, order + 1):
        t = tables[k]
        n1, n2, n3, n4 = t.agg(*(F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4))).first()
        d = [0.0, 0.0, 0.0]
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
        d = [min(max(x, 0.1), i + 0.9) for i, x in enumerate(d)]
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        rows = t.select("gram", F.shiftright("gram", 8).alias("ctx"), "n", cut.alias("cut"))
        contexts = written(rows.groupBy("ctx").agg(F.sum("n").cast("double").alias("total"), F.sum("cut").alias("cuts"))
                           .select("ctx", "total", (F.col("cuts") / F.col("total")).alias("gamma")), f"contexts{k}")
        rows = rows.join(contexts, "ctx")
        below = F.lit(1 / 256)
        if out:
            rows = rows.withColumn("low", F.col("gram").bitwiseAND((1 << (8 * (k - 1))) - 1))
            rows = rows.join(out[-1]["seen"].select(F.col("gram").alias("low"), F.col("p").alias("below")), "low")
            below = F.col("below")
        seen = rows.select("gram", ((F.col("n") - F.col("cut")) / F.col("total") + F.col("gamma") * below).alias("p"))
        out.append({"discounts": d, "contexts": contexts.select("ctx", "gamma"), "seen": written(seen, f"seen{k}")})
    return out


def probabilities(keys: DataFrame, model: list[dict]) -> DataFrame:
    """(gram, logp) of all keys: natural log of the interpolated probability of the last symbol. Each
    key looks up its counted ends and their contexts, so the keys are read once."""
    p = F.lit(1 / 256)
    rows = keys
    for k, level in enumerate(model, 1):
        table = level["seen"]
        end = F.col("gram").bitwiseAND((1 << (8 * k)) - 1)
        rows = rows.withColumn("end", end).join(table.select(F.col("gram").alias("end"), F.col("p").alias(f"p{k}")), "end", "left").drop("end")
        rows = rows.withColumn("ctx", F.shiftright(end, 8)).join(
            level["contexts"].select("ctx", F.col("gamma").alias(f"g{k}")), "ctx", "left").drop("ctx")
        p = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"g{k}"), F.lit(1.0)) * p)
    return rows.select("gram", F.log(p).alias("logp"))


def _ask(order: int):
    def run(rows: pa.Table) -> pa.Table:
        keys = np.zeros(0, np.uint64)
        for b in blocks.unpack(rows):
            for _, _, data, off in _texts(b.column("text")):
                keys = _distinct(np.r_[keys, _distinct(_grams(data, off, order)[0])[0]])[0]
        block = rows.column("block")[0].as_py()
        tv.release()
        return pa.table({"block": pa.array(np.full(len(keys), block, np.int32)), "gram": pa.array(keys.astype(np.int64))})
    return run


def _answer(order: int, schema: pa.Schema):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        gram = answers.column("gram").to_numpy().astype(np.uint64)
        at = np.argsort(gram)
        gram, logp = gram[at], answers.column("logp").to_numpy()[at]
        out = []
        for b in blocks.unpack(rows):
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for lo, hi, data, off in _texts(b.column("text")):
                g, first = _grams(data, off, order)
                total[lo:hi] = np.add.reduceat(logp[np.searchsorted(gram, g)], first[:-1])
                n[lo:hi] = np.diff(first)
            out.append(pa.Table.from_arrays([*(b.column(c) for c in schema.names[:-3]), pa.array(n), pa.array(total / np.log(10)), pa.array(np.exp(-total / n))],
                                            schema=schema))
        del gram, logp, at
        tv.release()
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (__id, text) of docs whose id may be one of ``ids`` (__id): all that are, and of the others those
    whose hash shares a mark with one, about one in 16 (more where the ids fill the marks). A join
    after it moves these texts, not all."""
    bits = marks.size(ids.count())
    slot = F.pmod(F.xxhash64("__id"), F.lit(bits))
    runs = (ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", marks.RUN).alias("run"))
            .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND((1 << marks.RUN) - 1)).alias("bits")).toArrow())
    shared = docs.sparkSession.sparkContext.broadcast(marks.together(runs, bits))

    def run(batches):
        for b in batches:
            yield b.select(["__id", "text"]).filter(pa.array(marks.found(shared.value, b.column("slot").to_numpy())))
    return docs.where("__id is not null").select("__id", "text", slot.alias("slot")).mapInArrow(run, "__id long, text string")


SCORES = "__n long, __logp double, __ppl double"


def score(docs: DataFrame, labels: DataFrame, keep: list[str], order: int = ORDER, trusted: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The columns ``keep`` of docs (doc_id and lang among them), with __n, __logp (base 10) and __ppl, written to the
    shared folder; and the ids of all trusted documents that were not counted.

    Four fifths of the trusted documents (with ``trusted``, of so many at most) are counted; all others set the fences."""
    spark = docs.sparkSession
    base = shared_path(spark, f"kneserney-{uuid.uuid4().hex}")
    (labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
     .select(F.col("doc_id").cast("long").alias("__id")).distinct().write.parquet(f"{base}/trusted"))
    good = spark.read.parquet(f"{base}/trusted")

    def in_four_fifths(doc_id):
        return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0
    counted = good if trusted is None else good.orderBy(F.xxhash64("__id"), "__id").limit(trusted)
    counted.where(in_four_fifths(F.col("__id"))).write.parquet(f"{base}/counted")
    counted = spark.read.parquet(f"{base}/counted")
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").where(in_four_fifths(F.col("__id")))
    (likely(texts, counted).join(counted, "__id", "left_semi").select("text").mapInArrow(_count(order), "gram long, n long")
     .groupBy("gram").agg(F.sum("n").alias("n")).write.parquet(f"{base}/counts"))
    model = levels(spark.read.parquet(f"{base}/counts"), order, base)
    rows, _ = blocks.pack(docs.select(*dict.fromkeys([*keep, "doc_id", "text"])))
    asked = rows.groupBy("block").applyInArrow(_ask(order), "block int, gram long")
    table = probabilities(asked.select("gram").distinct(), model)
    answers = asked.join(table, "gram").select("block", "gram", "logp")
    full = docs.select(*keep, *(F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in SCORES.split(", "))).limit(0)
    rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answer(order, full.toArrow().schema), full.schema) \
        .write.parquet(f"{base}/scores")
    return spark.read.parquet(f"{base}/scores"), good.join(counted, "__id", "left_anti")


def fences(scored: DataFrame, trusted: DataFrame, fence: float = FENCE, enough: int = ENOUGH) -> DataFrame:
    """scored with __limit, the largest perplexity accepted (null: all), by the quantiles of all ``trusted`` ids."""
    bits, size = F.log2("__ppl"), F.floor(F.log2(F.col("__n").cast("double")) / 2)
    scored = scored.withColumn("__bits", bits).withColumn("__size", size).withColumn("__lang", F.coalesce("lang", F.lit("")))
    q = F.percentile_approx("__bits", F.array(F.lit(0.25), F.lit(0.75)), F.lit(10000)).alias("q")
    narrow = scored.select(F.col("doc_id").cast("long").alias("__id"), "__bits", "__size", "__lang")
    good = narrow.join(trusted, "__id", "left_semi")

    def limits(keys: list[str], name: str) -> DataFrame:
        t = good.groupBy(*keys).agg(q, F.count("*").alias("c")).where(F.col("c") >= enough)
        return F.broadcast(t.select(*keys, F.col("q")[1].alias(name), F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(0.02)).alias(f"{name}_range")))
    # one row per language and class of length, each of ``enough`` documents: broadcast, as the rows may hold their texts
    rows = (scored.join(limits(["__lang", "__size"], "__a"), ["__lang", "__size"], "left")
            .join(limits(["__lang"], "__b"), "__lang", "left"))
    every = good.agg(q, F.count("*").alias("c")).first()
    top, spread = (every["q"][1], max(every["q"][1] - every["q"][0], 0.02)) if every["c"] > 1 else (None, None)
    wide = fence * F.sqrt(F.greatest(F.lit(1.0), F.lit(float(SHORT)) / F.col("__n")))
    limit = F.coalesce(F.col("__a") + fence * F.col("__a_range"), F.col("__b") + wide * F.col("__b_range"),
                       F.lit(top).cast("double") + wide * F.lit(spread).cast("double"))
    return rows.withColumn("__limit", F.pow(F.lit(2.0), limit)).drop(
        "__a", "__b", "__a_range", "__b_range", "__bits", "__size", "__lang")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_symbols, log10_prob, perplexity, threshold, accepted of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    rows = fences(*score(docs.select("doc_id", "lang", "text"), labels, ["doc_id", "lang"]))
    return rows.select("doc_id", "lang", F.col("__n").alias("n_symbols"), F.col("__logp").alias("log10_prob"),
                       F.col("__ppl").alias("perplexity"), F.col("__limit").alias("threshold"),
                       (F.col("__limit").isNull() | (F.col("__ppl") <= F.col("__limit"))).alias("accepted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The accepted rows of docs, all columns."""
    rows, back = numbered(docs, "doc_id", "lang", "text")
    rows = fences(*score(rows, labels, rows.columns))
    return back(rows.where(F.col("__limit").isNull() | (F.col("__ppl") <= F.col("__limit"))))
