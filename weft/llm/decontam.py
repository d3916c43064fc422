"""5. Benchmark decontamination: BM25 inverted index of test items, block-max WAND.

The items are cut into segments of at most ``SEGMENT`` words and indexed in shards of a
bounded number of postings; document frequencies are counted over all items. A posting's
weight is its BM25 impact divided by its segment's own full score, so that a passage's
score is the share of the segment that it covers. Every document passage (``PASSAGE``
words, half overlapping) is a query: it is skipped if the sum of its words' largest
impacts stays below the threshold, its blocks of segments if the sum of their block
maxima does, and the rest are scored exactly. What reaches the threshold is verified: a
document is contaminated if five-word runs of both the question and the answer part of
the item stand around the passage. The answer is what follows the last ``?`` or
``answer:``; without one, the last quarter of the words.

Defined results: null or empty texts (of either table) match nothing; an item with fewer
than five words in a part compares that whole part; repeated items count once each and the
best match is the one of largest overlap, ties to the smaller item_id; rows of ``docs``
are judged one by one, so repeated rows and null ids keep their rows; an empty benchmark
contaminates nothing; further columns pass through unread.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path

from . import textvec as tv

SEGMENT, PASSAGE, BLOCK, RUN = 64, 128, 32, 5
K1, B = 1.2, 0.75
#: Postings of one shard; a shard's index is broadcast, about 40 bytes a posting.
SHARD_POSTINGS = 500_000
CHUNK = 1 << 20
#: Passages scored at once, their postings at most (one passage may have more); sums of bounds may be off by their rounding.
GROUP, POSTINGS, SLACK = 64, 1 << 22, 1e-9


def _segments(batches):
    for b in batches:
        texts = [t or "" for t in b.column("text").to_pylist()]
        data, off = tv.utf8(pa.array(texts, pa.string()))
        start, _, h, first = tv.words(data, off)
        ids = b.column("item_id").to_pylist()
        out = {k: [] for k in ("item_id", "item", "n_question", "part", "words")}
        for i, t in enumerate(texts):
            own = h[first[i]:first[i + 1]]
            if not len(own):
                continue
            low = t.lower()
            mark = max(low.rfind("?") + 1, (low.rfind("answer:") + 7) if "answer:" in low else 0)
            at = int(np.searchsorted(start[first[i]:first[i + 1]] - off[i], len(t[:mark].encode())))
            if not mark or not 0 < at < len(own):
                at = max(1, len(own) - max(1, len(own) // 4)) if len(own) > 1 else 1
            item = uuid.uuid5(uuid.NAMESPACE_OID, f"{ids[i]}\x00{t}").hex
            for k, lo in enumerate(range(0, len(own), SEGMENT)):
                for key, v in zip(out, (ids[i], item, at, k, own[lo:lo + SEGMENT].view(np.int64).tolist())):
                    out[key].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("item_id", pa.int64()), ("item", pa.string()), ("n_question", pa.int32()), ("part", pa.int32()),
             ("words", pa.list_(pa.int64()))]))


def shards_of(benchmark: DataFrame, shard_postings: int = SHARD_POSTINGS) -> Iterator[dict]:
    """The index of all items, shard by shard. Each is built by a task from a bounded number of
    postings and written; the driver reads one at a time, as it is asked for."""
    spark = benchmark.sparkSession
    base = shared_path(spark, f"decontam-{uuid.uuid4().hex}")
    (benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        _segments, "item_id long, item string, n_question int, part int, words array<long>")
        .dropDuplicates(["item", "part"]).write.parquet(f"{base}/segments"))
    seg = spark.read.parquet(f"{base}/segments")
    total = seg.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words")).first()
    if not total["n"]:
        return
    shards = -(-int(total["words"]) // shard_postings)
    seg = seg.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    terms = seg.select("shard", F.explode(F.array_distinct("words")).alias("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    n, avg = total["n"], total["words"] / total["n"]

    def index(rows: pa.Table, freq: pa.Table) -> pa.Table:
        made = _shard(rows.sort_by([("item", "ascending"), ("part", "ascending")]), freq, n, avg)
        return pa.table({"shard": rows.column("shard")[:1], "made": pa.array([pickle.dumps(made)], pa.binary())})
    freq = terms.distinct().withColumnRenamed("shard", "of").join(df, "term")
    (seg.groupBy("shard").cogroup(freq.groupBy("of")).applyInArrow(index, "shard long, made binary")
     .write.parquet(f"{base}/index"))
    for row in spark.read.parquet(f"{base}/index").select("made").toLocalIterator():  # a partition at a time
        yield pickle.loads(row["made"])


def build(benchmark: DataFrame, shard_postings: int = SHARD_POSTINGS) -> list[dict]:
    """All shards at once, for small benchmarks."""
    return list(shards_of(benchmark, shard_postings))


def _shard(rows: pa.Table, freq: pa.Table, n: int, avg: float) -> dict:
    words = [np.array(w, np.int64).view(np.uint64) for w in rows.column("words").to_pylist()]
    term = freq.column("term").to_numpy().view(np.uint64)
    order = np.argsort(term)
    term, df = term[order], freq.column("df").to_numpy()[order]
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    t, s, w = [], [], []
    for i, own in enumerate(words):
        u, tf = np.unique(own, return_counts=True)
        at = np.searchsorted(term, u)
        impact = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / avg))
        t.append(at)
        s.append(np.full(len(u), i))
        w.append(impact / impact.sum())
    t, s, w = np.concatenate(t), np.concatenate(s), np.concatenate(w)
    order = np.lexsort((s, t))
    t, s, w = t[order], s[order], w[order]
    edge = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (s[1:] // BLOCK != s[:-1] // BLOCK)])
    ids, keys, parts = (rows.column(c).to_pylist() for c in ("item_id", "item", "n_question"))
    first = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
    item_of = np.cumsum(np.r_[True, np.array(keys[1:], object) != np.array(keys[:-1], object)]) - 1
    items = []
    for a, b in zip(first, [*first[1:], len(keys)]):
        own = np.concatenate(words[a:b])
        cut = parts[a]
        items.append({"id": ids[a], "n": len(own), "question": _runs(own[:cut]), "answer": _runs(own[cut:] if cut < len(own) else own)})
    bits = np.zeros(1 << 18, bool)
    bits[(term >> np.uint64(46)).astype(np.int64)] = True
    return {"term": term, "bits": bits, "ptr": np.searchsorted(t, np.arange(len(term) + 1)), "seg": s, "w": w,
            "top": np.maximum.reduceat(w, np.searchsorted(t, np.arange(len(term)))),
            "bptr": np.searchsorted(t[edge], np.arange(len(term) + 1)), "block": s[edge] // BLOCK,
            "bmax": np.maximum.reduceat(w, edge), "n_seg": len(words), "item_of": item_of, "items": items}


def _runs(h: np.ndarray) -> np.ndarray:
    return np.unique(tv.shingles(h, np.array([0, len(h)]), RUN)[0])


def _take(ptr: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all terms one behind the other, and how many each has."""
    n = ptr[terms + 1] - ptr[terms]
    return np.repeat(ptr[terms] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def search(h: np.ndarray, first: np.ndarray, ix: dict, threshold: float):
    """(document, first word, last word, segment) of all passages over the threshold, and the number of passages."""
    hit = np.flatnonzero(ix["bits"][(h >> np.uint64(46)).astype(np.int64)])
    at, ok = tv.isin_sorted(h[hit], ix["term"])
    hit, at = hit[ok], at[ok]
    bound = np.zeros(len(h) + 1)
    bound[hit + 1] = ix["top"][at]
    np.cumsum(bound, out=bound)
    n = np.diff(first)
    step = PASSAGE // 2
    count = np.where(n == 0, 0, np.maximum(-(-(n - step) // step), 1))
    doc = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    lo = first[doc] + nth * step
    hi = np.minimum(lo + PASSAGE, first[doc + 1])
    found = []
    maybe = np.flatnonzero(bound[hi] - bound[lo] >= threshold - SLACK)
    begin = np.searchsorted(hit, lo[maybe])
    size = np.searchsorted(hit, hi[maybe]) - begin
    many = max(1, min(GROUP, POSTINGS // max(1, len(ix["seg"]))))
    for a in range(0, len(maybe), many):
        own, n = maybe[a:a + many], size[a:a + many]
        words = at[np.repeat(begin[a:a + many] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        found += [(doc[p], lo[p], hi[p], s) for p, s in _score(own, np.repeat(np.arange(len(own)), n), words, ix, threshold)]
    return found, count


def _score(own: np.ndarray, passage: np.ndarray, terms: np.ndarray, ix: dict, threshold: float):
    """(passage, segment) of all that reach the threshold; ``terms`` are the words of the passages, in their order."""
    n_block, n_term = (ix["n_seg"] - 1) // BLOCK + 1, len(ix["term"])
    passage, terms = np.divmod(_distinct(passage * n_term + terms), n_term)
    live = np.bincount(passage, ix["top"][terms], len(own)) >= threshold - SLACK
    passage, terms = (x[live[passage]] for x in (passage, terms))
    k, n = _take(ix["bptr"], terms)
    blocks = np.bincount(np.repeat(passage * n_block, n) + ix["block"][k], ix["bmax"][k], len(own) * n_block) >= threshold - SLACK
    live = blocks.reshape(len(own), n_block).any(1)
    passage, terms = (x[live[passage]] for x in (passage, terms))
    k, n = _take(ix["ptr"], terms)
    passage, seg = np.repeat(passage, n), ix["seg"][k]
    if n_block > 1:
        inside = blocks[passage * n_block + seg // BLOCK]
        passage, seg, k = passage[inside], seg[inside], k[inside]
    score = np.bincount(passage * ix["n_seg"] + seg, ix["w"][k])
    passage, seg = np.divmod(np.flatnonzero(score >= threshold), ix["n_seg"])
    return zip(own[passage], seg)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def judge(text, ix: dict, threshold: float, overlap: float):
    """Per text: passages, retrieved pairs, and the best item's id and overlaps (nan: none retrieved)."""
    n = len(text)
    passages, retrieved = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best: list[tuple | None] = [None] * n
    data, off = tv.utf8(text)
    for lo, hi in tv.spans(off, CHUNK):
        part = off[lo:hi + 1] - off[lo]
        _, _, h, first = tv.words(data[off[lo]:off[hi]], part)
        found, count = search(h, first, ix, threshold)
        passages[lo:hi] += count
        for d, a, b, s in found:
            item = ix["items"][ix["item_of"][s]]
            retrieved[lo + d] += 1
            own = _runs_of(h[max(first[d], a - item["n"]):min(first[d + 1], b + item["n"])], item)
            q, r = own
            key = _rank(min(q, r) >= overlap, q + r, item["id"])
            if best[lo + d] is None or key > best[lo + d][0]:
                best[lo + d] = (key, item["id"], q, r)
    return passages, retrieved, best


def _rank(contaminated: bool, overlap: float, item_id: int | None) -> tuple:
    """Order of matches: contaminated, then the larger overlap, then the smaller item_id, null last."""
    return contaminated, overlap, item_id is not None, -(item_id or 0)


def _runs_of(h: np.ndarray, item: dict) -> tuple[float, float]:
    out = []
    for part in ("question", "answer"):
        want = item[part]
        size = min(RUN, item["n"])
        have = tv.shingles(h, np.array([0, len(h)]), RUN)[0]
        if not np.isin(want, have).any() and len(want) == 1:
            have = np.concatenate([tv.shingles(h, np.array([0, len(h)]), k)[0] for k in range(1, size + 1)])
        out.append(float(np.isin(want, have).mean()))
    return out[0], out[1]


COLUMNS = "n_passages long, n_retrieved long, contaminated boolean, item_id long, question_overlap double, answer_overlap double"


def match(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.5) -> DataFrame:
    """doc_id with COLUMNS for every row of docs; shards are searched one after another in the same pass."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", *(
        F.lit(0 if c.endswith("long") and "item" not in c else False if "boolean" in c else None).cast(c.split()[1])
        .alias(c.split()[0]) for c in COLUMNS.split(", ")))
    for ix in shards_of(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(ix)

        def run(batches, shared=shared):
            for b in batches:
                old = b.to_pydict()
                passages, retrieved, best = judge(b.column("text"), shared.value, threshold, overlap)
                old["n_passages"] = np.maximum(passages, old["n_passages"])
                old["n_retrieved"] = retrieved + np.array(old["n_retrieved"], np.int64)
                for i, x in enumerate(best):
                    was = old["question_overlap"][i]
                    if x and (was is None or x[0] > _rank(old["contaminated"][i], was + old["answer_overlap"][i], old["item_id"][i])):
                        old["contaminated"][i] = x[0][0]
                        old["item_id"][i], old["question_overlap"][i], old["answer_overlap"][i] = x[1:]
                yield pa.RecordBatch.from_pydict(old, schema=b.schema)
        rows = rows.mapInArrow(run, rows.schema)
    return rows.drop("text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item."""
    for ix in shards_of(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(ix)

        def run(batches, shared=shared):
            for b in batches:
                best = judge(b.column("text"), shared.value, threshold, overlap)[2]
                yield b.filter(pa.array([not (x and x[0][0]) for x in best], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
