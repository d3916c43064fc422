"""8. Near-duplicates by Order MinHash, verified by banded alignment.

A text is its sequence of lower-cased words; k-mers are runs of five words, labelled by
their occurrence within the text. Each of ``BANDS`` sketches takes the ``TAKE`` labelled
k-mers of least hash and keeps them in text order; texts that share a sketch are
candidates. Texts of at most ``FEW`` k-mers get exact keys besides: a pair of similarity
``least`` or more has in common one of the sequences that are left when each drops as many
k-mers as its own size permits. Texts of the same words are folded into one node first.

Candidates are compared in steps. First every node of a bucket with the bucket's two extreme
nodes (stars). Then, in buckets that still hold several components, with a further centre, the
node that meets most others in its buckets (the original, in a family of edited copies), and
with a centre of what is still apart from it, a few rounds long. Last, in what then remains mixed, the
pairs across components that can still reach the similarity given what each node shares with
the bucket's centre: those that share further k-mers, or whose shares with the centre suffice, as far as bitmaps
of what each lacks of the centre and has beyond it leave room for enough common k-mers. K-mers that no node of
another component than the centre's has, or no second node, are known by a bitmap and never become rows.
So a bucket of copies costs a number of pairs in proportion to its size, and no pair is left out.

A pair is verified by the longest common subsequence of its k-mers within the band that
a similarity of ``SIMILARITY`` allows: ``lcs / (na + nb - lcs)``. Linked nodes form classes.

Defined results: a text without words is a copy of texts of the same bytes; null, empty or
blank texts are each alone; fewer than five words are one k-mer; the class id is the least
doc_id of the class, ties and repeated rows share it (null only if all its ids are null);
an empty table gives no rows; further columns are ignored (kept by ``keep_one``).
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path

from . import marks, textvec as tv
from .components import components
from .names import numbered

BANDS, TAKE, RUN, SIMILARITY = 20, 5, 5, 0.8
FEW = 12
CHUNK = 1 << 18
#: Rounds of further centres; ids that may be broadcast to pick their k-mers, of 8 bytes each.
ROUNDS, PICKED = 4, 1_000_000
#: Words of 64 bits in the bitmaps of what a node lacks of its centre and has beyond it.
SIGN = 16
U64 = np.uint64
_A = (np.random.default_rng(8).integers(0, 1 << 63, BANDS, dtype=np.uint64) << U64(1)) | U64(1)


def _nodes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 16-byte digest of each document's word sequence, as two columns."""
    n = np.diff(first)
    pos = (np.arange(len(h)) - np.repeat(first[:-1], n)).astype(U64)
    out = np.empty((len(n), 2), U64)
    for k, c in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        total = np.zeros(len(h) + 1, U64)
        np.cumsum(tv.mix((h + pos * U64(c)) ^ U64(c)), out=total[1:])
        out[:, k] = tv.mix(total[first[1:]] - total[first[:-1]] + n.astype(U64))
    return out


def _labelled(r: np.ndarray) -> np.ndarray:
    """k-mer hashes with their occurrence number mixed in."""
    order = np.argsort(r, kind="stable")
    s = r[order]
    same = np.r_[False, s[1:] == s[:-1]]
    if not same.any():
        return r
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(s))))
    out = r.copy()
    out[order] = tv.mix(s + (np.arange(len(s)) - start).astype(U64) * U64(0xA24BAED4963EE407))
    return out


def sketch(r: np.ndarray) -> np.ndarray:
    """One key per band: the least labelled k-mers, in text order."""
    x = _labelled(r)
    take = min(TAKE, len(x))
    rank = (x[None, :] * _A[:, None]) >> U64(20)
    at = np.sort(np.argpartition(rank, take - 1, axis=1)[:, :take], axis=1) if len(x) > take else \
        np.tile(np.arange(len(x)), (BANDS, 1))
    key = np.arange(BANDS, dtype=U64) + U64(77)
    for j in range(take):
        key = tv.mix(key * U64(0x9FB21C651E98DF25) + x[at[:, j]])
    return key


@functools.cache
def _left(n: int, drop: int) -> np.ndarray:
    """Places kept, a row for each way to drop so many of n."""
    return np.array(list(itertools.combinations(range(n), n - drop)))


def _exact(r: np.ndarray, least: float) -> np.ndarray:
    """Keys of a short text: its k-mers, and what is left of them without as many as ``least`` permits.

    The common subsequence of a pair is at least ``least`` of each one's size."""
    keys, n = [], len(r)
    for drop in range(n - max(1, math.ceil(least * n - 1e-9)) + 1):
        at = _left(n, drop)
        key = np.full(len(at), 0xA5A5A5A5, U64)
        for j in range(at.shape[1]):
            key = tv.mix(key * U64(0x9FB21C651E98DF25) + r[at[:, j]])
        keys.append(key)
    return np.unique(np.concatenate(keys))


def _per_text(col, each):
    """Calls each(text number, k-mers, node bytes or None) for every text of a column."""
    data, off = tv.utf8(col)
    for lo, hi in tv.spans(off, CHUNK):
        part = off[lo:hi + 1] - off[lo]
        own = data[off[lo]:off[hi]]
        _, _, h, first = tv.words(own, part)
        r, at = tv.shingles(h, first, RUN)
        node = _nodes(h, first)
        for i in range(hi - lo):
            if first[i + 1] > first[i]:
                key = node[i].tobytes()
            else:
                raw = own[part[i]:part[i + 1]].tobytes()
                key = hashlib.md5(raw).digest() if raw.strip() else None
            each(lo + i, r[at[i]:at[i + 1]], key)


def _sketches(least: float):
    def run(batches):
        for b in batches:
            nodes, keys, size = [None] * b.num_rows, [None] * b.num_rows, [0] * b.num_rows

            def each(i, r, key):
                nodes[i], size[i] = key, len(r)
                if len(r):
                    own = sketch(r)
                    keys[i] = (np.r_[own, _exact(r, least)] if len(r) <= FEW else own).view(np.int64)
            _per_text(b.column("text"), each)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "node", "size", "keys"])
            tv.release()
    return run


def _packed(r: np.ndarray) -> bytes:
    """Six bytes of each k-mer's hash: two k-mers of a pair of texts are taken for one with a chance of 2**-48."""
    return r.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel().astype(U64)


def _payload(batches):
    for b in batches:
        nodes, runs = [None] * b.num_rows, [None] * b.num_rows

        def each(i, r, key):
            nodes[i], runs[i] = key, _packed(r)
        _per_text(b.column("text"), each)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(runs, pa.binary())], names=["node", "runs"])
        tv.release()


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """lcs / (na + nb - lcs) over the band that ``least`` allows; exact from ``least`` on."""
    na, nb = len(a), len(b)
    if min(na, nb) < least * max(na, nb):
        return 0.0
    n = min(na, nb)
    diff = np.flatnonzero(a[:n] != b[:n])
    pre = int(diff[0]) if len(diff) else n
    diff = np.flatnonzero(a[na - (n - pre):][::-1] != b[nb - (n - pre):][::-1])
    suf = int(diff[0]) if len(diff) else n - pre
    x, y = a[pre:na - suf], b[pre:nb - suf]
    lcs = pre + suf
    if len(x) and len(y):
        need = least / (1 + least) * (na + nb)
        xs = np.sort(x)
        if lcs + np.count_nonzero(tv.isin_sorted(y, xs)[1]) < need - 1e-9:
            return 0.0
        band = int(na + nb - 2 * need) + 1
        places: dict[int, int] = {}
        for i, v in enumerate(x.tolist()):
            places[v] = places.get(v, 0) | 1 << i
        wide = (1 << (2 * band + 1)) - 1
        v = full = (1 << len(x)) - 1
        for j, w in enumerate(y.tolist()):
            m = places.get(w)
            if m:
                m &= wide << (j - band) if j >= band else wide >> (band - j)
                u = v & m
                v = ((v + u) | (v - u)) & full
        lcs += len(x) - v.bit_count()
    return lcs / (na + nb - lcs)


def _verify(least: float):
    def run(batches):
        for b in batches:
            left, right = b.column("left").to_pylist(), b.column("right").to_pylist()
            ok = [aligned(_unpacked(x), _unpacked(y), least) >= least for x, y in zip(left, right)]
            del left, right
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
            tv.release()
    return run


def _picked(payload: DataFrame, ids: DataFrame) -> DataFrame:
    """The payload of these ids (distinct, written): of few by a broadcast, so that the rest is not shuffled."""
    few = ids.count() <= PICKED
    return payload.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _linked(pairs: DataFrame, payload: DataFrame, least: float, path: str) -> DataFrame:
    """The pairs (a, b) that are as similar as ``least``, written under ``path``."""
    spark = pairs.sparkSession
    pairs.write.parquet(f"{path}-pairs")
    pairs = spark.read.parquet(f"{path}-pairs")
    sides = []
    for side in "ab":
        pairs.select(F.col(side).alias("id")).distinct().write.parquet(f"{path}-{side}")
        sides.append(_picked(payload, spark.read.parquet(f"{path}-{side}")).withColumnRenamed("id", side))
    # ids travel first; each side's k-mers join by id, so no bucket meets in one task
    rows = (pairs.join(sides[0].withColumnRenamed("runs", "left"), "a").join(sides[1].withColumnRenamed("runs", "right"), "b"))
    rows.select("a", "b", "left", "right").mapInArrow(_verify(least), "a long, b long").write.parquet(path)
    return spark.read.parquet(path)


def _mixed(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """The rows (key, id, rank, component) of buckets of more than three nodes that hold several components."""
    marked = buckets.where("n > 3").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "rank", F.coalesce("component", "id").alias("component"))
    several = marked.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("key")
    return marked.join(several, "key")


def _centred(mixed: DataFrame) -> DataFrame:
    """Adds each bucket's centre, its node of largest rank, and the centre's component."""
    best = mixed.groupBy("key").agg(F.max(F.struct("rank", "id", "component")).alias("m"))
    return mixed.join(best.select("key", F.col("m.id").alias("centre"), F.col("m.component").alias("own")), "key")


def _sign(x: np.ndarray) -> np.ndarray:
    """A bitmap of k-mers: the set bits of two nodes' bitmaps together are at most the k-mers of both."""
    bits = np.zeros(SIGN * 64, bool)
    bits[(x & U64(SIGN * 64 - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view("<i8")


def _against(least: float):
    """What each node shares with its bucket's centre: the number of k-mers, bitmaps of those that it lacks and of
    those that the centre lacks, the latter, and how many of these a prefix filter needs (where it needs none, none are given)."""
    def run(batches):
        for b in batches:
            out = [[], [], [], [], [], [], []]
            for x, c in zip(b.column("left"), b.column("right")):
                x = _labelled(_unpacked(x.as_buffer()))
                c = np.sort(_labelled(_unpacked(c.as_buffer())))
                rest = x[~tv.isin_sorted(x, c)[1]]
                shared = len(x) - len(rest)
                needed = max(0, len(rest) - max(1, math.ceil(least * len(x)) - shared) + 1)
                lacks = c[~tv.isin_sorted(c, np.sort(x))[1]]
                for to, v in zip(out, (len(c), _sign(lacks), _sign(rest), len(x), shared, needed, rest.view(np.int64) if needed else np.zeros(0, np.int64))):
                    to.append(v)
            kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            made = [pa.array(x, kind) for x, kind in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(
                [*made[:3], b.column("centre"), b.column("own"), b.column("id"), b.column("component"), *made[3:]],
                names=["whole", "lacks", "beyond", "centre", "own", "id", "component", "size", "shared", "needed", "rest"])
    return run


_LEFT = "centre long, own long, id long, component long, size int, shared int, needed int, rest array<long>"
_SIGNED = "whole int, lacks array<long>, beyond array<long>, " + _LEFT


def _pieces(b: pa.RecordBatch):
    """(rows, where their k-mers' hashes lie, how many each row has) of bounded size."""
    n = pa.compute.list_value_length(b.column("rest")).to_numpy()
    for lo, hi in tv.spans(np.r_[0, np.cumsum(n, dtype=np.int64)], CHUNK):
        part = b.slice(lo, hi - lo)
        centre = np.repeat(part.column("centre").to_numpy().astype(U64), n[lo:hi])
        yield part, tv.mix(part.column("rest").flatten().to_numpy().view(U64) ^ tv.mix(centre)), n[lo:hi]


def _places(bits: int):
    """Per run of marks, the places of k-mers in it, and which are those of nodes of other components than the centre's."""
    def run(batches):
        for b in batches:
            for part, key, n in _pieces(b):
                other = np.repeat(part.column("component").to_numpy() != part.column("own").to_numpy(), n)
                at = (key & U64(bits - 1)).astype(np.int64)
                order = np.argsort(at, kind="stable")
                at, other = at[order], other[order].astype(np.uint8)
                runs = at >> marks.RUN
                edge = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(at) else np.zeros(0, int)
                ends = [*edge[1:].tolist(), len(at)][:len(edge)]
                low = (at & ((1 << marks.RUN) - 1)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs[edge], pa.int32()), pa.array([low[lo:hi].tobytes() for lo, hi in zip(edge.tolist(), ends)], pa.binary()),
                     pa.array([other[lo:hi].tobytes() for lo, hi in zip(edge.tolist(), ends)], pa.binary())], names=["run", "at", "other"])
            tv.release()
    return run


def _marked(rows: pa.Table) -> pa.Table:
    """The places of one run that two k-mers have, one of them another component's."""
    at, other = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows.column(c)]) for c, kind in (("at", "<u2"), ("other", np.uint8)))
    meet = (np.bincount(at, minlength=1 << marks.RUN) > 1) & (np.bincount(at, other, 1 << marks.RUN) > 0)
    return pa.table([rows.column("run")[:1], pa.array([np.packbits(meet, bitorder="little").tobytes()], pa.binary())], names=["run", "bits"])


def _thinned(shared, bits: int):
    def run(batches):
        for b in batches:
            for part, key, n in _pieces(b):
                keep = marks.found(shared.value, (key & U64(bits - 1)).astype(np.int64))
                row = np.r_[0, np.cumsum(n)]
                needed = np.maximum(0, part.column("needed").to_numpy() - (n - np.diff(np.r_[0, np.cumsum(keep)][row])))
                keep &= np.repeat(needed > 0, n)
                off = np.r_[0, np.cumsum(keep)][row].astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(off), part.column("rest").flatten().filter(pa.array(keep)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(needed, pa.int32()), rest], names=part.schema.names)
            tv.release()
    return run


def _meeting(left: DataFrame) -> DataFrame:
    """left with only those k-mers in ``rest`` that can meet: a second node of the centre has them, and one of these
    nodes is of another component than the centre's (by a bitmap of hashes, so a few others stay). In the order that
    the prefix filter takes, those that go come first: they use up ``needed``. Nodes that need none lose all."""
    bits = marks.size(left.agg(F.sum(F.size("rest"))).first()[0] or 0)
    runs = left.mapInArrow(_places(bits), "run int, at binary, other binary").groupBy("run").applyInArrow(_marked, "run int, bits binary").toArrow()
    shared = left.sparkSession.sparkContext.broadcast(marks.together(runs, bits))
    return left.mapInArrow(_thinned(shared, bits), left.schema)


def _residues(left: DataFrame) -> DataFrame:
    """left with ``residue``: of the k-mers that the centre lacks, the ``needed`` ones that fewest nodes of
    this centre have, in one order for all; those that no other node has can meet none and go."""
    every = left.select("centre", "id", "needed", F.explode("rest").alias("k"))
    often = every.groupBy("centre", "k").agg(F.count("*").alias("n"))
    rare = (every.join(often, ["centre", "k"]).groupBy("centre", "id", "needed")
            .agg(F.sort_array(F.collect_list(F.struct("n", "k"))).alias("s")))
    first = F.filter(F.slice("s", F.lit(1), F.col("needed")), lambda x: x["n"] > 1)
    rare = rare.select("centre", "id", F.transform(first, lambda x: x["k"]).alias("residue"))
    return left.drop("rest", "needed").join(rare, ["centre", "id"], "left")


def _undecided(left: DataFrame, least: float) -> DataFrame:
    """(a, b): the pairs across components, of one centre, that can reach ``least``.

    Two nodes share at most what both share with the centre, plus what they share beyond it. So
    either they meet in their residues (a join on the k-mer, not on the bucket), or the lesser of
    their shares with the centre is enough by itself (a join on the size that the other must have).
    Of these pairs, those stay whose bitmaps (where left has them) leave room for enough: in common they have no
    more of the centre than neither lacks, and no more beyond it than is counted twice. So copies that were edited
    in different places, or of which each has its own additions, are no pairs, however many they are."""
    signs = ("whole", "lacks", "beyond") if "lacks" in left.columns else ()

    def pick(tag: str):
        return [F.col(c).alias(f"{c}_{tag}") for c in ("id", "component", "size", "shared", *signs)]

    def either(column: str):
        return functools.reduce(lambda a, b: a + b, (F.bit_count(F.get(f"{column}_x", F.lit(i)).bitwiseOR(F.get(f"{column}_y", F.lit(i)))) for i in range(SIGN)))
    of_centre = F.least("shared_x", "shared_y", F.col("whole_x") - either("lacks"))
    own = [F.col(f"size_{tag}") - F.col(f"shared_{tag}") for tag in "xy"]
    room = F.lit(True) if not signs else (of_centre + F.least(*own, own[0] + own[1] - either("beyond"))) * (1 + least) + 1e-6 >= least * (F.col("size_x") + F.col("size_y"))
    other = left.where("component <> own")  # of two components, one is not the centre's
    part = other.select("centre", *pick("x"), F.explode("residue").alias("k"))
    meet = part.join(left.select("centre", *pick("y"), F.explode("residue").alias("k")), ["centre", "k"])
    most = F.floor((1 + least) / least * F.col("shared") + 1e-9).cast("int") - F.col("size")
    lone = other.withColumn("least_size", F.ceil(F.col("size") * least - 1e-9).cast("int")).withColumn("most_size", most)
    lone = lone.where("most_size >= least_size").select(
        "centre", *pick("x"), F.explode(F.sequence("least_size", "most_size")).alias("size_y"))
    alone = lone.join(left.select("centre", *pick("y")), ["centre", "size_y"])
    enough = F.least("shared_x", "shared_y") * (1 + least) + 1e-6 >= least * (F.col("size_x") + F.col("size_y"))
    pairs = (meet.where((F.col("component_x") != F.col("component_y"))
                        & (F.least("size_x", "size_y") + 1e-9 >= least * F.greatest("size_x", "size_y")) & room).select("id_x", "id_y")
             .union(alone.where((F.col("component_x") != F.col("component_y")) & enough & room).select("id_x", "id_y")))
    return pairs.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, node, class_id (least doc_id of the class) of every row."""
    spark = docs.sparkSession
    base = shared_path(spark, f"dedup-{uuid.uuid4().hex}")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs.mapInArrow(_sketches(least), "doc_id long, node binary, size int, keys array<long>").write.parquet(f"{base}/sketches")
    every = spark.read.parquet(f"{base}/sketches")
    (every.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("keys").alias("keys"))
     .withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{base}/nodes"))
    nodes = spark.read.parquet(f"{base}/nodes")
    members = nodes.select("id", "size", F.explode("keys").alias("key"))
    ends = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).where("n > 1")
    members.join(ends, "key").write.parquet(f"{base}/buckets")
    buckets = spark.read.parquet(f"{base}/buckets")
    candidates = nodes.select("id", "node", "doc_id").join(buckets.select("id").distinct(), "id")
    texts = docs.join(candidates.select(F.col("doc_id").alias("rep")).distinct(), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    (texts.mapInArrow(_payload, "node binary, runs binary").join(candidates, "node")
     .groupBy("id").agg(F.first("runs").alias("runs")).write.parquet(f"{base}/payload"))
    payload = spark.read.parquet(f"{base}/payload")

    stars = (buckets.select("id", F.explode(F.array("low", "high")).alias("end")).where("id <> end")
             .select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")).distinct())
    links = _linked(stars, payload, least, f"{base}/links")
    tried = spark.read.parquet(f"{base}/links-pairs")
    found = components(links, "a", "b")
    # the stars compare all pairs of up to three nodes; of larger buckets, what lies in several components is left
    ranks = buckets.groupBy("id").agg(F.sum("n").alias("rank"))
    buckets.join(ranks, "id").write.parquet(f"{base}/ranked")
    buckets = spark.read.parquet(f"{base}/ranked")
    for k in range(ROUNDS):
        _mixed(buckets, found).write.parquet(f"{base}/mixed{k}")
        mixed = spark.read.parquet(f"{base}/mixed{k}")
        centred = _centred(mixed)
        if k:  # a centre of what is apart from the best one
            rest = centred.where("component <> own").select("key", "id", "rank", "component")
            centred = _centred(rest)
        new = (centred.where("component <> own").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
               .join(tried, ["a", "b"], "left_anti"))
        more = _linked(new, payload, least, f"{base}/more{k}")
        tried = tried.union(spark.read.parquet(f"{base}/more{k}-pairs"))
        if not more.take(1):
            if k:
                break
            continue
        links = links.union(more)
        found = components(links, "a", "b")
    left = _centred(_mixed(buckets, found)).select("id", "centre", "component", "own").distinct()
    left.write.parquet(f"{base}/apart")
    left = spark.read.parquet(f"{base}/apart")
    sides = []
    for side in ("id", "centre"):
        left.select(F.col(side).alias("id")).distinct().write.parquet(f"{base}/apart-{side}")
        sides.append(_picked(payload, spark.read.parquet(f"{base}/apart-{side}")))
    both = left.join(sides[0].withColumnRenamed("runs", "left"), "id").join(sides[1].select(F.col("id").alias("centre"), F.col("runs").alias("right")), "centre")
    both.mapInArrow(_against(least), _SIGNED).write.parquet(f"{base}/beside")
    _residues(_meeting(spark.read.parquet(f"{base}/beside"))).write.parquet(f"{base}/left")
    more = _linked(_undecided(spark.read.parquet(f"{base}/left"), least).join(tried, ["a", "b"], "left_anti"), payload, least, f"{base}/last")
    if more.take(1):
        found = components(links.union(more), "a", "b")
    tagged = nodes.select("id", "node", F.col("doc_id").alias("rep")).join(
        found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least_id = tagged.groupBy("component").agg(F.min("rep").alias("class_id"))
    label = tagged.join(least_id, "component").select("node", "class_id")
    return (every.select("doc_id", "node").join(label, "node", "left")
            .select("doc_id", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of docs, all columns, that are the least id of their class; of rows that share
    that id and its words, one. Rows without text of their own (null or blank) all stay."""
    marked = classes(docs, least)
    spark = docs.sparkSession
    path = shared_path(spark, f"dedup-{uuid.uuid4().hex}")
    keep = (marked.where(F.col("node").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")))
            .groupBy("doc_id").agg(F.count("node").alias("rows")))
    keep.write.parquet(path)
    keep = spark.read.parquet(path).select(F.col("doc_id").alias("__keep_id"), F.col("rows").alias("__keep_rows"))
    rows, back = numbered(docs, "doc_id", "text")
    rows = rows.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("__keep_id")))
    once = back(rows.where("__keep_rows < 2"))
    if not keep.where("__keep_rows > 1").take(1):
        return once
    again = rows.where("__keep_rows > 1")
    blank = F.trim(F.coalesce(F.col("text"), F.lit(""))) == ""
    return once.union(back(again.where(blank))).union(back(again.where(~blank).dropDuplicates(["doc_id"])))
