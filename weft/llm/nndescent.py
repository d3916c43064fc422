"""3. Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are folded into one node, so a vector repeated without end costs one node and
its ``MOST`` least ids (all that five neighbours can need). The graph starts from blocks of
neighbours along ``TREES`` random orders (hyperplane signs, then a projection), and is
improved in rounds of Spark joins: every node gathers its neighbours and reverse neighbours
with their vectors, pairs of these that include a new one are compared, and each node keeps
its ``K`` best. Rounds end when few entries change. Queries walk the graph greedily: a pool
starts at the query's node, its best unexpanded members are expanded by joins, until the
pool rests. Scores returned are exact cosines, in double, of the original vectors.

Graph vectors are unit vectors in half precision (they only steer the search). Reverse
neighbours are the ``K`` nearest ones of a node; this and the pool's size are the method's
approximation, whose recall the tests measure against brute force.

Defined results: rows whose vector is null, empty, zero, holds a null or non-finite
component, or whose vec_id is null take no part, nor do vectors of another length than the
most frequent one (ties: the longest); a row repeated with id and vector counts once; equal
scores go to the smaller vec_id; fewer than five candidates are all returned; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.session import shared_path

K, TREES, SIGNS, LEAF, POOL, EXPAND = 32, 6, 4, 128, 128, 64
#: Rounds end when this share of the graph's entries, or less, is new.
FEW = 0.02
#: Most by which a cosine of unit vectors rounded to half precision (2**-11 a component) can be off.
OFF = 1.1e-3
#: Of the pairs found at one gathering node, each member keeps so many; nodes handled at once.
LOCAL, AT_ONCE = 10, 1000
NEAREST, MOST = 5, 6
LIST = "node long, ids array<long>, sims array<float>"


def _unit(batches):
    for b in batches:
        out = []
        for v in b.column("vector"):
            x = np.asarray(v.values, np.float64)
            out.append((x / np.linalg.norm(x)).astype("<f2").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(out, pa.binary())], names=["node", "unit"])


def _matrix(col) -> np.ndarray:
    raw = [x.as_buffer() for x in col]
    return _sphere(np.stack([np.frombuffer(x, "<f2") for x in raw])) if raw else np.zeros((0, 1), np.float32)


def _sphere(x: np.ndarray) -> np.ndarray:
    """Rounded unit vectors made unit again: else a vector rounded down would be nobody's neighbour in a dense group."""
    x = x.astype(np.float32)
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _orders(batches):
    """Each node once per random order, with its place in that order."""
    for b in batches:
        x = _matrix(b.column("unit"))
        if not len(x):
            continue
        for t in range(TREES):
            rng = np.random.default_rng(100 + t)
            plane = rng.standard_normal((x.shape[1], SIGNS + 1)).astype(np.float32)
            y = x @ plane
            sign = ((y[:, :SIGNS] > 0) * (1 << np.arange(SIGNS))).sum(1)
            place = t * 1e3 + sign * 4.0 + np.clip(y[:, SIGNS] / np.sqrt(x.shape[1]), -1, 1)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.float64)), b.column("node"), b.column("unit")],
                                             names=["place", "node", "unit"])


def _best(owner, other, sim, most: int):
    """Lists of the ``most`` best distinct others of each owner."""
    order = np.lexsort((other, -sim, owner))
    o, c, s = owner[order], other[order], sim[order]
    pair = np.lexsort((c, o))  # the same pair may come twice
    twice = np.zeros(len(o), bool)
    same = (o[pair][1:] == o[pair][:-1]) & (c[pair][1:] == c[pair][:-1])
    twice[np.maximum(pair[1:], pair[:-1])[same]] = True
    o, c, s = o[~twice], c[~twice], s[~twice]
    new = np.r_[True, o[1:] != o[:-1]] if len(o) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    rank = np.arange(len(o)) - np.repeat(start, np.diff(np.r_[start, len(o)]))
    keep = rank < most
    o, c, s = o[keep], c[keep], s[keep]
    start = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.zeros(0, int)
    at = pa.array(np.r_[start, len(o)], pa.int32())
    return [pa.array(o[start], pa.int64()), pa.ListArray.from_arrays(at, pa.array(c, pa.int64())),
            pa.ListArray.from_arrays(at, pa.array(s, pa.float32()))]


def _leaves(batches):
    """Neighbours within blocks of consecutive nodes; consecutive blocks overlap by half."""
    held_n, held_x = np.zeros(0, np.int64), None

    def block(n, x):
        sim = x @ x.T
        i, j = np.nonzero(n[:, None] != n[None, :])
        return pa.RecordBatch.from_arrays(_best(n[i], n[j], sim[i, j], K), names=["node", "ids", "sims"])
    for b in batches:
        x = _matrix(b.column("unit"))
        n = b.column("node").to_numpy()
        held_n, held_x = (n, x) if held_x is None else (np.r_[held_n, n], np.r_[held_x, x])
        while len(held_n) >= LEAF:
            yield block(held_n[:LEAF], held_x[:LEAF])
            held_n, held_x = held_n[LEAF // 2:], held_x[LEAF // 2:]
    if len(held_n) > 1:
        yield block(held_n, held_x)


def _merge(batches):
    """All lists of a node into its K best; ``fresh`` marks entries that ``old`` lacks."""
    for b in batches:
        out_i, out_s, out_f = [], [], []
        for old, lists in zip(b.column("old").to_pylist(), b.column("lists")):
            ids = np.concatenate([x["ids"].values.to_numpy() for x in lists])
            sims = np.concatenate([x["sims"].values.to_numpy() for x in lists])
            order = np.lexsort((ids, -sims))
            _, first = np.unique(ids[order], return_index=True)
            top = order[np.sort(first)[:K]]
            had = set(old or ())
            out_i.append(ids[top])
            out_s.append(sims[top])
            out_f.append([i not in had for i in ids[top].tolist()])
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), pa.array(out_i, pa.list_(pa.int64())), pa.array(out_s, pa.list_(pa.float32())),
             pa.array(out_f, pa.list_(pa.bool_()))], names=["node", "ids", "sims", "fresh"])


def _compare(batches):
    """Pairs among a node's gathered neighbours, at least one of them new, that beat what a member has."""
    for b in batches:
        for lo in range(0, b.num_rows, AT_ONCE):
            own, oth, val = [], [], []
            for g in b.column("gathered").slice(lo, AT_ONCE):
                n, first = np.unique(g.values.field("id").to_numpy(), return_index=True)
                if len(n) < 2:
                    continue
                take = pa.array(first)
                fresh = np.isin(n, g.values.field("id").filter(g.values.field("fresh")).to_numpy())
                x = _matrix(g.values.field("unit").take(take))
                sim = x @ x.T
                ok = (fresh[:, None] | fresh[None, :]) & (sim > g.values.field("worst").take(take).to_numpy()[:, None])
                np.fill_diagonal(ok, False)
                sim[~ok] = -3
                if len(n) > LOCAL:
                    ok &= sim >= np.partition(sim, -LOCAL, axis=1)[:, -LOCAL:-LOCAL + 1]
                i, j = np.nonzero(ok)
                own.append(n[i])
                oth.append(n[j])
                val.append(sim[i, j])
            if own:
                yield pa.RecordBatch.from_arrays(_best(*map(np.concatenate, (own, oth, val)), K), names=["node", "ids", "sims"])


def _merged(lists: DataFrame, old: DataFrame | None) -> DataFrame:
    lists = lists.groupBy("node").agg(F.collect_list(F.struct("ids", "sims")).alias("lists"))  # K entries a task at most
    if old is None:
        rows = lists.withColumn("old", F.lit(None).cast("array<bigint>"))
    else:
        rows = old.select("node", F.col("ids").alias("old"), F.struct("ids", "sims").alias("own")).join(lists, "node", "left")
        rows = rows.select("node", "old", F.concat(F.array("own"), F.coalesce("lists", F.expr("array()").cast(
            "array<struct<ids:array<bigint>,sims:array<float>>>"))).alias("lists"))
    return rows.select("node", "old", "lists").mapInArrow(_merge, LIST + ", fresh array<boolean>")


def graph(units: DataFrame, base: str) -> DataFrame:
    """(node, ids, sims, fresh): the K nearest found of every node of units (node, unit)."""
    spark = units.sparkSession
    placed = units.mapInArrow(_orders, "place double, node long, unit binary")
    leaves = placed.repartitionByRange("place").sortWithinPartitions("place", "node").drop("place")
    _merged(leaves.mapInArrow(_leaves, LIST), None).write.parquet(f"{base}/graph0")
    g = spark.read.parquet(f"{base}/graph0")
    for r in itertools.count(1):  # a list only ever gets better, so the rounds end
        edges = g.select("node", F.explode(F.arrays_zip("ids", "sims", "fresh")).alias("e")).select(
            "node", F.col("e.ids").alias("id"), F.col("e.sims").alias("sim"), F.col("e.fresh").alias("fresh"))
        back = edges.select(F.col("id").alias("node"), F.col("node").alias("id"), "sim", "fresh")
        near = Window.partitionBy("node").orderBy(F.desc("sim"), "id")
        back = back.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= K).drop("rank")
        worst = g.select(F.col("node").alias("id"), F.when(F.size("sims") < K, F.lit(-2.0)).otherwise(
            F.array_min("sims")).cast("float").alias("worst"))
        members = units.select(F.col("node").alias("id"), "unit").join(worst, "id", "left").withColumn(
            "worst", F.coalesce("worst", F.lit(-2.0).cast("float")))
        gathered = (edges.select("node", "id", "fresh").union(back.select("node", "id", "fresh")).join(members, "id")
                    .groupBy("node").agg(F.collect_list(F.struct("id", "fresh", "worst", "unit")).alias("gathered")))  # 2K at most
        found = gathered.select("gathered").mapInArrow(_compare, LIST)
        _merged(found, g).write.parquet(f"{base}/graph{r}")
        g = spark.read.parquet(f"{base}/graph{r}")
        changed = g.agg(F.sum(F.size(F.filter("fresh", lambda x: x))).alias("c"), F.sum(F.size("ids")).alias("n")).first()
        if (changed["c"] or 0) <= FEW * (changed["n"] or 0):
            return g


def _walk(batches):
    """Adds candidates to a query's pool."""
    for b in batches:
        pools, sims, done = [], [], []
        for q, pool, sim, seen, cand in zip(*(b.column(c) for c in ("unit", "pool", "sim", "seen", "cand"))):
            x = _sphere(np.frombuffer(q.as_buffer(), "<f2"))
            ids, s = pool.values.to_numpy(), sim.values.to_numpy()
            was = seen.values.to_numpy(zero_copy_only=False)
            if cand.is_valid and len(cand.values):
                n = cand.values.field("id").to_numpy()
                _, first = np.unique(n, return_index=True)
                n2, y = n[first], _matrix(cand.values.field("unit").take(pa.array(first)))
                new = ~np.isin(n2, ids)
                ids, s, was = np.r_[ids, n2[new]], np.r_[s, (y @ x)[new]], np.r_[was, np.zeros(new.sum(), bool)]
            order = np.lexsort((ids, -s))[:POOL]
            pools.append(ids[order])
            sims.append(s[order])
            done.append(was[order])
        yield pa.RecordBatch.from_arrays(
            [b.column("query"), b.column("unit"), pa.array(pools, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float32())),
             pa.array(done, pa.list_(pa.bool_()))], names=["query", "unit", "pool", "sim", "seen"])


def search(queries: DataFrame, g: DataFrame, units: DataFrame, base: str) -> DataFrame:
    """(query, pool, sim): the nodes nearest to each query node found by a greedy walk from it, nearest first."""
    spark = queries.sparkSession
    state = "query long, unit binary, pool array<long>, sim array<float>, seen array<boolean>"
    start = queries.join(units, "node").select(
        F.col("node").alias("query"), "unit", F.array("node").alias("pool"), F.array(F.lit(1.0).cast("float")).alias("sim"),
        F.array(F.lit(False)).alias("seen"))
    start.write.parquet(f"{base}/pool0")
    pool = spark.read.parquet(f"{base}/pool0")
    for step in itertools.count(1):  # a node is expanded once a query, so the walk ends
        open_ = F.slice(F.filter(F.arrays_zip("pool", "seen"), lambda x: ~x.seen), 1, EXPAND)
        chosen = pool.withColumn("open", F.transform(open_, lambda x: x.pool))
        asked = chosen.select("query", F.explode("open").alias("node"))
        cand = (asked.join(g.select("node", "ids"), "node").select("query", F.explode("ids").alias("id")).distinct()
                .join(units.select(F.col("node").alias("id"), "unit"), "id")
                .groupBy("query").agg(F.collect_list(F.struct("id", "unit")).alias("cand")))  # EXPAND x K at most
        rows = chosen.withColumn("seen", F.zip_with("seen", "pool", lambda s, p: s | F.array_contains("open", p)))
        rows = rows.join(cand, "query", "left").select("query", "unit", "pool", "sim", "seen", "cand")
        rows.mapInArrow(_walk, state).write.parquet(f"{base}/pool{step}")
        pool = spark.read.parquet(f"{base}/pool{step}")
        if not pool.where(F.exists("seen", lambda x: ~x)).take(1):
            return pool.select("query", "pool", "sim")


def nearest(embeddings: DataFrame, every: int = 50, nearest_n: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest, by NN-descent."""
    spark = embeddings.sparkSession
    base = shared_path(spark, f"neighbours-{uuid.uuid4().hex}")
    v = F.col("vector")
    good = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & good).dropDuplicates()
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    rows = rows.where(F.size("vector") == (common[0]["n"] if common else 0))
    rows.groupBy("vector").agg(F.min("vec_id").alias("node")).write.parquet(f"{base}/nodes")  # a node is its least id
    nodes = spark.read.parquet(f"{base}/nodes")
    nodes.mapInArrow(_unit, "node long, unit binary").write.parquet(f"{base}/units")
    units = spark.read.parquet(f"{base}/units")
    rows.join(nodes, "vector").select("vec_id", "node").write.parquet(f"{base}/members")
    members = spark.read.parquet(f"{base}/members")
    queries = members.where(F.col("vec_id") % every == 0)
    g = graph(units, base)
    pool = search(queries.select("node").distinct(), g, units, base)
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = {c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)) for c in "ab"}
    # all of the pool that can be among the MOST nearest by exact cosine
    least = F.when(F.size("sim") < MOST, F.lit(-2.0)).otherwise(F.get("sim", F.lit(MOST - 1)) - 2 * OFF)
    pairs = pool.select("query", F.explode(F.filter(F.arrays_zip("pool", "sim"), lambda x: x["sim"] >= least)).alias("x"))
    pairs = pairs.select("query", F.col("x.pool").alias("node"))
    pairs = (pairs.join(nodes.select("node", F.col("vector").alias("a")), "node")
             .join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("b")), "query")
             .select("query", "node", F.when(F.col("query") == F.col("node"), F.lit(1.0)).otherwise(dot / (norm["a"] * norm["b"])).alias("score")))
    least = Window.partitionBy("node").orderBy("vec_id")
    few = members.withColumn("i", F.row_number().over(least)).where(F.col("i") <= MOST).drop("i")
    top = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = pairs.join(few, "node").withColumn("i", F.row_number().over(top)).where(F.col("i") <= MOST)
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    out = asked.join(found, "query").where("query_id <> vec_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= nearest_n).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
