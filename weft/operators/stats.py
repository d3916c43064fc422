"""Corpus, embedding and training-log statistics the project documents."""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import merging
from ..session import shared_path, ship

#: Rows of a block of vectors.
BLOCK = 1024


def dot(a: Column, b: Column) -> Column:
    """H2: dot product of two equal-length arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    """H2: Euclidean norm."""
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    z = F.arrays_zip(a.alias("x"), F.array_repeat(norm(a), F.size(a)).alias("n"))
    return F.transform(z, lambda p: p["x"] / p["n"])


def cosine(a: Column, b: Column) -> Column:
    """H1: cosine similarity."""
    return dot(a, b) / (norm(a) * norm(b))


#: Pivots that gather near vectors into blocks, and block centres that are broadcast at once.
PIVOTS, CENTRES = 64, 1 << 17
_BLOCK = "block long, n long, ids binary, x binary, centre binary, angle double"
_SLACK = 1e-9


def _units(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and v is not null")


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of a batch; zero vectors and vectors with a null, infinite or missing part are left out."""
    ids, lists = batch.column("id").to_numpy(), batch.column("v")
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    width = int(size.max()) if len(size) else 0
    if (size != width).any():
        raise ValueError("vectors of different lengths")
    x = lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(len(ids), width)
    norm = np.linalg.norm(x, axis=1)
    good = np.isfinite(norm) & (norm > 0)
    return ids[good], x[good] / norm[good, None]


def vector_blocks(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Blocks of at most BLOCK unit vectors that lie near one pivot, with the mean direction and the largest
    angle to it. Pivots are a fixed number of vectors, by hash of id; blocks form inside a task,
    without a shuffle, so a pivot with most of the vectors is only many blocks."""
    ship(vectors.sparkSession)
    rows = _units(vectors, id_col, vec_col)
    pivots = np.array([r["v"] for r in rows.where(F.size(F.filter("v", lambda x: x.isNull() | F.isnan(x))) == 0)
                       .orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()], float)

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(parts):
            nonlocal n
            ids, x = (np.concatenate(y) for y in zip(*parts))
            centre = x.sum(0)
            length = np.linalg.norm(centre)
            centre = centre / length if length > 0 else x[0]
            angle = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
            n += 1
            return pa.RecordBatch.from_pydict({"block": [(part << 32) + n], "n": [len(ids)], "ids": [ids.astype("<i8").tobytes()], "x": [x.tobytes()],
                                               "centre": [centre.tobytes()], "angle": [angle]},
                                              schema=pa.schema([("block", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("x", pa.binary()), ("centre", pa.binary()), ("angle", pa.float64())]))
        for b in batches:
            ids, x = _matrix(b)
            near = (x @ pivots.T).argmax(1) if len(pivots) else np.zeros(len(ids), int)
            for p in np.unique(near):
                own = np.flatnonzero(near == p)
                for lo in range(0, len(own), BLOCK):
                    held.setdefault(int(p), []).append((ids[own[lo:lo + BLOCK]], x[own[lo:lo + BLOCK]]))
                    if sum(len(y[0]) for y in held[int(p)]) >= BLOCK:
                        yield block(held.pop(int(p)))
        for parts in held.values():
            yield block(parts)
    return rows.mapInArrow(run, _BLOCK)


def _best_of(ids: np.ndarray, scores: np.ndarray, n: int):
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :n]
    return ids[order], np.take_along_axis(scores, order, 1)


def block_pairs(blocks: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """(block, id, v): the blocks in which one of a query's n nearest vectors can lie.

    First each query meets the blocks around the nearest centre until they hold n vectors; the cosine of its
    nth best there is a floor. A block is asked only if the cosine of (angle to its centre less its own
    angle) reaches that floor. Centres are broadcast in runs of ``CENTRES``, so their number has no bound."""
    spark = queries.sparkSession
    centres = blocks.select("block", "n", "centre", "angle")
    edges = [r["block"] for r in centres.select("block").orderBy("block").withColumn("i", F.monotonically_increasing_id()).where(F.col("i") % CENTRES == 0).collect()] \
        if centres.count() > CENTRES else [None]

    def runs():
        for lo, hi in zip(edges, [*edges[1:], None]):
            part = centres if lo is None else centres.where((F.col("block") >= lo) & (F.lit(True) if hi is None else F.col("block") < hi))
            t = part.toArrow()
            if t.num_rows:
                c = np.stack([np.frombuffer(x.as_buffer()) for x in t.column("centre")])
                yield spark.sparkContext.broadcast((t.column("block").to_numpy(), t.column("n").to_numpy(), c, t.column("angle").to_numpy()))

    def asked(shared, floors: bool):
        def run(batches):
            block, count, centre, angle = shared.value
            for b in batches:
                for lo in range(0, b.num_rows, BLOCK):
                    part = b.slice(lo, BLOCK)
                    ids, q = _matrix(part)
                    if not len(ids):
                        continue
                    away = np.arccos(np.clip(q @ centre.T, -1, 1))
                    if floors:
                        floor = dict(zip(part.column("id").to_pylist(), part.column("floor").to_pylist()))
                        reach = np.cos(np.maximum(away - angle, 0.0))
                        qi, bi = np.nonzero(reach + _SLACK >= np.array([floor[i] if floor[i] is not None else -2.0 for i in ids.tolist()])[:, None])
                    else:
                        order = np.argsort(away, axis=1, kind="stable")
                        before = np.cumsum(count[order], axis=1) - count[order]
                        qi, at = np.nonzero(before < n)
                        bi = order[qi, at]
                    yield pa.RecordBatch.from_arrays([pa.array(block[bi]), pa.array(ids[qi]), pa.array([x.tobytes() for x in q[qi]], pa.binary())], names=["block", "id", "v"])
        return run
    rows = _units(queries.select(F.col("id"), F.col("v")), "id", "v")
    first = [rows.mapInArrow(asked(s, False), "block long, id long, v binary") for s in runs()]
    if not first:
        return spark.createDataFrame([], "block long, id long, v binary")
    found = functools.reduce(DataFrame.union, (_scored(blocks, p, n) for p in first))
    w = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), F.col("vec_id"))
    floors = found.withColumn("r", F.row_number().over(w)).where(F.col("r") == n).select(F.col("query_id").alias("id"), F.col("cosine").alias("floor"))
    path = shared_path(spark, f"floors-{uuid.uuid4().hex}")
    rows.join(floors, "id", "left").write.parquet(path)
    rows = spark.read.parquet(path)
    return functools.reduce(DataFrame.union, (rows.mapInArrow(asked(s, True), "block long, id long, v binary") for s in runs()))


def _scored(blocks: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(query_id, vec_id, cosine): each query's n best of every block that it asks; one matrix product per block and batch."""
    def run(batches):
        for b in batches:
            block = b.column("block").to_numpy()
            edge = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)] if len(block) else np.zeros(1, int)
            for lo, hi in zip(edge[:-1], edge[1:]):
                ids = np.frombuffer(b.column("ids")[int(lo)].as_buffer(), "<i8")
                x = np.frombuffer(b.column("x")[int(lo)].as_buffer()).reshape(len(ids), -1)
                q = np.frombuffer(b"".join(b.column("v").slice(int(lo), int(hi - lo)).to_pylist())).reshape(int(hi - lo), -1)
                best, score = _best_of(ids, np.clip(q @ x.T, -1, 1), n)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("id").to_numpy()[lo:hi], best.shape[1])), pa.array(best.ravel()), pa.array(score.ravel())],
                                                 names=["query_id", "vec_id", "cosine"])
    return pairs.join(blocks.select("block", "ids", "x"), "block").mapInArrow(run, "query_id long, vec_id long, cosine double")


def top_neighbours(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str,
                   qid_col: str, qvec_col: str, n: int = 5) -> DataFrame:
    """H1: for each query vector, the n most cosine-similar vectors (ties by id), exactly. Vectors are
    packed into blocks of near ones; a query meets only blocks that can hold one of its n best
    (:func:`block_pairs`), one matrix product each. No query or vector passes through the driver but the
    pivots. Zero, null and non-finite vectors are no one's neighbours and have none."""
    spark = vectors.sparkSession
    path = shared_path(spark, f"blocks-{uuid.uuid4().hex}")
    vector_blocks(vectors, id_col, vec_col).write.parquet(path)
    blocks = spark.read.parquet(path)
    pairs = block_pairs(blocks, queries.select(F.col(qid_col).alias("id"), F.col(qvec_col).alias("v")), n)
    w = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), F.col("vec_id").asc())
    return _scored(blocks, pairs, n).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def moments(vectors: DataFrame, vec_col: str) -> DataFrame:
    """H4: (i, j, cov), the covariances of the parts of a vector column. Tasks sum d x d products; only these
    cells are shuffled. Null vectors, and those with a null part, are left out."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(vec_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))

    def run(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            x = np.hstack([x, np.ones((len(x), 1))])
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.divmod(np.arange(total.size), len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.where(i == len(total) - 1, -1, i)), pa.array(np.where(j == len(total) - 1, -1, j)), pa.array(total.ravel())], names=["i", "j", "s"])
    sums = rows.mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    n = sums.where("i = -1 and j = -1").select(F.col("s").alias("n"), F.lit(1).alias("_k"))
    mean = sums.where("i >= 0 and j = -1").select(F.col("i").alias("k"), F.col("s").alias("sum"))
    cells = sums.where("i >= 0 and j >= 0").withColumn("_k", F.lit(1)).join(F.broadcast(n), "_k")  # one row
    cells = cells.join(mean.select(F.col("k").alias("i"), F.col("sum").alias("si")), "i").join(mean.select(F.col("k").alias("j"), F.col("sum").alias("sj")), "j")
    return cells.select("i", "j", (F.col("s") / F.col("n") - F.col("si") / F.col("n") * (F.col("sj") / F.col("n"))).alias("cov"))


def explained_variance(cov: DataFrame, k: int = 5, rounds: int = 100) -> DataFrame:
    """H4: (component, ratio) of the k largest components: ``rounds`` steps of the power iteration from (1, 2, ..., d),
    then deflation, on the d x d matrix as one row of arrays."""
    m = cov.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "cov"))), lambda x: x["cov"]).alias("row"))
    m = m.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "row"))), lambda x: x["row"]).alias("m")).where(F.size("m") > 0)
    trace = F.aggregate(F.transform("m", lambda r, i: F.get(r, i)), F.lit(0.0), lambda a, x: a + x)
    t = m.select("m", trace.alias("trace"))
    for c in range(k):
        size = F.size("m")
        t = t.withColumn("v", unit(F.transform(F.sequence(F.lit(1), size), lambda i: i.cast("double"))))
        t = t.withColumn("v", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("v"), lambda v, _: unit(F.transform(F.col("m"), lambda r: dot(r, v)))))
        t = t.withColumn(f"l{c}", dot(F.transform(F.col("m"), lambda r: dot(r, F.col("v"))), F.col("v")))
        z = F.arrays_zip(F.col("m").alias("r"), F.col("v").alias("x"))
        t = t.withColumn("m", F.transform(z, lambda p: F.zip_with(p["r"], F.col("v"), lambda a, y: a - F.col(f"l{c}") * p["x"] * y)))
    parts = F.array(*(F.struct(F.lit(c).alias("component"), (F.col(f"l{c}") / F.col("trace")).alias("ratio")) for c in range(k)))
    return t.select(F.explode(parts).alias("p")).select("p.component", "p.ratio")


def distribution(df: DataFrame, group_cols: list[str], item_col: str) -> DataFrame:
    """(groups..., item, count, p) — a distribution from counts."""
    c = df.groupBy(*group_cols, item_col).agg(F.count(F.lit(1)).alias("count"))
    tot = c.groupBy(*group_cols).agg(F.sum("count").alias("_tot"))
    if group_cols:
        return c.join(tot, group_cols)
    return c.withColumn("_k", F.lit(1)).join(F.broadcast(tot.withColumn("_k", F.lit(1))), "_k").drop("_k")


#: Groups of count arrays a task holds at once, and bytes counted in one go.
COUNT_GROUPS, COUNT_BYTES = 64, 1 << 19


def byte_counts(df: DataFrame, text_col: str, group_cols: list[str] = (), pairs: bool = False) -> DataFrame:
    """Per group, how often each byte stands in the texts (UTF-8): (groups..., byte, n). With ``pairs``
    also adjacent bytes of a text, overlaps counted: (groups..., left, right, n), where a single
    byte has no ``right``. Tasks fill arrays of 256 and 65,536 cells; only cells are shuffled."""
    ship(df.sparkSession)
    rows = df.select(*group_cols, F.col(text_col).alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()), T.StructField("n", T.LongType())])
    n_groups = len(group_cols)

    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        out = None

        def cells():
            for group, count in held.items():
                at = np.flatnonzero(count)
                right = np.where(at < 256, 0, (at - 256) & 255)
                left = np.where(at < 256, at, (at - 256) >> 8)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([g] * len(at), f.type) for g, f in zip(group, out)), pa.array(left.astype(np.int32)),
                     pa.array(right.astype(np.int32), mask=at < 256), pa.array(count[at])], names=schema.names)
            held.clear()
        for b in batches:
            out = list(b.schema)[:n_groups]
            data, off = merging.text_bytes(b.column(n_groups))
            keys = list(zip(*(b.column(i).to_pylist() for i in range(n_groups)))) if n_groups else [()] * b.num_rows
            number: dict[tuple, int] = {}
            group = np.fromiter((number.setdefault(k, len(number)) for k in keys), np.int64, len(keys))
            names = list(number)
            for lo, hi, a, z in merging.spans(np.diff(off), COUNT_BYTES):
                size = np.diff(off[lo:hi + 1])
                of = np.repeat(group[lo:hi], size)
                byte = data[a:z].astype(np.int64)
                for g in np.unique(of):
                    own = of == g
                    if len(held) >= COUNT_GROUPS and names[g] not in held:
                        yield from cells()
                    count = held.setdefault(names[g], np.zeros(256 + 65536 * pairs, np.int64))
                    count[:256] += np.bincount(byte[own], minlength=256)
                    if pairs:
                        at = np.flatnonzero(own & ~merging.last_flags(size))
                        count[256:] += np.bincount((byte[at] << 8) | byte[at + 1], minlength=65536)
        if held:
            yield from cells()
    total = rows.mapInArrow(run, schema).groupBy(*group_cols, "left", "right").agg(F.sum("n").alias("n"))
    return total if pairs else total.select(*group_cols, F.col("left").alias("byte"), "n")


def shares(counts: DataFrame, group_cols: list[str], count_col: str = "n") -> DataFrame:
    """Adds ``p``, each count's share of its group's sum. A group has few rows (cells of a count array)."""
    w = Window.partitionBy(*group_cols)
    return counts.withColumn("p", F.col(count_col) / F.sum(count_col).over(w))


def entropy(dist: DataFrame, group_cols: list[str], p_col: str = "p") -> DataFrame:
    """H5: entropy in nats and bits, plus the largest self-information."""
    p = F.col(p_col)
    return dist.groupBy(*group_cols).agg(
        (-F.sum(p * F.log(p))).alias("entropy_nat"),
        (-F.sum(p * F.log(p)) / F.lit(math.log(2.0))).alias("entropy_bit"),
        F.max(-F.log(p)).alias("max_self_info_nat"))


def divergences(pairs: DataFrame, group_cols: list[str]) -> DataFrame:
    """H6/H7: cross-entropy H(p,q), KL(p||q), H(p) and Jensen-Shannon of each group. Rows are the
    items of the union support with their ``p`` and ``q`` (0 where an item is missing)."""
    m = (F.col("p") + F.col("q")) / 2
    xlogy = lambda x, y: F.when(x > 0, x * F.log(y)).otherwise(F.lit(0.0))
    return pairs.groupBy(*group_cols).agg(
        (-F.sum(xlogy(F.col("p"), F.col("q")))).alias("cross_entropy"),
        (-F.sum(xlogy(F.col("p"), F.col("p")))).alias("entropy_p"),
        F.sum(xlogy(F.col("p"), F.col("p")) - xlogy(F.col("p"), F.col("q"))).alias("kl"),
        (F.lit(0.5) * F.sum(xlogy(F.col("p"), F.col("p")) - xlogy(F.col("p"), m))
         + F.lit(0.5) * F.sum(xlogy(F.col("q"), F.col("q")) - xlogy(F.col("q"), m))).alias("js"))


def mutual_information(df: DataFrame, x_col: str, y_col: str) -> DataFrame:
    """H8: I(X;Y) = sum p(x,y) ln(p(x,y) / (p(x) p(y))) from a joint and two marginal
    counts (all small aggregates)."""
    joint = df.groupBy(x_col, y_col).agg(F.count(F.lit(1)).alias("nxy"))
    px = df.groupBy(x_col).agg(F.count(F.lit(1)).alias("nx"))
    py = df.groupBy(y_col).agg(F.count(F.lit(1)).alias("ny"))
    n = df.agg(F.count(F.lit(1)).alias("n")).withColumn("_k", F.lit(1))
    j = joint.join(px, x_col).join(py, y_col).withColumn("_k", F.lit(1)).join(F.broadcast(n), "_k")
    pxy = F.col("nxy") / F.col("n")
    return j.agg(F.sum(pxy * F.log(pxy / ((F.col("nx") / F.col("n")) * (F.col("ny") / F.col("n"))))).alias("mutual_info"))


def perplexity(df: DataFrame, group_cols: list[str], logp_col: str) -> DataFrame:
    """H9: exp(mean NLL) per slice (no group columns = overall)."""
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    return g.agg(F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
                 F.avg(-F.col(logp_col)).alias("mean_nll"),
                 F.exp(F.avg(-F.col(logp_col))).alias("perplexity"))


def pair_scores(pairs: DataFrame, unigrams: DataFrame) -> DataFrame:
    """count(AB) / (count(A) * count(B)); ``pairs`` (left, right, count),
    ``unigrams`` (token, count)."""
    ua = unigrams.select(F.col("token").alias("left"), F.col("count").alias("ca"))
    ub = unigrams.select(F.col("token").alias("right"), F.col("count").alias("cb"))
    return pairs.join(ua, "left").join(ub, "right").withColumn(
        "score", F.col("count") / (F.col("ca").cast("double") * F.col("cb")))


def plateau(log: DataFrame, step_col: str, loss_col: str, window: int = 1000, min_drop: float = 0.01) -> DataFrame:
    """Loss fell by less than ``min_drop`` over the last ``window`` steps. The lag is
    an equi-join on step - window (no global window ordering)."""
    past = log.select((F.col(step_col) + window).alias(step_col), F.col(loss_col).alias("_past"))
    j = log.join(past, step_col)
    return j.withColumn("drop", F.col("_past") - F.col(loss_col)).withColumn("plateau", F.col("drop") < min_drop)


def epoch_summary(log: DataFrame, epoch_col: str, step_col: str, loss_col: str) -> DataFrame:
    """Mean loss per epoch, first and last loss of the epoch."""
    return log.groupBy(epoch_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_steps"), F.avg(loss_col).alias("mean_loss"),
        F.min_by(loss_col, step_col).alias("first_loss"), F.max_by(loss_col, step_col).alias("last_loss"))


def log_steps(log: DataFrame, step_col: str, total: Column | int, interval: int) -> DataFrame:
    """Steps that are logged: step % interval == 0 or the last step."""
    t = F.lit(total) if isinstance(total, int) else total
    return log.where((F.col(step_col) % interval == 0) | (F.col(step_col) == t))


def duration_label(seconds: Column) -> Column:
    """45s / 2m05s / 1h03m, with Python's round-half-even number formatting."""
    s = seconds.cast("double")
    r0 = lambda x: F.bround(x, 0).cast("bigint")
    minutes = F.floor(s / 60)
    secs = s - minutes * 60
    hours = F.floor(minutes / 60)
    mins = minutes - hours * 60
    return (F.when(s < 60, F.format_string("%ds", r0(s)))
            .when(minutes < 60, F.format_string("%dm%02ds", minutes.cast("bigint"), r0(secs)))
            .otherwise(F.format_string("%dh%02dm", hours.cast("bigint"), mins.cast("bigint"))))


def power_law_fit(runs: DataFrame, n_col: str, loss_col: str) -> DataFrame:
    """ln(loss) = alpha ln(Nc) - alpha ln(N); returns alpha, Nc and ln(Nc)."""
    fit = runs.agg(F.regr_slope(F.log(loss_col), F.log(n_col)).alias("slope"),
                   F.regr_intercept(F.log(loss_col), F.log(n_col)).alias("intercept"),
                   F.count(F.lit(1)).cast("bigint").alias("n_runs"))
    return fit.select("n_runs", (-F.col("slope")).alias("alpha"),
                      F.exp(F.col("intercept") / (-F.col("slope"))).alias("n_c"),
                      (F.col("intercept") / (-F.col("slope"))).alias("log_n_c"))
