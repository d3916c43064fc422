"""Metrics over logged per-token values.

Logits are kept as one ``ARRAY<DOUBLE>`` per position, so softmax-style metrics are
map-side array expressions (no shuffle). Per-token logs are long tables
``(seq keys, pos, ...)``; per-sequence reductions are ``groupBy`` with map-side partial
aggregation, and batch statistics are small aggregates joined back.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path, ship


# --- array helpers --------------------------------------------------------------

def logsumexp(arr: Column) -> Column:
    """One pass, online: carry (running max, scaled sum); no outer reference inside
    the lambda (Catalyst re-evaluates those per element)."""
    init = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, x):
        m = F.greatest(acc["m"], x)
        return F.struct(m.alias("m"), (acc["s"] * F.exp(acc["m"] - m) + F.exp(x - m)).alias("s"))
    return F.aggregate(arr, init, step, lambda acc: acc["m"] + F.log(acc["s"]))


def log_softmax(arr: Column, temperature: float = 1.0) -> Column:
    """The normaliser travels with each element (zip), not as an outer expression."""
    scaled = F.transform(arr, lambda x: x / F.lit(temperature)) if temperature != 1.0 else arr
    z = F.arrays_zip(scaled.alias("x"), F.array_repeat(logsumexp(scaled), F.size(scaled)).alias("z"))
    return F.transform(z, lambda p: p["x"] - p["z"])


def softmax(arr: Column, temperature: float = 1.0) -> Column:
    return F.transform(log_softmax(arr, temperature), lambda x: F.exp(x))


def pick(arr: Column, index: Column) -> Column:
    return F.element_at(arr, index + 1)


def softplus(z: Column) -> Column:
    """log(1 + exp(z)) in a stable form."""
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0))


# --- E1-E3 ------------------------------------------------------------------------

def label_log_prob(logits: Column, label: Column) -> Column:
    """Log-softmax, then the label's entry."""
    return pick(logits, label) - logsumexp(logits)


def next_token_ce(df: DataFrame, seq_cols: list[str], pos_col: str, logits_col: str,
                  label_col: str, ignore_index: int = -100) -> DataFrame:
    """Logits at t vs label at t+1 within a sequence; -100 skipped; mean over all
    kept tokens (NULL when nothing is kept)."""
    w = Window.partitionBy(*seq_cols).orderBy(pos_col)
    shifted = df.withColumn("_next", F.lead(label_col).over(w)).where(
        F.col("_next").isNotNull() & (F.col("_next") != ignore_index))
    nll = -label_log_prob(F.col(logits_col), F.col("_next"))
    return shifted.agg(F.count(F.lit(1)).cast("bigint").alias("n_tokens"), F.avg(nll).alias("ce"))


def masked_ce(df: DataFrame, logits_col: str, label_col: str, mask_col: str,
              ignore_index: int = -100) -> DataFrame:
    """sum(ce * mask) / (sum(mask) + 1e-8); ignored labels contribute 0."""
    ce = F.when(F.col(label_col) == ignore_index, F.lit(0.0)).otherwise(
        -label_log_prob(F.col(logits_col), F.col(label_col)))
    return df.agg((F.sum(ce * F.col(mask_col)) / (F.sum(F.col(mask_col)) + F.lit(1e-8))).alias("ce"))


# --- E4-E9 ------------------------------------------------------------------------

def masked_seq_sums(df: DataFrame, seq_cols: list[str], values: dict[str, str], mask_col: str) -> DataFrame:
    """Per-sequence masked sums of log-probs, ``values`` maps output to input column."""
    return df.groupBy(*seq_cols).agg(*(F.sum(F.col(v) * F.col(mask_col)).alias(k) for k, v in values.items()))


def preference_loss(seq_sums: DataFrame, pair_cols: list[str], side_col: str,
                    beta: float = 0.15) -> DataFrame:
    """E5: -logsigmoid(beta * ((pi_c - pi_r) - (ref_c - ref_r))) per pair; NULL for a pair that lacks a
    side. ``seq_sums`` holds ``policy`` and ``ref`` sums with ``side`` 0 = chosen, 1 = rejected."""
    def of(col: str, side: int) -> Column:
        return F.max(F.when(F.col(side_col) == side, F.col(col)))
    z = F.lit(beta) * ((of("policy", 0) - of("policy", 1)) - (of("ref", 0) - of("ref", 1)))
    return seq_sums.groupBy(*pair_cols).agg(softplus(-z).alias("loss"))


def preference_mean(pair_losses: DataFrame) -> DataFrame:
    """E5: the mean loss over pairs, with the numbers of pairs and of unpaired sequences."""
    return pair_losses.agg(F.avg("loss").alias("loss"), F.count("loss").alias("n_pairs"),
                           F.count(F.when(F.col("loss").isNull(), 1)).alias("n_unpaired"))


def per_token_kl(ref: Column, policy: Column) -> Column:
    """exp(ref - policy) - (ref - policy) - 1."""
    d = ref - policy
    return F.exp(d) - d - F.lit(1.0)


def group_advantages(df: DataFrame, group_cols: list[str], reward_col: str,
                     num_generations: int, strict: bool = True) -> DataFrame:
    """(r - mean) / (population std + 1e-4) per prompt group. A group whose size is not
    ``num_generations`` raises (the reference cannot reshape such a batch), or with
    ``strict=False`` has NULL advantages."""
    stats = df.groupBy(*group_cols).agg(F.avg(reward_col).alias("_mean"), F.stddev_pop(reward_col).alias("_std"),
                                        F.count(F.lit(1)).alias("_n"))
    out = df.join(stats, group_cols)
    adv = (F.col(reward_col) - F.col("_mean")) / (F.col("_std") + F.lit(1e-4))
    wrong = F.raise_error(F.lit(f"group size differs from num_generations={num_generations}")) if strict else F.lit(None)
    # the size check is part of the output expression, so it cannot be pruned away
    checked = F.when(F.col("_n") != num_generations, wrong.cast("double")).otherwise(adv)
    return out.withColumn("advantage", checked).drop("_mean", "_std", "_n")


def _seq_masked_mean_then_mean(df: DataFrame, seq_cols: list[str], loss: Column, mask_col: str) -> DataFrame:
    per_seq = df.groupBy(*seq_cols).agg(
        (F.sum(loss * F.col(mask_col)) / F.greatest(F.sum(F.col(mask_col)), F.lit(1))).alias("seq_loss"))
    return per_seq.agg(F.avg("seq_loss").alias("loss"), F.count(F.lit(1)).cast("bigint").alias("n_seqs"))


def grpo_loss(df: DataFrame, seq_cols: list[str], policy: str, old: str, ref: str, adv: str, mask: str,
              beta: float = 0.1, epsilon: float = 0.2) -> DataFrame:
    """-(min(ratio A, clip(ratio, 1 +- eps) A) - beta KL), masked mean per sequence
    (denominator at least 1), then the mean over sequences."""
    ratio = F.exp(F.col(policy) - F.col(old))
    a = F.col(adv)
    clipped = F.least(F.greatest(ratio, F.lit(1 - epsilon)), F.lit(1 + epsilon))
    tok = -(F.least(ratio * a, clipped * a) - F.lit(beta) * per_token_kl(F.col(ref), F.col(policy)))
    return _seq_masked_mean_then_mean(df, seq_cols, tok, mask)


def cispo_loss(df: DataFrame, seq_cols: list[str], policy: str, old: str, ref: str, adv: str, mask: str,
               beta: float = 0.1, epsilon_high: float = 5.0) -> DataFrame:
    """-(min(ratio, eps_high) A logp - beta KL), same reduction."""
    ratio = F.least(F.exp(F.col(policy) - F.col(old)), F.lit(epsilon_high))
    tok = -(ratio * F.col(adv) * F.col(policy) - F.lit(beta) * per_token_kl(F.col(ref), F.col(policy)))
    return _seq_masked_mean_then_mean(df, seq_cols, tok, mask)


# --- E10-E13 ----------------------------------------------------------------------

#: Steps of one piece of the advantage scan.
GAE_PIECE = 1 << 18


def _back_scan(start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x[t] = start[t] + step[t] * x[t + 1] for all t at once, as (value if what follows the last step is
    0, how much of what follows reaches t). Pairs (start, step) are composed by doubling."""
    start, step, n = start.copy(), step.copy(), 1
    while n < len(start) and step[:-n].any():
        start[:-n] += step[:-n] * start[n:]
        step[:-n] *= step[n:]
        n *= 2
    return start, step


def _pieces(rows: DataFrame, keys: int, gamma: float, c: float) -> DataFrame:
    """Sorted rows packed into pieces. A piece says which sequence is first and last in it, and what its
    first advantage is: ``first_local`` + ``reach`` * (what follows the piece), if it is all one sequence."""
    def run(batches):
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def piece(table: pa.Table):
            nonlocal n
            delta, step, key = _deltas(table, keys, gamma, c)
            a, reach = _back_scan(delta, step)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            n += 1
            one = len(np.unique(key)) == 1
            return pa.RecordBatch.from_pydict(
                {"piece": [(part << 32) + n], "first": [repr(table.slice(0, 1).select(range(keys)).to_pylist()[0])],
                 "last": [repr(table.slice(table.num_rows - 1).select(range(keys)).to_pylist()[0])], "value": [_number(table, keys + 2)[0]],
                 "local": [a[0]], "reach": [reach[0] if one else 0.0], "blob": [sink.getvalue().to_pybytes()]}, schema=_PIECE_ARROW)
        for b in batches:
            for lo in range(0, b.num_rows, GAE_PIECE):
                held.append(b.slice(lo, GAE_PIECE))
                size += held[-1].num_rows
                if size >= GAE_PIECE:
                    yield piece(pa.Table.from_batches(held).combine_chunks())
                    held, size = [], 0
        if size:
            yield piece(pa.Table.from_batches(held).combine_chunks())
    return rows.mapInArrow(run, _PIECE)


_PIECE = "piece long, first string, last string, value double, local double, reach double, blob binary"
_PIECE_ARROW = pa.schema([("piece", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("value", pa.float64()),
                          ("local", pa.float64()), ("reach", pa.float64()), ("blob", pa.binary())])


def _number(table: pa.Table, i: int) -> np.ndarray:
    return table.column(i).cast(pa.float64()).fill_null(0.0).to_numpy()


def _deltas(table: pa.Table, keys: int, gamma: float, c: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """delta and step of each row as if a value of 0 followed the piece, and the number of its sequence."""
    n = table.num_rows
    new = np.zeros(n, bool)
    for i in range(keys):
        col = table.column(i).combine_chunks().dictionary_encode()
        code = (col.chunk(0) if isinstance(col, pa.ChunkedArray) else col).indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    key = np.cumsum(new)
    reward, value = _number(table, keys + 1), _number(table, keys + 2)
    goes_on = np.r_[~new[1:], True]  # the last row may go on in the next piece
    after = np.where(goes_on, np.r_[value[1:], 0.0], 0.0)
    return reward + gamma * after - value, np.where(goes_on, c, 0.0), key


def gae(df: DataFrame, seq_cols: list[str], pos_col: str, reward_col: str, value_col: str,
        gamma: float = 1.0, lam: float = 0.95, carry: tuple[str, ...] = ()) -> DataFrame:
    """A_t = delta_t + gamma*lam*A_{t+1}, delta_t = r_t + gamma V_{t+1} - V_t, with
    V after the last step = 0; the mask is not used in the recursion. Null rewards and values
    count as 0. Columns in ``carry`` travel along, so nothing is joined back.

    Rows are ranged by sequence and position and packed into pieces of ``GAE_PIECE`` steps; a
    sequence may lie in any number of them. Within a piece the recursion is an associative scan over
    all its sequences at once; from piece to piece a table of one row per piece is carried."""
    spark = df.sparkSession
    ship(spark)
    c = gamma * lam
    keys = len(seq_cols)
    cols = list(dict.fromkeys([*seq_cols, pos_col, *carry, reward_col, value_col]))
    # fixed places: the keys, position, reward, value; then what travels along
    rows = df.select(*seq_cols, F.col(pos_col).alias("_pos"), F.col(reward_col).alias("_reward"), F.col(value_col).alias("_value"),
                     *(F.col(x) for x in cols if x not in seq_cols))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *seq_cols, "_pos").sortWithinPartitions(*seq_cols, "_pos")
    path = shared_path(spark, f"pieces-{uuid.uuid4().hex}")
    _pieces(ranged, keys, gamma, c).write.parquet(path)
    pieces = spark.read.parquet(path)
    follows, after = {}, None
    for p in reversed(sorted(pieces.drop("blob").collect())):  # one small row per piece
        own = after is not None and after[0] == p["last"]
        follows[p["piece"]] = (after[1], after[2]) if own else (0.0, 0.0)
        a, v = follows[p["piece"]]
        # the last step's delta gains gamma * v, its advantage also c * a; both fade with reach on the way to the first step
        first = p["local"] + (p["reach"] * (a + (gamma * v / c if c else 0.0)) if own else 0.0)
        if own and not c and p["reach"] == 0.0 and p["first"] == p["last"]:
            first = None  # without discounting only a piece of one step feels what follows
        after = (p["first"], p["local"] if first is None else first, p["value"])
    shared = spark.sparkContext.broadcast(follows)
    schema = T.StructType([*rows.schema.fields[:keys], *rows.schema.fields[keys + 3:], T.StructField("advantage", T.DoubleType())])

    def run(batches):
        for b in batches:
            for number, blob in zip(b.column("piece").to_pylist(), b.column("blob")):
                with pa.ipc.open_stream(blob.as_buffer()) as r:
                    table = r.read_all().combine_chunks()
                delta, step, _ = _deltas(table, keys, gamma, c)
                a, v = shared.value[number]
                delta[-1] += gamma * v + c * a
                step[-1] = 0.0
                out = table.select([*range(keys), *range(keys + 3, table.num_columns)]).append_column("advantage", pa.array(_back_scan(delta, step)[0]))
                yield from out.to_batches()
    return pieces.select("piece", "blob").mapInArrow(run, schema)


def normalise_advantages(df: DataFrame, batch_cols: list[str], adv_col: str, mask_col: str,
                         value_col: str, raw_returns: bool = False) -> DataFrame:
    """Advantages * mask; masked mean and variance of each batch, in one aggregation; if var >
    1e-6 normalise ((a - mean) * rsqrt(var + 1e-8) * mask); returns = advantages + values
    (T11: the normalised advantages, or with ``raw_returns`` those before). The mask is 0 or 1.
    The batch table is small beside the log; Spark broadcasts it or splits a hot batch."""
    a = F.col(adv_col) * F.col(mask_col)
    inside = F.when(F.col(mask_col) != 0, F.col(adv_col))
    stats = df.groupBy(*batch_cols).agg(F.coalesce(F.avg(inside), F.lit(0.0)).alias("_mean"),
                                        F.coalesce(F.var_pop(inside), F.lit(0.0)).alias("_var"))
    staged = df.join(stats, batch_cols)
    norm = F.when(F.col("_var") > 1e-6, (a - F.col("_mean")) / F.sqrt(F.col("_var") + F.lit(1e-8))
                  * F.col(mask_col)).otherwise(a)
    return (staged.withColumn("norm_advantage", norm)
            .withColumn("returns", (F.col(adv_col) if raw_returns else F.col("norm_advantage")) + F.col(value_col))
            .drop("_mean", "_var"))


def ppo_policy_loss(df: DataFrame, seq_cols: list[str], new: str, old: str, adv: str, mask: str,
                    clip_epsilon: float = 0.2) -> DataFrame:
    """-min(ratio A, clip(ratio) A), masked mean per sequence, then mean."""
    ratio = F.exp(F.col(new) - F.col(old))
    a = F.col(adv)
    clipped = F.least(F.greatest(ratio, F.lit(1 - clip_epsilon)), F.lit(1 + clip_epsilon))
    return _seq_masked_mean_then_mean(df, seq_cols, -F.least(ratio * a, clipped * a), mask)


def ppo_value_loss(df: DataFrame, seq_cols: list[str], values: str, old_values: str, returns: str,
                   mask: str, cliprange: float = 0.2) -> DataFrame:
    """0.5 * max((V - R)^2, (clip(V, Vold +- c) - R)^2), same reduction."""
    v, vo, r = F.col(values), F.col(old_values), F.col(returns)
    vc = F.least(F.greatest(v, vo - cliprange), vo + cliprange)
    tok = F.lit(0.5) * F.greatest(F.pow(v - r, 2), F.pow(vc - r, 2))
    return _seq_masked_mean_then_mean(df, seq_cols, tok, mask)


# --- E14-E18 ----------------------------------------------------------------------

def distill_kl_row(student: Column, teacher: Column, temperature: float = 1.0) -> Column:
    """Per-row sum_i p_t (log p_t - log p_s) at a temperature."""
    lt = log_softmax(teacher, temperature)
    ls = log_softmax(student, temperature)
    return F.aggregate(F.zip_with(lt, ls, lambda a, b: F.exp(a) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)


def distillation_loss(df: DataFrame, student_col: str, teacher_col: str, temperature: float = 1.0) -> DataFrame:
    """T^2 * sum KL / number of rows ("batchmean" over flattened positions, T13)."""
    kl = distill_kl_row(F.col(student_col), F.col(teacher_col), temperature)
    return df.agg((F.lit(temperature ** 2) * F.sum(kl) / F.count(F.lit(1))).alias("distill"),
                  F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def mixed_distillation_loss(df: DataFrame, student_col: str, teacher_col: str | None, label_col: str,
                            mask_col: str, alpha: float = 0.5, temperature: float = 1.0) -> DataFrame:
    """Alpha * masked CE + (1 - alpha) * distillation over mask == 1 rows; the
    teacher is cut to the student's vocabulary before its softmax; distillation is 0
    without a teacher or when alpha >= 1."""
    ce = masked_ce(df, student_col, label_col, mask_col).withColumn("_k", F.lit(1))
    if teacher_col is None or alpha >= 1.0:
        d = df.sparkSession.range(1).select(F.lit(0.0).alias("distill"), F.lit(1).alias("_k"))
    else:
        cut = F.slice(F.col(teacher_col), 1, F.size(F.col(student_col)))
        kept = df.where(F.col(mask_col) == 1).withColumn("_t", cut)
        d = distillation_loss(kept, student_col, "_t", temperature).select(
            F.coalesce("distill", F.lit(0.0)).alias("distill"), F.lit(1).alias("_k"))
    return ce.join(d, "_k").select("ce", "distill",
                                   (F.lit(alpha) * F.col("ce") + F.lit(1 - alpha) * F.col("distill")).alias("loss"))


def route_experts(df: DataFrame, key_cols: list[str], gate_col: str, k: int = 1,
                  norm_topk_prob: bool = True) -> DataFrame:
    """Softmax over experts, top-k (ties to the lower expert id), weights renormalised
    with +1e-20. One row per (token, chosen expert)."""
    scores = softmax(F.col(gate_col))
    ranked = F.slice(F.array_sort(F.transform(scores, lambda s, i: F.struct((-s).alias("neg"), i.alias("expert")))), 1, k)
    total = F.aggregate(ranked, F.lit(0.0), lambda acc, x: acc - x["neg"])
    out = df.select(*key_cols, scores.alias("scores"), ranked.alias("_top"), total.alias("_tot"))
    out = out.select(*key_cols, "scores", "_tot", F.posexplode("_top").alias("slot", "_t"))
    w = -F.col("_t.neg")
    if norm_topk_prob:
        w = w / (F.col("_tot") + F.lit(1e-20))
    return out.select(*key_cols, "scores", "slot", F.col("_t.expert").cast("int").alias("expert"), w.alias("weight"))


def load_balance(routed: DataFrame, layer_cols: list[str] = (), coef: float = 5e-4) -> DataFrame:
    """E17, per layer: sum_e (tokens routed to e / N) * mean score_e * E * coef, where E is the number
    of scores a token has. Every term is an aggregate; the per-expert table has E rows a layer."""
    keys = list(layer_cols)
    per_tok = routed.where(F.col("slot") == 0).select(*keys, "scores")
    scores = per_tok.select(*keys, F.size("scores").alias("_e"), F.posexplode("scores").alias("expert", "s")).groupBy(*keys, "expert").agg(
        F.sum("s").alias("sum_s"), F.count(F.lit(1)).alias("n_tok"), F.max("_e").alias("n_experts"))
    loads = routed.groupBy(*keys, "expert").agg(F.count(F.lit(1)).alias("n_routed"))
    joined = scores.join(loads, [*keys, "expert"], "left")
    term = (F.coalesce("n_routed", F.lit(0)) / F.col("n_tok")) * (F.col("sum_s") / F.col("n_tok"))
    return joined.groupBy(*keys).agg((F.sum(term * F.col("n_experts")) * F.lit(coef)).alias("aux_loss"))


def loss_with_routing(ce: DataFrame, per_layer: DataFrame) -> DataFrame:
    """The training loss of a routed model: E2's cross-entropy plus the layers' E17 values (0 without layers)."""
    aux = per_layer.agg(F.coalesce(F.sum("aux_loss"), F.lit(0.0)).alias("aux_loss"), F.lit(1).alias("_k"))
    return ce.withColumn("_k", F.lit(1)).join(aux, "_k").drop("_k").withColumn("loss", F.col("ce") + F.col("aux_loss"))


def kl_early_stop(df: DataFrame, batch_cols: list[str], old: str, new: str, threshold: float = 0.25) -> DataFrame:
    """E18 (definition, the reference declares but never uses it): stop when the mean
    (old - new) log-prob gap of a batch exceeds the threshold."""
    return df.groupBy(*batch_cols).agg(F.avg(F.col(old) - F.col(new)).alias("approx_kl")).withColumn(
        "stop", F.col("approx_kl") > threshold)
