"""Next-token candidate selection over a table of logits (G1-G8): one decoding step
for many rows at once, without a shuffle. Selection inside a row is an array expression;
the steps that need an order or a place in the row (penalty, top-p, draw) work on the flat
values of a whole Arrow batch, at the cost of one sort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import uniform
from ..session import ship_active

NEG_INF = float("-inf")


def greedy(logits: Column) -> Column:
    """G1: argmax; ties go to the lowest token id."""
    best = F.array_max(F.transform(logits, lambda x, i: F.struct(x.alias("l"), (-i).alias("neg_id"))))
    return (-best["neg_id"]).cast("int")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column (null: NaN or -1), and where each row begins (n+1)."""
    size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    values = lists.flatten()
    if values.null_count:
        values = values.fill_null(float("nan") if pa.types.is_floating(values.type) else -1)
    return values.to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(size)]


def _lists(values: np.ndarray, off: np.ndarray, like: pa.Array) -> pa.Array:
    null = pc.is_null(like).to_numpy(zero_copy_only=False)
    mask = pa.py_buffer(np.packbits(~null, bitorder="little").tobytes()) if null.any() else None
    return pa.Array.from_buffers(pa.list_(pa.float64()), len(off) - 1, [mask, pa.py_buffer(off.astype(np.int32).tobytes())], children=[pa.array(values)])


def _row_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.add.reduceat(np.r_[values, 0.0], off[:-1]) * (np.diff(off) > 0) if len(off) > 1 else np.zeros(0)


def apply_repetition_penalty(logits: Column, seen: Column, penalty: float) -> Column:
    """G5 (per row, T4): seen tokens: positive logits / penalty, others * penalty. The seen ids
    index the row's values; ids outside of it, repeated and null ids change nothing."""
    if penalty == 1.0:
        return logits
    ship_active()

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def penalised(rows: pa.Array, ids: pa.Array) -> pa.Array:
        x, off = _flat(rows)
        token, first = _flat(ids)
        row = np.repeat(np.arange(len(ids)), np.diff(first))
        token = token.astype(np.int64)
        good = (token >= 0) & (token < np.diff(off)[row])
        marked = np.zeros(len(x), bool)  # the bitmap of seen ids of all rows
        marked[off[:-1][row[good]] + token[good]] = True
        return _lists(np.where(marked, np.where(x > 0, x / penalty, x * penalty), x), off, rows)
    return penalised(logits, seen)


def top_k_filter(logits: Column, k: int) -> Column:
    """Keep logits >= the k-th largest (ties with it are kept); k capped at the
    vocabulary. The threshold travels with each element (zip), not as an outer
    expression inside the lambda (that would be re-evaluated per element)."""
    if k <= 0:
        return logits
    kk = F.least(F.lit(k), F.size(logits))
    kth = F.get(F.sort_array(logits, asc=False), kk - 1)
    return F.transform(F.arrays_zip(logits.alias("x"), F.array_repeat(kth, F.size(logits)).alias("t")),
                       lambda z: F.when(z["x"] < z["t"], F.lit(NEG_INF)).otherwise(z["x"]))


def candidate_probs(df: DataFrame, logits_col: str, temperature: float = 1.0, top_k: int = 0,
                    repetition_penalty: float = 1.0, seen_col: str | None = None, out_col: str = "probs",
                    filtered_col: str | None = None) -> DataFrame:
    """G5 -> G2 -> G3: adds each row's probabilities by token id (0 where filtered), and on
    request its filtered logits. Row constants (k-th largest logit, max, normaliser) are
    staged as their own columns."""
    logits = F.col(logits_col)
    if seen_col is not None:
        logits = apply_repetition_penalty(logits, F.col(seen_col), repetition_penalty)
    t = df.withColumn("_s", F.transform(logits, lambda x: x / F.lit(temperature)))
    if top_k > 0:
        t = t.withColumn("_s", top_k_filter(F.col("_s"), top_k))
    t = t.withColumn("_m", F.array_max("_s"))
    t = t.withColumn("_e", F.transform(F.arrays_zip(F.col("_s").alias("x"), F.array_repeat("_m", F.size("_s")).alias("m")),
                                       lambda p: F.exp(p["x"] - p["m"])))
    t = t.withColumn("_tot", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    t = t.withColumn(out_col, F.transform(F.arrays_zip(F.col("_e").alias("e"), F.array_repeat("_tot", F.size("_e")).alias("t")), lambda p: p["e"] / p["t"]))
    if filtered_col:
        t = t.withColumn(filtered_col, F.col("_s"))
    return t.drop("_s", "_m", "_e", "_tot")


def candidate_table(df: DataFrame, key_cols: list[str], logits_col: str, temperature: float = 1.0,
                    top_k: int = 0, repetition_penalty: float = 1.0, seen_col: str | None = None) -> DataFrame:
    """The same as rows (keys..., token_id, logit, prob)."""
    t = candidate_probs(df, logits_col, temperature, top_k, repetition_penalty, seen_col, "_p", "_l")
    z = F.arrays_zip(F.col("_l").alias("logit"), F.col("_p").alias("prob"))
    return t.select(*key_cols, F.posexplode(z).alias("token_id", "_z")).select(
        *key_cols, F.col("token_id").cast("int").alias("token_id"), F.col("_z.logit").alias("logit"), F.col("_z.prob").alias("prob"))


def top_p_filter(probs: Column, top_p: float, strict: bool = False) -> Column:
    """Of a row's probabilities by token id, sorted by probability (ties by token id), the
    first is always kept; a later token is dropped when the mass before its predecessor
    already reaches p (T3: one token wider than the textbook set). With ``strict`` the textbook
    minimal set is kept instead. Kept probabilities are renormalised, the others are 0."""
    ship_active()

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def kept(rows: pa.Array) -> pa.Array:
        x, off = _flat(rows)
        n = np.diff(off)
        row = np.repeat(np.arange(len(n)), n)
        live = x > 0
        if top_p > 0:
            order = np.lexsort((np.arange(len(x)), -x, row))
            mass = np.cumsum(x[order])  # within a row, from its first token on
            start = np.r_[0.0, mass][off[:-1]][row]
            back = 1 if strict else 2
            place = np.arange(len(x)) - off[:-1][row]
            before = np.where(place >= back, np.r_[np.zeros(back), mass][:len(x)] - start, 0.0)
            live[order] &= before < top_p
        x = np.where(live, x, 0.0)
        return _lists(x / np.where(live, _row_sums(x, off)[row], 1.0), off, rows)
    return kept(probs)


def weighted_draw(probs: Column, key: Column, seed: int = 42) -> Column:
    """Inverse-CDF draw from a row's probabilities in token-id order, with a uniform by key:
    the first kept token whose running mass reaches it. NULL where no token is kept."""
    ship_active()

    @F.arrow_udf(T.IntegerType())
    def drawn(rows: pa.Array, u: pa.Array) -> pa.Array:
        x, off = _flat(rows)
        n = np.diff(off)
        row = np.repeat(np.arange(len(n)), n)
        mass = np.cumsum(x)
        mass = mass - np.r_[0.0, mass][off[:-1]][row]
        live = x > 0
        want = u.to_numpy(zero_copy_only=False)[row]
        at = np.flatnonzero(live & (mass >= want))
        out = np.full(len(n), -1, np.int64)
        out[row[at][::-1]] = (at - off[:-1][row[at]])[::-1]
        # rounding can leave the whole mass just under the draw: then the last kept token
        rest = np.flatnonzero(live & (out[row] < 0))
        out[row[rest]] = rest - off[:-1][row[rest]]
        return pa.array(out.astype(np.int32), mask=out < 0)
    return drawn(probs, uniform(key, "sample-draw", seed))


def stop_at_eos(tokens: Column, eos_id: int) -> Column:
    """G7 (per row): the logged output up to and including its first EOS."""
    p = F.array_position(tokens, F.lit(eos_id))
    return F.when(p > 0, F.slice(tokens, 1, p.cast("int"))).otherwise(tokens)


def batch_stop_step(steps: DataFrame, batch_cols: list[str], step_col: str, token_col: str,
                    eos_id: int) -> DataFrame:
    """G7 (batch rule): the first step at which every row's newest token is EOS."""
    per_step = steps.groupBy(*batch_cols, step_col).agg(F.bool_and(F.col(token_col) == eos_id).alias("_all"))
    return per_step.where("_all").groupBy(*batch_cols).agg(F.min(step_col).alias("stop_step"))


def tokens_per_second(df: DataFrame, group_cols: list[str], new_tokens: str, elapsed: str) -> DataFrame:
    """New tokens / max(elapsed, 1e-6)."""
    return df.groupBy(*group_cols).agg(F.sum(new_tokens).cast("bigint").alias("new_tokens"),
                                       F.sum(elapsed).alias("elapsed")).withColumn(
        "tokens_per_sec", F.col("new_tokens") / F.greatest(F.col("elapsed"), F.lit(1e-6)))
