"""Training-row builders.

Builders work on the code text of a rendered sample and convert to ``ARRAY<INT>`` at
the end; everything is map-side except the batch numbering (D13), which uses the skew-safe index.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as tk
from . import chat
from .ordering import ordered_index
from .vocab import Vocab, encode_corpus, encode_inline, ids_of, word_codes


def _code(vocab: Vocab, special: str) -> str:
    return tk.code_hex(tk.SPECIAL_BASE + vocab.specials.index(special))


def encode(df: DataFrame, key_cols: list[str], text_col: str, vocab: Vocab,
           out_col: str = "codes") -> DataFrame:
    if vocab.merges and vocab.presplit:
        return encode_corpus(df, text_col, vocab, out_col)
    return df.withColumn(out_col, encode_inline(F.col(text_col), vocab))


def chat_template(df: DataFrame, messages_col: str, vocab: Vocab, tokenize: bool = False,
                  add_generation_prompt: bool = False, open_thinking: bool = False) -> DataFrame:
    """Messages rendered (with the tools of the last system message) as ``prompt``, and with
    ``tokenize`` encoded as ``input_ids``."""
    tools = chat.normalise_tools(chat.last_system_tools(F.col(messages_col)))
    out = df.withColumn("prompt", chat.render_messages(F.col(messages_col), tools, open_thinking, add_generation_prompt))
    if not tokenize:
        return out
    return encode(out, [], "prompt", vocab, "_c").withColumn("input_ids", ids_of(F.col("_c"), vocab)).drop("_c")


def pad_codes(codes: Column, vocab: Vocab, max_length: int) -> Column:
    """Right-pad to max_length (a negative count pads nothing)."""
    missing = F.lit(max_length) - tk.n_tokens(codes)
    return F.concat(codes, F.repeat(F.lit(_code(vocab, tk.PAD)), F.greatest(missing, F.lit(0))))


def pretrain_rows(df: DataFrame, key_cols: list[str], text_col: str, vocab: Vocab,
                  max_length: int = 512) -> DataFrame:
    """Truncate to max_length-2, wrap in BOS/EOS, pad; labels = ids with pad -> -100.
    Adds ``input_ids``, ``labels`` and ``n_raw_tokens`` (length before truncation)."""
    staged = df.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("None")))
    staged = encode(staged, key_cols, "_text", vocab, "_codes")
    body = tk.truncate_codes(F.col("_codes"), max_length - 2)
    wrapped = F.concat(F.lit(_code(vocab, tk.BOS)), body, F.lit(_code(vocab, tk.EOS)))
    ids = ids_of(pad_codes(wrapped, vocab, max_length), vocab)
    pad = vocab.pad_id
    return (staged.withColumn("n_raw_tokens", tk.n_tokens(F.col("_codes")))
            .withColumn("input_ids", ids)
            .withColumn("labels", F.transform("input_ids", lambda x: F.when(x == pad, F.lit(-100)).otherwise(x)))
            .drop("_text", "_codes"))


def anchors(vocab: Vocab) -> tuple[str, str]:
    """Code text of '<|im_start|>assistant\\n' and '<|im_end|>\\n' (computed once)."""
    word, end = word_codes("assistant", vocab), word_codes("\n", vocab)
    return _code(vocab, tk.BOS) + word + end, _code(vocab, tk.EOS) + end


def span_flags(codes: Column, start_anchor: str, end_anchor: str) -> Column:
    """D6/D9 core: ARRAY<BOOLEAN>, true for tokens after each start anchor through the
    next end anchor inclusive (to the end when unterminated), scanning left to right
    and resuming after each span. The regex cuts the code text into 'prefix + one
    span' pieces; spaces occur only at token starts, so matches are token-aligned."""
    pattern = f"(.*?)({start_anchor})(.*?(?:{end_anchor}|$))|(.+)$"
    pieces = F.regexp_extract_all(codes, F.lit(pattern), 0)
    blen = len(start_anchor)
    meta = F.transform(pieces, lambda p: F.struct(tk.n_tokens(p).alias("n"),
                                                  F.instr(p, F.lit(start_anchor)).alias("k")))

    def piece_flags(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(s["n"] - 1, F.lit(0))),
                           lambda i: (s["k"] > 0) & (i * tk.TOKEN_WIDTH >= s["k"] - 1 + blen))

    return F.flatten(F.transform(F.filter(meta, lambda s: s["n"] > 0), piece_flags))


def label_mask(ids: Column, codes: Column, start_anchor: str, end_anchor: str) -> Column:
    """labels = id inside assistant spans, else -100."""
    return F.zip_with(ids, span_flags(codes, start_anchor, end_anchor),
                      lambda x, m: F.when(m, x).otherwise(F.lit(-100)))


def loss_mask(codes: Column, start_anchor: str, end_anchor: str) -> Column:
    """The same scan as 0/1."""
    return F.transform(span_flags(codes, start_anchor, end_anchor), lambda m: m.cast("int"))


def _tokenize_fixed(df: DataFrame, key_cols: list[str], text_col: str, vocab: Vocab,
                    max_length: int, out_prefix: str) -> DataFrame:
    staged = encode(df, key_cols, text_col, vocab, "_c")
    padded = pad_codes(tk.truncate_codes(F.col("_c"), max_length), vocab, max_length)
    return staged.withColumn(f"{out_prefix}codes", padded).drop("_c")


def _empty(messages_col: str) -> Column:
    return F.coalesce(F.size(messages_col) <= 0, F.lit(True))


def rejected_conversations(df: DataFrame, messages_col: str) -> DataFrame:
    """The number of conversations that give no training row, as a one-row DataFrame."""
    return df.agg(F.count(F.when(_empty(messages_col), 1)).alias("n_rejected"))


def sft_rows(df: DataFrame, key_col: str, messages_col: str, vocab: Vocab,
             max_length: int = 1024, add_system_ratio: float = 0.2,
             empty_think_ratio: float = 0.2, seed: int = 42, keep_codes: bool = False) -> DataFrame:
    """C7 -> D4/C1 -> C8 -> tokenize -> truncate -> pad -> D6. Conversations without a
    message are no training rows (T18); :func:`rejected_conversations` counts them."""
    key = F.col(key_col)
    df = df.where(~_empty(messages_col))
    msgs = chat.add_system_prompt(F.col(messages_col), key, add_system_ratio, seed=seed)
    staged = df.withColumn("_msgs", msgs)
    staged = staged.withColumn("_tools", chat.normalise_tools(chat.last_system_tools(F.col("_msgs"))))
    prompt = chat.render_messages(F.col("_msgs"), F.col("_tools"))
    staged = staged.withColumn("prompt", chat.drop_empty_think(prompt, key, empty_think_ratio, seed=seed))
    staged = _tokenize_fixed(staged, [key_col], "prompt", vocab, max_length, "_")
    b, e = anchors(vocab)
    return (staged.withColumn("input_ids", ids_of(F.col("_codes"), vocab))
            .withColumn("labels", label_mask(F.col("input_ids"), F.col("_codes"), b, e))
            .drop("_msgs", "_tools", *([] if keep_codes else ["_codes"])))


def mask_report(sft: DataFrame, messages_col: str, codes_col: str, vocab: Vocab) -> DataFrame:
    """T5/T6 report: assistant turns vs assistant spans actually found in the (truncated)
    token row, and whether user text carries special-token spellings (which become real
    special ids and can open a fake assistant span)."""
    b, e = anchors(vocab)
    pieces = F.regexp_extract_all(F.col(codes_col), F.lit(f"(.*?)({b})(.*?(?:{e}|$))|(.+)$"), 0)
    alt = tk.specials_alternation(vocab.specials) if vocab.specials else "(?!)"
    msgs = F.col(messages_col)
    return sft.withColumn("n_assistant", F.size(F.filter(msgs, lambda m: m["role"] == "assistant")).cast("bigint")) \
        .withColumn("n_spans", F.size(F.filter(pieces, lambda p: F.instr(p, F.lit(b)) > 0)).cast("bigint")) \
        .withColumn("user_specials", F.exists(msgs, lambda m: (m["role"] == "user")
                                              & F.coalesce(m["content"].rlike(alt), F.lit(False))))


def preference_rows(df: DataFrame, key_col: str, chosen_col: str, rejected_col: str,
                    vocab: Vocab, max_length: int = 4096, empty_think_ratio: float = 0.2,
                    seed: int = 42) -> DataFrame:
    """Both sides rendered (no system prompt, no tools), post-processed with their
    own draws, tokenized, truncated, padded, masked (0/1) and shifted by one."""
    key = F.col(key_col)
    b, e = anchors(vocab)
    out = df
    for side, col in (("chosen", chosen_col), ("rejected", rejected_col)):
        prompt = chat.drop_empty_think(chat.render_messages(F.col(col)), key, empty_think_ratio,
                                       purpose=f"empty-think-{side}", seed=seed)
        out = out.withColumn(f"_p_{side}", prompt)
        out = _tokenize_fixed(out, [key_col], f"_p_{side}", vocab, max_length, f"_{side}_")
        c = F.col(f"_{side}_codes")
        ids = ids_of(c, vocab)
        mask = loss_mask(c, b, e)
        n = max_length - 1
        out = (out.withColumn(f"x_{side}", F.slice(ids, 1, n))
               .withColumn(f"y_{side}", F.slice(ids, 2, n))
               .withColumn(f"mask_{side}", F.slice(mask, 2, n))
               .drop(f"_p_{side}", f"_{side}_codes"))
    return out


def rl_prompt_rows(df: DataFrame, key_col: str, messages_col: str,
                   add_system_ratio: float = 0.2, thinking_ratio: float = 0.5,
                   seed: int = 42) -> DataFrame:
    """C7, drop the last message whatever its role, render with the C9 draw and the
    generation header; answer = ''."""
    key = F.col(key_col)
    msgs = chat.add_system_prompt(F.col(messages_col), key, add_system_ratio, seed=seed)
    head = F.slice(msgs, 1, F.greatest(F.size(msgs) - 1, F.lit(0)))
    thinking = chat.thinking_draw(key, thinking_ratio, seed)
    return (df.withColumn("open_thinking", thinking)
            .withColumn("prompt", chat.render_messages(head, None, F.col("open_thinking"), True))
            .withColumn("answer", F.lit("")))


def tool_use_rows(df: DataFrame, messages_col: str, gt_col: str = "gt") -> DataFrame:
    """messages[:-1], the last system message's tools, and the ground truth."""
    msgs = F.col(messages_col)
    return (df.withColumn("messages", F.slice(msgs, 1, F.greatest(F.size(msgs) - 1, F.lit(0))))
            .withColumn("tools", chat.last_system_tools(msgs))
            .withColumn("gt", F.col(gt_col)))


# --- D13-D17: batching, resume, steps, schedule, budget ----------------------------

def batch_numbers(df: DataFrame, order_cols: list[str], batch_size: int) -> DataFrame:
    """Consecutive fixed-size batches in order; the last partial batch is kept."""
    indexed = ordered_index(df, [], order_cols, "sample_no")
    return indexed.withColumn("batch_no", F.floor((F.col("sample_no") - 1) / batch_size).cast("bigint"))


def resume_batches(batched: DataFrame, skip: int) -> DataFrame:
    """Drop the first ``skip`` batches."""
    return batched.where(F.col("batch_no") >= skip)


def resume_length(n_samples: Column, batch_size: int, skip: int) -> Column:
    """max(0, ceil(n / b) - skip)."""
    return F.greatest(F.lit(0), (F.ceil(n_samples / batch_size) - skip)).cast("bigint")


def rescale_step(step: Column, saved_world: Column, current_world: Column) -> Column:
    """Step * saved_world // current_world when the worker count changed."""
    return F.when(saved_world != current_world,
                  F.call_function("div", step * saved_world, current_world)).otherwise(step).cast("bigint")


def optimizer_steps(n_batches: Column, accumulation_steps: int, start_step: Column | int = 0) -> Column:
    """Boundaries at step % acc == 0 for steps start+1..start+n, plus one trailing
    flush when the last step is not a boundary."""
    s0 = F.lit(start_step) if isinstance(start_step, int) else start_step
    last = s0 + n_batches
    boundaries = F.floor(last / accumulation_steps) - F.floor(s0 / accumulation_steps)
    flush = F.when((last > s0) & (last % accumulation_steps != 0), 1).otherwise(0)
    return (boundaries + flush).cast("bigint")


def learning_rate(step: Column, total: Column | int, base_lr: float = 5e-4) -> Column:
    """Base * (0.1 + 0.45 * (1 + cos(pi * step / total)))."""
    t = F.lit(total) if isinstance(total, int) else total
    return F.lit(base_lr) * (F.lit(0.1) + F.lit(0.45) * (F.lit(1.0) + F.cos(F.lit(math.pi) * step / t)))


def training_budget(rows: DataFrame, ids_col: str, pad_id: int, batch_size: int,
                    accumulation_steps: int, n_params: float) -> DataFrame:
    """Samples, real tokens, batches, optimizer steps, tokens vs 20 x parameters."""
    agg = rows.agg(F.count(F.lit(1)).alias("n_samples"),
                   F.sum(F.size(F.filter(ids_col, lambda x: x != pad_id))).cast("bigint").alias("n_tokens"))
    return (agg.withColumn("n_batches", F.ceil(F.col("n_samples") / batch_size).cast("bigint"))
            .withColumn("n_optimizer_steps", optimizer_steps(F.col("n_batches"), accumulation_steps))
            .withColumn("token_target", F.lit(20.0 * n_params))
            .withColumn("target_ratio", F.round(F.col("n_tokens") / F.lit(20.0 * n_params), 9)))
