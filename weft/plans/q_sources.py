"""Registered queries for the JSONL readers (A1-A5): whole tables are written as JSONL
into the shared folder in the reference's sample layouts and read back with the
declared-schema readers; and the T5/T6 mask report over SFT rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..operators import rows
from ..operators import vocab as V
from ..session import shared_path
from ..sources import readers as R
from . import derived as D
from . import sqlkit as K
from .q_text import pref_texts_sql
from .registry import register


def _tmp(spark, name):
    return shared_path(spark, f"jsonl/{name}-{uuid.uuid4().hex[:12]}")


def _messages_md5(messages, *fields):
    """md5 of a message array's fields, in order; NULL fields count as '~'."""
    one = lambda m: F.concat_ws("|", *(F.coalesce(m[f], F.lit("~")) for f in fields))
    return F.md5(F.array_join(F.transform(messages, one), ";"))


def _messages_md5_sql(*fields: str) -> str:
    one = " || '|' || ".join(f"coalesce({f}, '~')" for f in fields)
    return f"md5(string_agg({one}, ';' ORDER BY turn))"


def _counted(df, *cols):
    """Rows read, as digests with their number (a reader has no key column)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@register("a1_text_jsonl", "SELECT md5(text) AS text_md5, count(*)::BIGINT AS n_rows FROM documents GROUP BY 1")
def q_a1(spark, d):
    path = _tmp(spark, "text")
    D.table(spark, d, "documents").select("text").write.json(path)
    return _counted(R.read_text_jsonl(spark, path).select(F.md5("text").alias("text_md5")), "text_md5")


@register("a2_conversations_jsonl", lambda: f"""
WITH {K.turns_cte()},
c AS (SELECT conv_id, count(*)::BIGINT AS n_messages, {_messages_md5_sql('role', 'content', 'NULL', 'tools')} AS messages_md5 FROM turns GROUP BY conv_id)
SELECT n_messages, messages_md5, count(*)::BIGINT AS n_rows FROM c GROUP BY 1, 2""")
def q_a2(spark, d):
    path = _tmp(spark, "conv")
    D.messages(spark, d).select(F.col("messages").alias("conversations")).write.json(path)
    m = F.col("conversations")
    c = R.read_conversations_jsonl(spark, path).select(
        F.size(m).cast("bigint").alias("n_messages"),
        _messages_md5(m, "role", "content", "reasoning_content", "tools").alias("messages_md5"))
    return _counted(c, "n_messages", "messages_md5")


@register("a3_pairs_jsonl", lambda: f"""
WITH {pref_texts_sql()},
c AS (SELECT pair_id, {_messages_md5_sql('role', 'content')} AS chosen_md5 FROM t GROUP BY pair_id),
r AS (SELECT t.pair_id, {_messages_md5_sql('role', 'content')} AS rejected_md5
      FROM (SELECT t.pair_id, turn, CASE WHEN is_last THEN 'assistant' ELSE role END AS role,
                   CASE WHEN is_last THEN e.echo ELSE content END AS content FROM t JOIN echo e USING (pair_id)) t GROUP BY t.pair_id)
SELECT chosen_md5, rejected_md5, count(*)::BIGINT AS n_rows FROM c JOIN r USING (pair_id) GROUP BY 1, 2""")
def q_a3(spark, d):
    path = _tmp(spark, "pairs")
    D.pairs(spark, d).select("chosen", "rejected").write.json(path)
    p = R.read_pairs_jsonl(spark, path).select(
        *(_messages_md5(F.col(c), "role", "content").alias(f"{c}_md5") for c in ("chosen", "rejected")))
    return _counted(p, "chosen_md5", "rejected_md5")


@register("a4_prompts_jsonl", lambda: f"""
WITH {K.turns_cte()},
c AS (SELECT conv_id, count(*)::BIGINT AS n_messages, {_messages_md5_sql('role', 'content')} AS messages_md5 FROM turns GROUP BY conv_id)
SELECT n_messages, messages_md5, count(*)::BIGINT AS n_rows FROM c GROUP BY 1, 2""")
def q_a4(spark, d):
    path = _tmp(spark, "prompts")
    m = F.col("messages")
    D.messages(spark, d).select(F.transform(m, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
                                .alias("conversations")).write.json(path)
    c = F.col("conversations")
    return _counted(R.read_prompts_jsonl(spark, path).select(
        F.size(c).cast("bigint").alias("n_messages"), _messages_md5(c, "role", "content").alias("messages_md5")),
        "n_messages", "messages_md5")


@register("a5_agent_jsonl", lambda: f"""
WITH {K.turns_cte()},
c AS (SELECT conv_id, split_part(arg_max(content, turn), ' ', 1) AS gt, {_messages_md5_sql('role', 'content', 'NULL', 'tools')} AS messages_md5
      FROM turns GROUP BY conv_id)
SELECT gt, messages_md5, count(*)::BIGINT AS n_rows FROM c GROUP BY 1, 2""")
def q_a5(spark, d):
    path = _tmp(spark, "agent")
    m = D.messages(spark, d)
    m.select(F.col("messages").alias("conversations"),
             F.split_part(F.element_at("messages", -1)["content"], F.lit(" "), F.lit(1)).alias("gt")).write.json(path)
    a = R.read_agent_jsonl(spark, path).select(
        "gt", _messages_md5(F.col("conversations"), "role", "content", "reasoning_content", "tools").alias("messages_md5"))
    return _counted(a, "gt", "messages_md5")


# --- T5/T6 report over SFT rows ---------------------------------------------------------

def _span_count_sql(c: str, b: str, e: str) -> str:
    pat = f"(.*?)({b})(.*?(?:{e}|$))|(.+)$"
    return f"len(list_filter(regexp_extract_all({c}, {K.s(pat)}), lambda p: strpos(p, {K.s(b)}) > 0))"


@register("d6_mask_report", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte(system_prompt=True)},
p AS (SELECT conv_id, {K.drop_think('prompt', 'conv_id')} AS prompt FROM rendered),
c AS (SELECT conv_id, {K.pad(K.trunc(K.encode_bytes('prompt'), 1024), 1024)} AS c FROM p),
u AS (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n_assistant,
             bool_or(role = 'user' AND regexp_matches(content, {K.s(tk.specials_alternation())})) AS user_specials
      FROM turns GROUP BY conv_id)
SELECT c.conv_id, u.n_assistant::BIGINT AS n_assistant, {_span_count_sql('c.c', *rows.anchors(V.BYTE_VOCAB))}::BIGINT AS n_spans,
       u.user_specials FROM c JOIN u USING (conv_id)""")
def q_d6(spark, d):
    r = rows.mask_report(rows.sft_rows(D.messages(spark, d), "conv_id", "messages", V.BYTE_VOCAB, 1024,
                                       keep_codes=True), "messages", "_codes", V.BYTE_VOCAB)
    return r.select("conv_id", "n_assistant", "n_spans", "user_specials")

