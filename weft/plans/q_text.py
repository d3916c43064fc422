"""Registered queries: sources, byte-level vocabulary, chat rendering, row builders."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..operators import chat, rows
from ..operators import stats as H
from ..operators import vocab as V
from ..session import shared_path
from ..sources import readers
from . import derived as D
from . import sqlkit as K
from .registry import register

BV = V.BYTE_VOCAB
PAD = BV.pad_id
BOS_CODE, EOS_CODE = (K.s(tk.code_hex(tk.SPECIAL_BASE + i)) for i in (BV.bos_id, BV.eos_id))
MD5 = lambda c: F.md5(F.array_join(c, ","))


# --- D1-D3: the flagship slice ----------------------------------------------------

def pretrain_summary(spark, d, max_length=512):
    docs = D.table(spark, d, "documents").select("doc_id", "lang", "text")
    r = rows.pretrain_rows(docs, ["doc_id"], "text", BV, max_length)
    body = max_length - 2
    return r.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum(F.least("n_raw_tokens", F.lit(body)) + 2).cast("bigint").alias("n_tokens"),
        F.sum(F.size(F.filter("labels", lambda x: x != -100))).cast("bigint").alias("n_label_tokens"),
        F.sum(F.when(F.col("n_raw_tokens") > body, 1).otherwise(0)).cast("bigint").alias("n_truncated"),
        F.sum(F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)).cast("bigint").alias("id_sum"),
        F.sum(F.aggregate("labels", F.lit(0).cast("bigint"), lambda a, x: a + F.when(x != -100, x).otherwise(0)))
        .cast("bigint").alias("label_sum"))


def _pretrain_ids_sql(max_length=512):
    body = K.pad(f"({BOS_CODE} || {K.trunc('c', max_length - 2)} || {EOS_CODE})", max_length)
    return f"""SELECT doc_id, md5(array_to_string({K.code_ids_fast(body)}, ',')) AS ids_md5
      FROM (SELECT doc_id, {K.encode_bytes("coalesce(text, 'None')")} AS c FROM documents)"""


def _pretrain_sql(max_length=512):
    body = max_length - 2
    return f"""
WITH d AS (SELECT doc_id, lang, {K.encode_bytes("coalesce(text, 'None')")} AS c FROM documents),
r AS (SELECT doc_id, lang, {K.ntok('c')} AS n_raw,
        {K.code_ids_fast(K.pad(f"({BOS_CODE} || {K.trunc('c', body)} || {EOS_CODE})", max_length))} AS ids FROM d)
SELECT lang, count(*)::BIGINT AS n_docs, sum(least(n_raw, {body}) + 2)::BIGINT AS n_tokens,
  sum(len(list_filter(ids, lambda x: x <> {PAD})))::BIGINT AS n_label_tokens,
  sum(CASE WHEN n_raw > {body} THEN 1 ELSE 0 END)::BIGINT AS n_truncated,
  sum(list_sum(ids))::BIGINT AS id_sum,
  sum(list_sum(list_filter(ids, lambda x: x <> {PAD})))::BIGINT AS label_sum
FROM r GROUP BY lang"""


register("d1_pretrain_rows", _pretrain_sql)(lambda spark, d: pretrain_summary(spark, d))


# --- A: sources -------------------------------------------------------------------

@register("a10_assemble_messages", """
SELECT conv_id, count(*)::BIGINT AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role
FROM conversations GROUP BY conv_id""")
def q_a10(spark, d):
    m = readers.assemble_messages(D.table(spark, d, "conversations"))
    return m.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                    F.array_join(F.transform("messages", lambda x: x["role"]), ",").alias("roles"),
                    F.element_at("messages", 1)["role"].alias("first_role"),
                    F.element_at("messages", -1)["role"].alias("last_role"))


@register("a6_sample_counts", f"""
WITH conv AS (SELECT conv_id, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id)
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_pretrain,
       (SELECT count(*) FROM conv)::BIGINT AS n_sft,
       (SELECT count(*) FROM conv WHERE last_role = 'assistant')::BIGINT AS n_preference,
       (SELECT count(*) FROM conversations WHERE role = 'assistant')::BIGINT AS n_tool_use""")
def q_a6(spark, d):
    cnt = lambda df, name: readers.sample_count(df).withColumnRenamed("n_samples", name).withColumn("_k", F.lit(1))
    parts = [cnt(D.table(spark, d, "documents"), "n_pretrain"), cnt(D.messages(spark, d), "n_sft"),
             cnt(D.pairs(spark, d), "n_preference"), cnt(D.tool_responses(spark, d), "n_tool_use")]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_k")
    return out.drop("_k")


SHARD_CHARS = 4_000_000


@register("a9_write_shards", f"""
WITH r AS ({_pretrain_ids_sql()})
SELECT doc_id, ids_md5, 0::BIGINT AS n_out_of_order FROM r""")
def q_a9(spark, d):
    """Finished pretraining rows, written in shards by doc_id and read back. Every row carries how far its
    shard differs from the manifest or overlaps the shard before."""
    path = shared_path(spark, f"shards-{uuid.uuid4().hex}")
    docs = D.table(spark, d, "documents").select("doc_id", "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    done = rows.pretrain_rows(docs, ["doc_id"], "text", BV, 512).select("doc_id", "input_ids", "labels")
    readers.write_shards(done, path, chars // SHARD_CHARS + 1, ["doc_id"], 4 * (F.size("input_ids") + F.size("labels")))
    bad = readers.check_shards(spark, path, ["doc_id"]).select("shard", F.col("n_wrong").alias("n_out_of_order"))
    return spark.read.parquet(path).join(bad, "shard").select("doc_id", MD5(F.col("input_ids")).alias("ids_md5"), "n_out_of_order")


@register("a7_corpus", """
SELECT count(*)::BIGINT AS n_texts, sum(length(text))::BIGINT AS n_chars, md5(string_agg(md5(text), '' ORDER BY md5(text))) AS texts_md5
FROM documents WHERE text IS NOT NULL GROUP BY left(md5(text), 1)""")
def q_a7(spark, d):
    """The corpus that trains the vocabularies, digested in 16 groups by the texts' own hash."""
    c = readers.corpus(D.table(spark, d, "documents")).select("text", F.md5("text").alias("h"))
    g = c.groupBy(F.left("h", F.lit(1)).alias("k")).agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("text")).alias("n_chars"), F.sort_array(F.collect_list("h")).alias("hs"))
    return g.select("n_texts", "n_chars", F.md5(F.array_join("hs", "")).alias("texts_md5"))


# --- B: byte level ----------------------------------------------------------------

@register("b1_byte_ids", f"""
WITH b AS (SELECT doc_id, list_transform(string_split(ltrim({K.utf8('text')}), ' '), lambda x: ('0x' || x)::INT) AS ids
           FROM documents)
SELECT doc_id, len(ids)::BIGINT AS n_bytes, list_sum(ids)::BIGINT AS byte_sum, md5(array_to_string(ids, ',')) AS ids_md5
FROM b""")
def q_b1(spark, d):
    b = D.table(spark, d, "documents").select("doc_id", V.byte_ids(F.col("text")).alias("ids"))
    return b.select("doc_id", F.size("ids").cast("bigint").alias("n_bytes"),
                    F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("byte_sum"),
                    MD5(F.col("ids")).alias("ids_md5"))


@register("b2_pair_counts", f"""
WITH c AS (SELECT {K.utf8('text')} AS c FROM documents),
p AS (SELECT ' ' || t[i] || ' ' || t[i + 1] AS pair FROM (SELECT string_split(ltrim(c), ' ') AS t FROM c),
      LATERAL (SELECT unnest(range(1, len(t))) AS i))
SELECT ('0x' || substr(pair, 2, {tk.DIGITS}))::INT AS "left", ('0x' || substr(pair, {tk.TOKEN_WIDTH + 2}, {tk.DIGITS}))::INT AS "right", count(*)::BIGINT AS count
FROM p GROUP BY pair""")
def q_b2(spark, d):
    found = H.byte_counts(D.table(spark, d, "documents"), "text", pairs=True)
    return found.where(F.col("right").isNotNull()).withColumnRenamed("n", "count")


@register("b3_merge_pair", f"""
WITH c AS (SELECT doc_id, {K.utf8('text')} AS c FROM documents),
m AS (SELECT doc_id, {K.ntok('c')} AS n_before, replace(c, {K.s(tk.pair_text(0x65, 0x20))}, {K.s(tk.code_hex(256))}) AS c2 FROM c)
SELECT doc_id, n_before::BIGINT AS n_before, {K.ntok('c2')}::BIGINT AS n_after,
  md5(array_to_string(list_transform(string_split(ltrim(c2), ' '), lambda x: ('0x' || x)::INT), ',')) AS ids_md5
FROM m""")
def q_b3(spark, d):
    c = D.table(spark, d, "documents").select("doc_id", tk.utf8_codes(F.col("text")).alias("c"))
    m = c.select("doc_id", tk.n_tokens(F.col("c")).alias("n_before"), V.merge_codes(F.col("c"), 0x65, 0x20, 256).alias("m"))
    return m.select("doc_id", F.col("n_before").cast("bigint").alias("n_before"),
                    tk.n_tokens(F.col("m")).cast("bigint").alias("n_after"), MD5(tk.codes_array(F.col("m"))).alias("ids_md5"))


def _rendered_prompts(spark, d):
    m = D.messages(spark, d)
    tools = chat.normalise_tools(chat.last_system_tools(F.col("messages")))
    return m.select("conv_id", chat.render_messages(F.col("messages"), tools).alias("prompt"))


@register("b8_special_tokens", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte()},
t AS (SELECT conv_id, {K.code_ids_fast(K.encode_bytes('prompt'))} AS ids FROM rendered)
SELECT conv_id, len(ids)::BIGINT AS n_tokens, len(list_filter(ids, lambda x: x < 24))::BIGINT AS n_special,
       md5(array_to_string(ids, ',')) AS ids_md5 FROM t""")
def q_b8(spark, d):
    p = _rendered_prompts(spark, d)
    ids = V.ids_of(V.encode_inline(F.col("prompt"), BV), BV)
    t = p.select("conv_id", ids.alias("ids"))
    return t.select("conv_id", F.size("ids").cast("bigint").alias("n_tokens"),
                    F.size(F.filter("ids", lambda x: x < 24)).cast("bigint").alias("n_special"),
                    MD5(F.col("ids")).alias("ids_md5"))


def _byte_vocab_sql() -> str:
    n_sp = len(tk.ALL_SPECIAL_TOKENS)
    rank = tk.alphabet_rank_sql("b")
    return f"""bytevocab AS (
  SELECT chr(CAST(CASE WHEN (b BETWEEN 33 AND 126) OR (b BETWEEN 161 AND 172) OR b >= 174 THEN b
                  ELSE 256 + {rank} - 188 END AS INTEGER)) AS token, {rank} + {n_sp} AS id
  FROM range(0, 256) t(b))"""


@register("b9_token_lookup", lambda: f"""
WITH {_byte_vocab_sql()},
toks AS (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents),
b AS (SELECT t.token, v.id::INT AS id FROM toks t LEFT JOIN bytevocab v USING (token)),
s AS (SELECT unnest(%s) AS token, unnest(range(0, %d))::INT AS id)
SELECT token, id, CASE WHEN id IS NOT NULL THEN token END AS back, false AS is_special FROM b WHERE token <> ''
UNION ALL SELECT token, id, token, true FROM s""" % (K.slist(tk.ALL_SPECIAL_TOKENS), len(tk.ALL_SPECIAL_TOKENS)))
def q_b9(spark, d):
    vt = V.vocab_table(spark, BV)
    toks = D.table(spark, d, "documents").select(F.explode(F.split("text", "")).alias("token")).distinct().where("token <> ''")
    toks = toks.withColumn("is_special", F.lit(False)).union(vt.where("is_special").select("token", "is_special"))
    found = toks.join(vt.select("token", "id"), "token", "left")
    back = vt.select("id", F.col("token").alias("back"))  # and from the id to its token
    return found.join(back, "id", "left").select("token", "id", "back", "is_special")


@register("b11_truncate", f"""
WITH c AS (SELECT doc_id, {K.encode_bytes('text')} AS c FROM documents)
SELECT doc_id, least({K.ntok('c')}, 64)::BIGINT AS n_default, {K.ntok('c')}::BIGINT AS n_no_truncation FROM c""")
def q_b11(spark, d):
    c = D.table(spark, d, "documents").select("doc_id", V.encode_inline(F.col("text"), BV).alias("c"))
    return c.select("doc_id", tk.n_tokens(V.truncate_if(F.col("c"), 64)).cast("bigint").alias("n_default"),
                    tk.n_tokens(V.truncate_if(F.col("c"), 64, False)).cast("bigint").alias("n_no_truncation"))


@register("b12_wrap_special", f"""
WITH c AS (SELECT doc_id, {K.code_ids_fast(K.encode_bytes('text'))} AS ids FROM documents)
SELECT doc_id, (len(ids) + 2)::BIGINT AS n_ids, 0 AS first_id, 1 AS last_id,
       md5(array_to_string(list_concat([0], ids, [1]), ',')) AS ids_md5 FROM c""")
def q_b12(spark, d):
    docs = V.encode_ids(D.table(spark, d, "documents").select("doc_id", "text"), "text", BV, "body")
    t = docs.select("doc_id", V.wrap_bos_eos(F.col("body"), F.col("text"), BV, True).alias("ids"))
    return t.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"),
                    F.element_at("ids", 1).alias("first_id"), F.element_at("ids", -1).alias("last_id"),
                    MD5(F.col("ids")).alias("ids_md5"))


@register("b13_decode_skip_special", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte()}
SELECT conv_id, regexp_replace(prompt, {K.s(tk.specials_alternation())}, '', 'g') AS text FROM rendered""")
def q_b13(spark, d):
    p = _rendered_prompts(spark, d)
    ids = V.ids_of(V.encode_inline(F.col("prompt"), BV), BV)
    return p.select("conv_id", V.decode_ids(ids, BV, True).alias("text"))


@register("b14_compression_bytes", f"""
SELECT lang, sum(strlen(text))::BIGINT AS n_tokens, sum(length(text))::BIGINT AS n_chars,
  round(sum(strlen(text)) / sum(length(text)), 6) AS tokens_per_char,
  round(sum(length(text)) / sum(strlen(text)), 6) AS chars_per_token
FROM documents GROUP BY lang""")
def q_b14(spark, d):
    docs = D.table(spark, d, "documents")
    t = docs.select("lang", "text", V.encode_inline(F.col("text"), BV).alias("codes"))
    return V.compression_report(t, "lang", "text", "codes")


# --- C: rendering -------------------------------------------------------------------

@register("c1_render_tools", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte()}
SELECT conv_id, prompt FROM rendered""")
def q_c1(spark, d):
    return _rendered_prompts(spark, d)


@register("c3_render_thinking_generation", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte(thinking='true', gen_prompt=True)}
SELECT conv_id, prompt FROM rendered""")
def q_c3(spark, d):
    m = D.messages(spark, d)
    tools = chat.normalise_tools(chat.last_system_tools(F.col("messages")))
    return m.select("conv_id", chat.render_messages(F.col("messages"), tools, True, True).alias("prompt"))


@register("c5_template_render", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte(with_tools=False)}
SELECT conv_id, prompt FROM rendered""")
def q_c5(spark, d):
    m = D.messages(spark, d)
    return m.select("conv_id", chat.render_template(F.col("messages")).alias("prompt"))


@register("c7_system_prompt", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()},
a AS (SELECT m.*, {K.system_prompt_cols('m.conv_id', 'm.first_role', 'm.any_tools', 'm.n_msgs')} FROM meta m)
SELECT conv_id, added, (n_msgs + CASE WHEN added THEN 1 ELSE 0 END)::BIGINT AS n_messages,
       CASE WHEN added THEN sys_content ELSE (SELECT t.content FROM turns t WHERE t.conv_id = a.conv_id AND t.turn = 0) END
       AS first_content
FROM a""")
def q_c7(spark, d):
    m = D.messages(spark, d)
    aug = chat.add_system_prompt(F.col("messages"), F.col("conv_id"))
    return m.select("conv_id", (F.size(aug) > F.size("messages")).alias("added"),
                    F.size(aug).cast("bigint").alias("n_messages"),
                    F.element_at(aug, 1)["content"].alias("first_content"))


@register("c8_post_process", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte()}
SELECT conv_id, {K.drop_think('prompt', 'conv_id')} AS prompt FROM rendered""")
def q_c8(spark, d):
    p = _rendered_prompts(spark, d)
    return p.select("conv_id", chat.drop_empty_think(F.col("prompt"), F.col("conv_id")).alias("prompt"))


@register("c9_thinking_draw", f"""
SELECT DISTINCT conv_id, {K.draw('conv_id', 'thinking-mode')} < 0.5 AS open_thinking FROM conversations""")
def q_c9(spark, d):
    c = D.table(spark, d, "conversations").select("conv_id").distinct()
    return c.select("conv_id", chat.thinking_draw(F.col("conv_id")).alias("open_thinking"))


# --- D: row builders ----------------------------------------------------------------

def _sft_sql(max_length=1024):
    b, e = rows.anchors(BV)
    return f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte(system_prompt=True)},
p AS (SELECT conv_id, {K.drop_think('prompt', 'conv_id')} AS prompt FROM rendered),
c AS (SELECT conv_id, {K.pad(K.trunc(K.encode_bytes('prompt'), max_length), max_length)} AS c FROM p),
l AS (SELECT conv_id, {K.code_ids_fast('c')} AS ids, c FROM c),
m AS (SELECT conv_id, ids, list_transform(list_zip(ids, {K.span_mask('c', b, e, 'true', 'false')}),
              lambda z: CASE WHEN z[2] THEN z[1] ELSE -100 END) AS labels FROM l)
SELECT conv_id, len(list_filter(ids, lambda x: x <> {PAD}))::BIGINT AS n_tokens,
  len(list_filter(labels, lambda x: x <> -100))::BIGINT AS n_label_tokens,
  coalesce(list_sum(list_filter(labels, lambda x: x <> -100)), 0)::BIGINT AS label_sum,
  md5(array_to_string(ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5
FROM m"""


@register("d7_sft_rows", _sft_sql)
def q_d7(spark, d):
    r = rows.sft_rows(D.messages(spark, d), "conv_id", "messages", BV, 1024)
    return r.select("conv_id", F.size(F.filter("input_ids", lambda x: x != PAD)).cast("bigint").alias("n_tokens"),
                    F.size(F.filter("labels", lambda x: x != -100)).cast("bigint").alias("n_label_tokens"),
                    F.aggregate(F.filter("labels", lambda x: x != -100), F.lit(0).cast("bigint"),
                                lambda a, x: a + x).alias("label_sum"),
                    MD5(F.col("input_ids")).alias("ids_md5"), MD5(F.col("labels")).alias("labels_md5"))


def pref_texts_sql() -> str:
    """CTEs pieces_chosen and pieces_rejected (pair_id, p)."""
    return f"""conv AS (SELECT conv_id, arg_max(role, turn) AS last_role, count(*) AS n,
                min(turn) FILTER (WHERE role = 'user') AS first_user_turn FROM conversations GROUP BY conv_id),
t AS (SELECT c.conv_id AS pair_id, c.turn, c.role,
        CASE WHEN c.role = 'assistant' AND c.conv_id % 4 = 1 THEN {K.s(chat.EMPTY_THINK)} || c.text ELSE c.text END AS content,
        c.turn = (SELECT max(turn) FROM conversations x WHERE x.conv_id = c.conv_id) AS is_last
      FROM conversations c JOIN conv v ON v.conv_id = c.conv_id WHERE v.last_role = 'assistant'),
echo AS (SELECT v.conv_id AS pair_id,
          coalesce((SELECT x.text FROM conversations x WHERE x.conv_id = v.conv_id AND x.turn = v.first_user_turn), '') AS echo
         FROM conv v WHERE v.last_role = 'assistant'),
pieces_chosen AS (SELECT pair_id, string_agg({K.render_piece('role', 'content')}, '' ORDER BY turn) AS p FROM t GROUP BY pair_id),
pieces_rejected AS (SELECT t.pair_id, string_agg(CASE WHEN t.is_last THEN {K.render_piece("'assistant'", 'e.echo')}
                                                 ELSE {K.render_piece('t.role', 't.content')} END, '' ORDER BY t.turn) AS p
                    FROM t JOIN echo e USING (pair_id) GROUP BY t.pair_id)"""


def _pref_sql(max_length=4096):
    b, e = rows.anchors(BV)
    n = max_length - 1

    def side(name, purpose):
        return f"""
r_{name} AS (SELECT pair_id, {K.drop_think('p', 'pair_id', purpose)} AS p FROM pieces_{name}),
c_{name} AS (SELECT pair_id, {K.pad(K.trunc(K.encode_bytes('p'), max_length), max_length)} AS c FROM r_{name}),
m_{name} AS (SELECT pair_id, {K.code_ids_fast('c')} AS ids,
   {K.span_mask('c', b, e, '1', '0')} AS mask FROM c_{name})"""
    return f"""
WITH {pref_texts_sql()},
{side('chosen', 'empty-think-chosen')},
{side('rejected', 'empty-think-rejected')}
SELECT pair_id,
  md5(array_to_string(c.ids[1:{n}], ',')) AS x_chosen_md5, md5(array_to_string(c.ids[2:{max_length}], ',')) AS y_chosen_md5,
  list_sum(c.mask[2:{max_length}])::BIGINT AS mask_chosen_sum,
  md5(array_to_string(r.ids[1:{n}], ',')) AS x_rejected_md5, md5(array_to_string(r.ids[2:{max_length}], ',')) AS y_rejected_md5,
  list_sum(r.mask[2:{max_length}])::BIGINT AS mask_rejected_sum
FROM m_chosen c JOIN m_rejected r USING (pair_id)"""


@register("d8_preference_rows", _pref_sql)
def q_d8(spark, d):
    r = rows.preference_rows(D.pairs(spark, d), "pair_id", "chosen", "rejected", BV, 4096)
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return r.select("pair_id", MD5(F.col("x_chosen")).alias("x_chosen_md5"), MD5(F.col("y_chosen")).alias("y_chosen_md5"),
                    total(F.col("mask_chosen")).alias("mask_chosen_sum"),
                    MD5(F.col("x_rejected")).alias("x_rejected_md5"), MD5(F.col("y_rejected")).alias("y_rejected_md5"),
                    total(F.col("mask_rejected")).alias("mask_rejected_sum"))


@register("d11_rl_prompt_rows", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()},
th AS (SELECT conv_id, {K.draw('conv_id', 'thinking-mode')} < 0.5 AS open_thinking FROM meta),
{K.rendered_cte(thinking='(SELECT th.open_thinking FROM th WHERE th.conv_id = m.conv_id)', with_tools=False,
                system_prompt=True, drop_last=True, gen_prompt=True)}
SELECT r.conv_id, th.open_thinking, r.prompt, '' AS answer FROM rendered r JOIN th USING (conv_id)""")
def q_d11(spark, d):
    r = rows.rl_prompt_rows(D.messages(spark, d), "conv_id", "messages")
    return r.select("conv_id", "open_thinking", "prompt", "answer")


@register("d12_tool_use_rows", lambda: f"""
WITH {K.turns_cte()}, {K.conv_meta_cte()}
SELECT m.conv_id, (m.n_msgs - 1)::BIGINT AS n_messages,
  (SELECT arg_max(t.tools, t.turn) FROM turns t WHERE t.conv_id = m.conv_id AND t.role = 'system' AND coalesce(t.tools, '') <> '') AS tools,
  (SELECT split_part(t.content, ' ', 1) FROM turns t WHERE t.conv_id = m.conv_id AND t.turn = (SELECT max(turn) FROM turns u WHERE u.conv_id = m.conv_id)) AS gt
FROM meta m""")
def q_d12(spark, d):
    m = D.messages(spark, d).withColumn("gt", F.split_part(F.element_at("messages", -1)["content"], F.lit(" "), F.lit(1)))
    r = rows.tool_use_rows(m, "messages", "gt")
    return r.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"), "tools", "gt")


@register("d13_batches", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id)::BIGINT AS sample_no,
       ((row_number() OVER (ORDER BY doc_id) - 1) // 4)::BIGINT AS batch_no FROM documents""")
def q_d13(spark, d):
    b = rows.batch_numbers(D.table(spark, d, "documents").select("doc_id"), ["doc_id"], 4)
    return b.select("doc_id", "sample_no", "batch_no")


@register("d14_resume", """
WITH b AS (SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 4)::BIGINT AS batch_no FROM documents)
SELECT doc_id, batch_no FROM b WHERE batch_no >= 7""")
def q_d14(spark, d):
    b = rows.batch_numbers(D.table(spark, d, "documents").select("doc_id"), ["doc_id"], 4)
    return rows.resume_batches(b, 7).select("doc_id", "batch_no")


@register("d14_resume_length", """
SELECT count(*)::BIGINT AS n_samples, greatest(0, ceil(count(*) / 4.0) - 7)::BIGINT AS n_batches_left,
       (count(*) * 4 // 3)::BIGINT AS rescaled_step FROM documents""")
def q_d14b(spark, d):
    n = readers.sample_count(D.table(spark, d, "documents"))
    return n.select("n_samples", rows.resume_length(F.col("n_samples"), 4, 7).alias("n_batches_left"),
                    rows.rescale_step(F.col("n_samples"), F.lit(4), F.lit(3)).alias("rescaled_step"))


@register("d15_optimizer_steps", """
WITH n AS (SELECT ceil(count(*) / 4.0)::BIGINT AS nb FROM documents)
SELECT nb AS n_batches, (nb // 4 + CASE WHEN nb % 4 <> 0 THEN 1 ELSE 0 END)::BIGINT AS n_optimizer_steps FROM n""")
def q_d15(spark, d):
    n = readers.sample_count(D.table(spark, d, "documents"))
    nb = F.ceil(F.col("n_samples") / 4).cast("bigint")
    return n.select(nb.alias("n_batches"), rows.optimizer_steps(nb, 4).alias("n_optimizer_steps"))


@register("d16_lr_schedule", """
WITH b AS (SELECT DISTINCT ((row_number() OVER (ORDER BY doc_id) - 1) // 4)::BIGINT AS batch_no FROM documents),
t AS (SELECT count(*) AS total FROM b),
e AS (SELECT unnest([0, 1]) AS epoch)
SELECT e.epoch::INT AS epoch, (b.batch_no + 1)::BIGINT AS step,
  round(5e-4 * (0.1 + 0.45 * (1 + cos(pi() * (e.epoch * t.total + b.batch_no + 1) / (2 * t.total)))), 12) AS lr
FROM b, t, e""")
def q_d16(spark, d):
    b = rows.batch_numbers(D.table(spark, d, "documents").select("doc_id"), ["doc_id"], 4)
    batches = b.groupBy("batch_no").agg(F.count(F.lit(1)).alias("_n"))
    total = batches.agg(F.count(F.lit(1)).alias("total")).withColumn("_k", F.lit(1))
    epochs = spark.range(2).select(F.col("id").cast("int").alias("epoch"))
    grid = batches.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").join(F.broadcast(epochs.withColumn("_k", F.lit(1))), "_k")
    step = F.col("batch_no") + 1
    lr = rows.learning_rate(F.col("epoch") * F.col("total") + step, 2 * F.col("total"))
    return grid.select("epoch", step.cast("bigint").alias("step"), F.round(lr, 12).alias("lr"))


@register("d17_training_budget", f"""
WITH d AS (SELECT {K.encode_bytes("coalesce(text, 'None')")} AS c FROM documents)
SELECT count(*)::BIGINT AS n_samples, sum(least({K.ntok('c')}, 338) + 2)::BIGINT AS n_tokens,
  ceil(count(*) / 64.0)::BIGINT AS n_batches,
  (ceil(count(*) / 64.0)::BIGINT // 4 + CASE WHEN ceil(count(*) / 64.0)::BIGINT % 4 <> 0 THEN 1 ELSE 0 END)::BIGINT AS n_optimizer_steps,
  1280000000.0 AS token_target, round(sum(least({K.ntok('c')}, 338) + 2) / 1280000000.0, 9) AS target_ratio
FROM d""")
def q_d17(spark, d):
    docs = D.table(spark, d, "documents").select("doc_id", "text")
    r = rows.pretrain_rows(docs, ["doc_id"], "text", BV, 340)
    return rows.training_budget(r, "input_ids", PAD, 64, 4, 64e6)

