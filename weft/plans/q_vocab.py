"""Registered queries: vocabulary training and corpus tokenization with learned merges.
Oracles unroll the same training rounds in DuckDB SQL (a few rounds, whole tables)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..operators import rows
from ..operators import vocab as V
from ..session import shared_path
from ..sources import readers
from . import derived as D
from . import sqlkit as K
from .registry import register

TEACH_ROUNDS = 4          # B4: merges over whole documents
BENCH_ROUNDS = 5          # B5/B6: merges learned on the benchmark texts
PROD_MERGES = 10          # B7/B10/B14/A8: production merges that the SQL below unrolls
VOCAB_SIZE = 6400         # the default size, learned by b7_train_default
N_SP = len(tk.ALL_SPECIAL_TOKENS)
MD5 = lambda c: F.md5(F.array_join(c, ","))

# DuckDB pre-split: the Java pattern's "\s+(?!\S)" needs look-ahead, which RE2 lacks.
# A whitespace run of two or more followed by a non-space gives up its last character
# to the next piece; inserting a break there and splitting is the same cut.
SQL_PRESPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def _sql_words(piece: str) -> str:
    marked = f"regexp_replace({piece}, '(\\s+)(\\s)(\\S)', '\\1' || chr(1) || '\\2\\3', 'g')"
    return (f"flatten(list_transform(string_split({marked}, chr(1)), "
            f"lambda q: regexp_extract_all(q, {K.s(SQL_PRESPLIT)})))")


def _teaching_rounds_sql(src: str, rounds: int) -> tuple[str, list[str]]:
    """CTEs s0..sK (o, c) and best1..bestK (pair) for whole-text training."""
    ctes, bests = [], []
    for r in range(1, rounds + 1):
        prev = f"s{r - 1}"
        ctes.append(f"""p{r} AS (SELECT ' ' || t[i + 1] || ' ' || t[i + 2] AS pair, o, i
                 FROM (SELECT o, string_split(ltrim(c), ' ') AS t FROM {prev}),
                 LATERAL (SELECT unnest(range(0, len(t) - 1)) AS i))""")
        ctes.append(f"""best{r} AS (SELECT pair FROM p{r} GROUP BY pair
                 ORDER BY count(*) DESC, min(o * 4294967296 + i) ASC LIMIT 1)""")
        ctes.append(f"""s{r} AS (SELECT o, CASE WHEN (SELECT pair FROM best{r}) IS NULL THEN c
                 ELSE replace(c, (SELECT pair FROM best{r}), {K.s(tk.code_hex(tk.MERGE_BASE + r - 1))}) END AS c FROM {prev})""")
        bests.append(f"best{r}")
    return f"s0 AS ({src}),\n" + ",\n".join(ctes), bests


def _merges_select(bests: list[str], prod: bool) -> str:
    def idv(x):
        return tk.code_to_id_sql(x) if prod else x
    parts = []
    for r, b in enumerate(bests):
        left = f"('0x' || substr((SELECT pair FROM {b}), 2, {tk.DIGITS}))::INT"
        right = f"('0x' || substr((SELECT pair FROM {b}), {tk.TOKEN_WIDTH + 2}, {tk.DIGITS}))::INT"
        parts.append(f"SELECT {r} AS rank, {idv(left)} AS left_id, {idv(right)} AS right_id "
                     f"WHERE (SELECT pair FROM {b}) IS NOT NULL")
    return " UNION ALL ".join(parts)


def _merges_df(spark, vocab: V.Vocab):
    layout = vocab.layout
    rows = [(r, a, b) for r, (a, b) in enumerate(vocab.merges)]
    m = spark.createDataFrame(rows, "rank INT, l INT, r INT")
    return m.select("rank", tk.code_to_id(F.col("l"), layout, vocab.n_special).cast("int").alias("left_id"),
                    tk.code_to_id(F.col("r"), layout, vocab.n_special).cast("int").alias("right_id"))


def teaching_vocab(spark, d, table="documents", key="doc_id", rounds=TEACH_ROUNDS):
    docs = D.table(spark, d, table).select(key, "text").where(F.col("text").isNotNull())
    return V.train_teaching(docs, "text", key, 256 + rounds)


@register("b4_train_teaching", lambda: f"""
WITH {_teaching_rounds_sql("SELECT doc_id AS o, " + K.utf8('text') + " AS c FROM documents", TEACH_ROUNDS)[0]}
{_merges_select(_teaching_rounds_sql('', TEACH_ROUNDS)[1], False)}""")
def q_b4(spark, d):
    return _merges_df(spark, teaching_vocab(spark, d))


def _bench_sql_prefix() -> tuple[str, list[str]]:
    return _teaching_rounds_sql("SELECT item_id AS o, " + K.utf8("text") + " AS c FROM benchmark", BENCH_ROUNDS)


def _apply_pairs_sql(expr: str, bests: list[str]) -> str:
    out = expr
    for r, b in enumerate(bests):
        out = (f"replace({out}, coalesce((SELECT pair FROM {b}), '#'), "
               f"{K.s(tk.code_hex(tk.MERGE_BASE + r))})")
    return out


@register("b5_teaching_encode", lambda: f"""
WITH {_bench_sql_prefix()[0]},
e AS (SELECT doc_id, {_apply_pairs_sql(K.utf8('text'), _bench_sql_prefix()[1])} AS c FROM documents),
i AS (SELECT doc_id, list_transform(string_split(ltrim(c), ' '), lambda x: ('0x' || x)::INT) AS ids FROM e)
SELECT doc_id, len(ids)::BIGINT AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM i""")
def q_b5(spark, d):
    vocab = teaching_vocab(spark, d, "benchmark", "item_id", BENCH_ROUNDS)
    docs = D.table(spark, d, "documents")
    e = docs.select("doc_id", V.teaching_encode(F.col("text"), vocab).alias("ids"))
    return e.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), MD5(F.col("ids")).alias("ids_md5"))


@register("b6_teaching_decode", lambda: f"""
WITH {_bench_sql_prefix()[0]},
e AS (SELECT doc_id, text, {_apply_pairs_sql(K.utf8('text'), _bench_sql_prefix()[1])} AS c FROM documents)
SELECT doc_id, {K.ntok('c')}::BIGINT AS n_ids, text AS decoded FROM e""")
def q_b6(spark, d):
    vocab = teaching_vocab(spark, d, "benchmark", "item_id", BENCH_ROUNDS)
    docs = D.table(spark, d, "documents")
    e = docs.select("doc_id", V.teaching_encode(F.col("text"), vocab).alias("ids"))
    return e.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"),
                    V.teaching_decode(F.col("ids"), vocab).alias("decoded"))


# --- production vocabulary -------------------------------------------------------------

def _prod_rounds_sql(rounds: int) -> tuple[str, list[str]]:
    alt = K.s(tk.specials_alternation())
    words = f"""w0 AS (
  SELECT {K.utf8('w')} AS c, count(*)::BIGINT AS n
  FROM (SELECT unnest({_sql_words('piece')}) AS w
        FROM (SELECT unnest(string_split_regex(text, {alt})) AS piece FROM documents) x
        WHERE piece <> '') y
  GROUP BY w)"""
    ctes, bests = [words], []
    for r in range(1, rounds + 1):
        prev = f"w{r - 1}"
        left = tk.code_to_id_sql(f"('0x' || substr(pair, 2, {tk.DIGITS}))::INT")
        right = tk.code_to_id_sql(f"('0x' || substr(pair, {tk.TOKEN_WIDTH + 2}, {tk.DIGITS}))::INT")
        ctes.append(f"""q{r} AS (SELECT substr(c, {tk.TOKEN_WIDTH} * i + 1, {2 * tk.TOKEN_WIDTH}) AS pair, n FROM {prev},
                 LATERAL (SELECT unnest(range(0, {K.ntok('c')} - 1)) AS i))""")
        ctes.append(f"""best{r} AS (SELECT pair FROM q{r} GROUP BY pair
                 ORDER BY sum(n) DESC, {left} ASC, {right} ASC LIMIT 1)""")
        ctes.append(f"""w{r} AS (SELECT CASE WHEN (SELECT pair FROM best{r}) IS NULL THEN c
                 ELSE replace(c, (SELECT pair FROM best{r}), {K.s(tk.code_hex(tk.MERGE_BASE + r - 1))}) END AS c, n FROM {prev})""")
        bests.append(f"best{r}")
    return ",\n".join(ctes), bests


_trained: dict[tuple, str] = {}


def production_vocab(spark, d, merges=PROD_MERGES):
    """Trained once per application, table and size; then loaded from the shared folder."""
    key = (spark.sparkContext.applicationId, d, merges)
    if key not in _trained:
        docs = readers.corpus(D.table(spark, d, "documents"))
        path = shared_path(spark, f"vocab-{uuid.uuid4().hex}")
        V.save_vocab(spark, V.train_production(docs, "text", N_SP + 256 + merges), path)
        _trained[key] = path
    return V.load_vocab(spark, _trained[key])


@register("b7_train_production", lambda: f"""
WITH {_prod_rounds_sql(PROD_MERGES)[0]}
{_merges_select(_prod_rounds_sql(PROD_MERGES)[1], True)}""")
def q_b7(spark, d):
    return _merges_df(spark, production_vocab(spark, d))


def _encoded_cte(src: str, key: str, text: str, out: str) -> str:
    """CTEs up to ``out`` (key, c): pieces between specials (position i), words in each piece
    (position j), each word encoded by the unrolled merges, reassembled in order."""
    bests = _prod_rounds_sql(PROD_MERGES)[1]
    alt = K.s(tk.specials_alternation())
    o = out
    return f"""{o}_pp AS (SELECT {key}, string_split_regex({text}, {alt}) AS parts, regexp_extract_all({text}, {alt}) AS seps FROM {src}),
{o}_pi AS (SELECT {key}, i, parts[i] AS p, seps[i] AS sep FROM {o}_pp, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)),
{o}_pw AS (SELECT {key}, i, {_sql_words('p')} AS words FROM {o}_pi),
{o}_wi AS (SELECT {key}, i, j, words[j] AS w FROM {o}_pw, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS j)),
{o}_wc AS (SELECT {key}, i, j, {_apply_pairs_sql(K.utf8('w'), bests)} AS c FROM {o}_wi),
{o}_pc AS (SELECT {key}, i, string_agg(c, '' ORDER BY j) AS c FROM {o}_wc GROUP BY {key}, i),
{o} AS (SELECT x.{key}, string_agg(coalesce(y.c, '') || coalesce({K.special_code('x.sep')}, ''), '' ORDER BY x.i) AS c
        FROM {o}_pi x LEFT JOIN {o}_pc y ON y.{key} = x.{key} AND y.i = x.i GROUP BY x.{key})"""


def _tokenized_cte() -> str:
    return f"""{_prod_rounds_sql(PROD_MERGES)[0]},
{_encoded_cte('documents', 'doc_id', 'text', 'enc')},
tok AS (SELECT d.doc_id, d.lang, d.text, {K.code_ids_fast("coalesce(e.c, '')")} AS ids
        FROM documents d LEFT JOIN enc e USING (doc_id))"""


@register("b10_tokenize_corpus", lambda: f"""
WITH {_tokenized_cte()}
SELECT doc_id, len(ids)::BIGINT AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM tok""")
def q_b10(spark, d):
    return _tokenized(spark, d, production_vocab(spark, d))


def _tokenized(spark, d, vocab):
    t = V.encode_ids(D.table(spark, d, "documents").select("doc_id", "text"), "text", vocab)
    return t.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), MD5(F.col("ids")).alias("ids_md5"))


# The default vocabulary has 6,120 merges: no SQL unrolls them, the tests compare with brute force.

@register("b7_train_default")
def q_b7_default(spark, d):
    return _merges_df(spark, production_vocab(spark, d, VOCAB_SIZE - N_SP - 256))


@register("b10_tokenize_default")
def q_b10_default(spark, d):
    return _tokenized(spark, d, production_vocab(spark, d, VOCAB_SIZE - N_SP - 256))


@register("b13_round_trip_default", "SELECT doc_id, text AS decoded FROM documents")
def q_b13_default(spark, d):
    """Every text tokenized with the default vocabulary and decoded again."""
    vocab = production_vocab(spark, d, VOCAB_SIZE - N_SP - 256)
    t = V.encode_ids(D.table(spark, d, "documents").select("doc_id", "text"), "text", vocab)
    return t.select("doc_id", F.when(F.col("text").isNotNull(), V.decode_ids(F.col("ids"), vocab, False)).alias("decoded"))


@register("b14_compression_trained", lambda: f"""
WITH {_tokenized_cte()}
SELECT lang, sum(len(ids))::BIGINT AS n_tokens, sum(length(text))::BIGINT AS n_chars,
  round(sum(len(ids)) / sum(length(text)), 6) AS tokens_per_char,
  round(sum(length(text)) / sum(len(ids)), 6) AS chars_per_token
FROM tok GROUP BY lang""")
def q_b14t(spark, d):
    vocab = production_vocab(spark, d)
    docs = D.table(spark, d, "documents").select("doc_id", "lang", "text")
    enc = V.encode_corpus(docs, "text", vocab, "codes")
    return V.compression_report(enc, "lang", "text", "codes")


# --- rendering and row builders on the trained vocabulary ---------------------------------

def _anchors_sql() -> tuple[str, str]:
    """Code text of the span anchors, from the trained merges."""
    bests = _prod_rounds_sql(PROD_MERGES)[1]
    word, end = (_apply_pairs_sql(K.utf8(x), bests) for x in ("'assistant'", "chr(10)"))
    return f"{K.special_code(K.s(tk.BOS))} || {word} || {end}", f"{K.special_code(K.s(tk.EOS))} || {end}"


PAD_ID = tk.ALL_SPECIAL_TOKENS.index(tk.PAD)


@register("d1_trained", lambda: f"""
WITH {_prod_rounds_sql(PROD_MERGES)[0]},
{_encoded_cte('documents', 'doc_id', 'text', 'enc')},
r AS (SELECT doc_id, {K.ntok('c')} AS n, {K.code_ids_fast(K.pad(f"{K.special_code(K.s(tk.BOS))} || {K.trunc('c', 510)} || {K.special_code(K.s(tk.EOS))}", 512))} AS ids FROM enc)
SELECT doc_id, n::BIGINT AS n_raw_tokens, md5(array_to_string(ids, ',')) AS ids_md5,
  md5(array_to_string(list_transform(ids, lambda x: CASE WHEN x = {PAD_ID} THEN -100 ELSE x END), ',')) AS labels_md5 FROM r""")
def q_d1_trained(spark, d):
    r = rows.pretrain_rows(D.table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], "text", production_vocab(spark, d), 512)
    return r.select("doc_id", F.col("n_raw_tokens").cast("bigint").alias("n_raw_tokens"),
                    MD5(F.col("input_ids")).alias("ids_md5"), MD5(F.col("labels")).alias("labels_md5"))


@register("c6_chat_tokens", lambda: f"""
WITH {_prod_rounds_sql(PROD_MERGES)[0]}, {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte(gen_prompt=True)},
{_encoded_cte('rendered', 'conv_id', 'prompt', 'enc')},
i AS (SELECT conv_id, {K.code_ids_fast('c')} AS ids FROM enc)
SELECT conv_id, len(ids)::BIGINT AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM i""")
def q_c6(spark, d):
    t = rows.chat_template(D.messages(spark, d), "messages", production_vocab(spark, d), tokenize=True, add_generation_prompt=True)
    return t.select("conv_id", F.size("input_ids").cast("bigint").alias("n_tokens"), MD5(F.col("input_ids")).alias("ids_md5"))


@register("d7_trained", lambda: f"""
WITH {_prod_rounds_sql(PROD_MERGES)[0]}, {K.turns_cte()}, {K.conv_meta_cte()}, {K.rendered_cte(system_prompt=True)},
pr AS (SELECT conv_id, {K.drop_think('prompt', 'conv_id')} AS prompt FROM rendered),
{_encoded_cte('pr', 'conv_id', 'prompt', 'enc')},
anchor AS (SELECT {_anchors_sql()[0]} AS b, {_anchors_sql()[1]} AS e),
c AS (SELECT conv_id, {K.pad(K.trunc('c', 1024), 1024)} AS c, b, e FROM enc, anchor),
l AS (SELECT conv_id, {K.code_ids_fast('c')} AS ids, {K.span_mask_of('c', 'b', 'e', 'true', 'false')} AS m FROM c)
SELECT conv_id, len(list_filter(m, lambda x: x))::BIGINT AS n_label_tokens, md5(array_to_string(ids, ',')) AS ids_md5,
  md5(array_to_string(list_transform(list_zip(ids, m), lambda z: CASE WHEN z[2] THEN z[1] ELSE -100 END), ',')) AS labels_md5 FROM l""")
def q_d7_trained(spark, d):
    r = rows.sft_rows(D.messages(spark, d), "conv_id", "messages", production_vocab(spark, d), 1024)
    return r.select("conv_id", F.size(F.filter("labels", lambda x: x != -100)).cast("bigint").alias("n_label_tokens"),
                    MD5(F.col("input_ids")).alias("ids_md5"), MD5(F.col("labels")).alias("labels_md5"))


def _pref_trained_sql(max_length: int = 1024) -> str:
    from .q_text import pref_texts_sql
    sides = ("chosen", "rejected")
    coded = ",\n".join(f"""r_{x} AS (SELECT pair_id, {K.drop_think('p', 'pair_id', f'empty-think-{x}')} AS p FROM pieces_{x}),
{_encoded_cte(f'r_{x}', 'pair_id', 'p', f'enc_{x}')},
c_{x} AS (SELECT pair_id, {K.pad(K.trunc('c', max_length), max_length)} AS c, b, e FROM enc_{x}, anchor),
m_{x} AS (SELECT pair_id, {K.code_ids_fast('c')} AS ids, {K.span_mask_of('c', 'b', 'e', '1', '0')} AS mask FROM c_{x})""" for x in sides)
    cols = ", ".join(f"md5(array_to_string(m_{x}.ids[1:{max_length - 1}], ',')) AS x_{x}_md5, "
                     f"md5(array_to_string(m_{x}.mask[2:{max_length}], ',')) AS mask_{x}_md5" for x in sides)
    return f"""WITH {_prod_rounds_sql(PROD_MERGES)[0]}, {pref_texts_sql()},
anchor AS (SELECT {_anchors_sql()[0]} AS b, {_anchors_sql()[1]} AS e), {coded}
SELECT pair_id, {cols} FROM m_chosen JOIN m_rejected USING (pair_id)"""


@register("d8_trained", _pref_trained_sql)
def q_d8_trained(spark, d):
    r = rows.preference_rows(D.pairs(spark, d), "pair_id", "chosen", "rejected", production_vocab(spark, d), 1024)
    return r.select("pair_id", *(MD5(F.col(f"{k}_{x}")).alias(f"{k}_{x}_md5") for x in ("chosen", "rejected") for k in ("x", "mask")))


def _symbol_sql(b: str) -> str:
    rank = tk.alphabet_rank_sql(b)
    return (f"chr(CAST(CASE WHEN ({b} BETWEEN 33 AND 126) OR ({b} BETWEEN 161 AND 172) OR {b} >= 174 "
            f"THEN {b} ELSE 256 + {rank} - 188 END AS INTEGER))")


@register("a8_vocab_roundtrip", lambda: f"""
WITH {_prod_rounds_sql(PROD_MERGES)[0]},
m AS ({_merges_select(_prod_rounds_sql(PROD_MERGES)[1], True)}),
ex AS (SELECT m.rank, m.left_id, m.right_id,
         {_expand_sql(_prod_rounds_sql(PROD_MERGES)[1])} AS bytes FROM m)
SELECT (rank + {N_SP + 256})::INT AS id,
  array_to_string(list_transform(string_split(ltrim(bytes), ' '), lambda x: {_symbol_sql("('0x' || x)::INT")}), '') AS token
FROM ex""")
def q_a8(spark, d):
    vocab = production_vocab(spark, d)
    path = shared_path(spark, f"vocab-{uuid.uuid4().hex}")
    V.save_vocab(spark, vocab, path)
    back = V.load_vocab(spark, path + "/merges")
    if back != vocab:
        raise AssertionError("vocabulary did not survive save/load")
    vt = spark.read.parquet(path + "/vocab")
    return vt.where(F.col("id") >= N_SP + 256).select("id", "token")


@register("a8_tokenizer_file", "SELECT doc_id, true AS equal FROM documents")
def q_a8_file(spark, d):
    """Every text's ids by the trained vocabulary and by the one read back from its tokenizer file."""
    vocab = production_vocab(spark, d)
    path = shared_path(spark, f"tokenizer-{uuid.uuid4().hex}")
    V.save_tokenizer_file(spark, vocab, path)
    back = V.load_tokenizer_file(spark, path)
    docs = V.encode_ids(D.table(spark, d, "documents").select("doc_id", "text"), "text", vocab, "a")
    return V.encode_ids(docs, "text", back, "b").select("doc_id", (F.col("a") == F.col("b")).alias("equal"))


def _expand_sql(bests: list[str]) -> str:
    """Code text of merge ``rank`` expanded to bytes: start from its code, undo merges
    newest-first."""
    out = f"printf('{tk.CODE_FORMAT}', {tk.MERGE_BASE} + m.rank)"
    for r in range(len(bests) - 1, -1, -1):
        out = f"replace({out}, {K.s(tk.code_hex(tk.MERGE_BASE + r))}, coalesce((SELECT pair FROM {bests[r]}), '#'))"
    return out
