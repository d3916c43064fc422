"""Registered queries: next-token candidates (G) and documented statistics (H)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..operators import candidates as G
from ..operators import metrics as M
from ..operators import stats as H
from ..operators import vocab as V
from ..operators.ordering import ordered_index
from . import derived as D
from . import sqlkit as K
from .registry import register

R6 = lambda c: F.round(c, 6)
EOS_TOKEN = 3


def logits(spark, d):
    e = D.table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("logits"),
                    F.floor(F.col("vec_id") / 10).cast("bigint").alias("seq"), (F.col("vec_id") % 10).cast("int").alias("pos"))


UNNEST = """u AS (SELECT vec_id, label, vec_id // 10 AS seq, vec_id % 10 AS pos, CAST(x AS DOUBLE) AS x, i - 1 AS token_id
      FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings))"""


@register("g1_greedy", f"""WITH {UNNEST}
SELECT vec_id, token_id::INT AS token_id FROM u QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, token_id) = 1""")
def q_g1(spark, d):
    return logits(spark, d).select("vec_id", G.greedy(F.col("logits")).alias("token_id"))


@register("g2_temperature_probs", f"""WITH {UNNEST},
s AS (SELECT vec_id, token_id, exp(x / 0.7 - max(x / 0.7) OVER (PARTITION BY vec_id)) AS e FROM u)
SELECT vec_id, token_id::INT AS token_id, round(e / sum(e) OVER (PARTITION BY vec_id), 6) AS prob FROM s""")
def q_g2(spark, d):
    c = G.candidate_table(logits(spark, d), ["vec_id"], "logits", temperature=0.7)
    return c.select("vec_id", "token_id", R6(F.col("prob")).alias("prob"))


@register("g3_top_k", f"""WITH {UNNEST}
SELECT vec_id, token_id::INT AS token_id FROM (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY x DESC) AS rk FROM u)
WHERE rk <= 5""")
def q_g3(spark, d):
    c = G.candidate_table(logits(spark, d), ["vec_id"], "logits", top_k=5)
    return c.where(F.col("prob") > 0).select("vec_id", "token_id")


TOPP_SQL = f"""WITH {UNNEST},
k AS (SELECT vec_id, token_id, x / 0.8 AS x FROM (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY x DESC) AS rk FROM u)
      WHERE rk <= 20),
p AS (SELECT vec_id, token_id, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM k),
q AS (SELECT vec_id, token_id, e / sum(e) OVER (PARTITION BY vec_id) AS prob FROM p),
b AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY vec_id ORDER BY prob DESC, token_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING), 0.0) AS before FROM q),
kept AS (SELECT vec_id, token_id, prob / sum(prob) OVER (PARTITION BY vec_id) AS prob FROM b WHERE before < 0.9)"""


def _top_p(spark, d):
    c = G.candidate_probs(logits(spark, d), "logits", temperature=0.8, top_k=20)
    return c.select("vec_id", G.top_p_filter(F.col("probs"), 0.9).alias("probs"))


@register("g4_top_p", f"""{TOPP_SQL}
SELECT vec_id, token_id::INT AS token_id, round(prob, 6) AS prob FROM kept""")
def q_g4(spark, d):
    kept = _top_p(spark, d).select("vec_id", F.posexplode("probs").alias("token_id", "prob")).where("prob > 0")
    return kept.select("vec_id", "token_id", R6(F.col("prob")).alias("prob"))


@register("g5_repetition_penalty", f"""WITH {UNNEST},
seen AS (SELECT DISTINCT a.vec_id, b.label AS token_id FROM (SELECT DISTINCT vec_id, seq, pos FROM u) a
         JOIN (SELECT DISTINCT vec_id, seq, pos, label FROM u) b ON b.seq = a.seq AND b.pos BETWEEN a.pos - 3 AND a.pos - 1),
pen AS (SELECT u.vec_id, u.token_id, CASE WHEN s.token_id IS NULL THEN x WHEN x > 0 THEN x / 1.3 ELSE x * 1.3 END AS x
        FROM u LEFT JOIN seen s ON s.vec_id = u.vec_id AND s.token_id = u.token_id)
SELECT vec_id, token_id::INT AS token_id FROM pen QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, token_id) = 1""")
def q_g5(spark, d):
    lg = logits(spark, d)
    w = Window.partitionBy("seq").orderBy("pos").rowsBetween(-3, -1)
    lg = lg.withColumn("seen", F.collect_set("label").over(w))
    pen = G.apply_repetition_penalty(F.col("logits"), F.col("seen"), 1.3)
    return lg.select("vec_id", G.greedy(pen).alias("token_id"))


@register("g6_weighted_draw", f"""{TOPP_SQL},
c AS (SELECT *, sum(prob) OVER (PARTITION BY vec_id ORDER BY token_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             {K.draw('vec_id', 'sample-draw')} AS u FROM kept)
SELECT vec_id, token_id::INT AS token_id FROM c WHERE cum >= u
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY token_id) = 1""")
def q_g6(spark, d):
    return _top_p(spark, d).select("vec_id", G.weighted_draw(F.col("probs"), F.col("vec_id")).alias("token_id"))


@register("g7_stop_at_eos", f"""WITH {UNNEST},
g AS (SELECT vec_id, seq, pos, token_id FROM u QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, token_id) = 1),
s AS (SELECT seq, min(CASE WHEN token_id = {EOS_TOKEN} THEN pos END) AS first_eos, count(*) AS n FROM g GROUP BY seq),
b AS (SELECT seq // 5 AS batch, pos, bool_and(token_id = {EOS_TOKEN}) AS all_eos FROM g GROUP BY ALL),
bs AS (SELECT batch, min(pos) AS stop_step FROM b WHERE all_eos GROUP BY batch)
SELECT s.seq, (CASE WHEN first_eos IS NULL THEN n ELSE first_eos + 1 END)::INT AS n_kept, bs.stop_step::INT AS stop_step
FROM s LEFT JOIN bs ON bs.batch = s.seq // 5""")
def q_g7(spark, d):
    g = logits(spark, d).select("seq", "pos", G.greedy(F.col("logits")).alias("token_id"))
    per_seq = g.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_t"))
    per_seq = per_seq.select("seq", F.size(G.stop_at_eos(F.transform("_t", lambda x: x["token_id"]), EOS_TOKEN))
                             .cast("int").alias("n_kept"))
    stop = G.batch_stop_step(g.withColumn("batch", F.floor(F.col("seq") / 5)), ["batch"], "pos", "token_id", EOS_TOKEN)
    return (per_seq.withColumn("batch", F.floor(F.col("seq") / 5)).join(stop, "batch", "left")
            .select("seq", "n_kept", F.col("stop_step").cast("int").alias("stop_step")))


@register("g8_tokens_per_sec", """
SELECT user_id, sum(CAST(json_extract_string(props, '$.k') AS INTEGER))::BIGINT AS new_tokens,
       round(sum(value) / 100.0, 6) AS elapsed,
       round(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) / greatest(sum(value) / 100.0, 1e-6), 6) AS tokens_per_sec
FROM events GROUP BY user_id""")
def q_g8(spark, d):
    ev = D.table(spark, d, "events").select("user_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                                            (F.col("value") / 100.0).alias("elapsed"))
    t = G.tokens_per_second(ev, ["user_id"], "k", "elapsed")
    return t.select("user_id", "new_tokens", R6(F.col("elapsed")).alias("elapsed"), R6(F.col("tokens_per_sec")).alias("tokens_per_sec"))


# --- H ---------------------------------------------------------------------------

@register("h1_cosine_neighbours", f"""WITH {UNNEST},
cen AS (SELECT label AS query_id, token_id, avg(x) AS c FROM u GROUP BY ALL),
cn AS (SELECT query_id, sqrt(sum(c * c)) AS n FROM cen GROUP BY ALL),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM u GROUP BY ALL),
dp AS (SELECT cen.query_id, u.vec_id, sum(cen.c * u.x) AS d FROM cen JOIN u USING (token_id) GROUP BY ALL),
cs AS (SELECT dp.query_id, dp.vec_id, d / (cn.n * vn.n) AS cosine FROM dp JOIN cn USING (query_id) JOIN vn USING (vec_id))
SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS rank, round(cosine, 6) AS cosine
FROM cs QUALIFY rank <= 5""")
def q_h1(spark, d):
    lg = logits(spark, d)
    ex = lg.select("label", F.posexplode("logits").alias("i", "x"))
    cen = ex.groupBy("label", "i").agg(F.avg("x").alias("c")).groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("i", "c"))).alias("_c"))
    cen = cen.select(F.col("label").alias("query_id"), F.transform("_c", lambda s: s["c"]).alias("centroid"))
    top = H.top_neighbours(lg, cen, "vec_id", "logits", "query_id", "centroid", 5)
    return top.select("query_id", "vec_id", F.col("rank").cast("bigint").alias("rank"), R6(F.col("cosine")).alias("cosine"))


@register("h2_dot_norms", """
SELECT a.vec_id, round(sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))), 6) AS norm,
       round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS dot_next
FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def q_h2(spark, d):
    e = logits(spark, d)
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("logits").alias("next"))
    j = e.join(nxt, "vec_id", "left")
    return j.select("vec_id", R6(H.norm(F.col("logits"))).alias("norm"),
                    R6(F.when(F.col("next").isNotNull(), H.dot(F.col("logits"), F.col("next")))).alias("dot_next"))


@register("h3_moments", """
SELECT event_type, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS var, round(stddev_pop(value), 6) AS std,
  round(covar_pop(value, CAST(json_extract_string(props, '$.k') AS INTEGER)), 6) AS cov_value_k,
  round(corr(value, CAST(json_extract_string(props, '$.k') AS INTEGER)), 6) AS corr_value_k
FROM events GROUP BY event_type""")
def q_h3(spark, d):
    ev = D.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return ev.groupBy("event_type").agg(R6(F.avg("value")).alias("mean"), R6(F.var_pop("value")).alias("var"),
                                        R6(F.stddev_pop("value")).alias("std"),
                                        R6(F.covar_pop("value", "k")).alias("cov_value_k"),
                                        R6(F.corr("value", "k")).alias("corr_value_k"))


PCA_ROUNDS = 100


def _pca_sql(k: int = 5) -> str:
    unit = "list_transform([{0}], lambda z: list_transform(z, lambda e: e / sqrt(list_dot_product(z, z))))[1]"
    times = "list_transform(m, lambda r: list_dot_product(r, {0}))"
    ctes = []
    for c in range(k):
        step = unit.format(times.format("v"))
        start = unit.format("list_transform(range(1, len(m) + 1), lambda i: i::DOUBLE)")
        ctes.append(f"""v{c} AS (SELECT m, trace, list_reduce(list_concat([{start}], list_transform(range({PCA_ROUNDS}), lambda i: [0.0::DOUBLE])), lambda v, i: {step}) AS v FROM m{c}),
l{c} AS (SELECT m, trace, v, list_dot_product({times.format('v')}, v) AS l FROM v{c}),
m{c + 1} AS (SELECT list_transform(list_zip(m, v), lambda p: list_transform(list_zip(p[1], v), lambda q: q[1] - l * p[2] * q[2])) AS m, trace FROM l{c})""")
    return f"""e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT vec_id, unnest(x) AS a, generate_subscripts(x, 1) AS i FROM e),
mu AS (SELECT i, avg(a) AS mean, count(*) AS n FROM u GROUP BY i),
c AS (SELECT p.i, q.i AS j, sum(p.a * q.a) / any_value(mu.n) AS s FROM u p JOIN u q USING (vec_id) JOIN mu ON mu.i = p.i GROUP BY ALL),
cv AS (SELECT c.i, c.j, c.s - a.mean * b.mean AS cov FROM c JOIN mu a ON a.i = c.i JOIN mu b ON b.i = c.j),
r AS (SELECT i, list(cov ORDER BY j) AS row_ FROM cv GROUP BY i),
m0 AS (SELECT list(row_ ORDER BY i) AS m, sum(row_[i]) AS trace FROM r),
{", ".join(ctes)}
""" + " UNION ALL ".join(f"SELECT {c}::INT AS component, round(l / trace, 6) AS ratio FROM l{c}" for c in range(k))


@register("h4_pca_explained_variance", lambda: f"WITH {_pca_sql()}")
def q_h4(spark, d):
    cov = H.moments(D.table(spark, d, "embeddings"), "embedding")
    return H.explained_variance(cov, 5, PCA_ROUNDS).select("component", R6(F.col("ratio")).alias("ratio"))


BYTES_SQL = "b AS (SELECT lang, unnest(string_split(ltrim(" + K.utf8("text") + "), ' ')) AS byte FROM documents)"


def _bytes(spark, d):
    return H.byte_counts(D.table(spark, d, "documents"), "text", ["lang"])


@register("h5_byte_entropy", f"""WITH {BYTES_SQL},
c AS (SELECT lang, byte, count(*) AS n FROM b GROUP BY ALL),
p AS (SELECT lang, n / sum(n) OVER (PARTITION BY lang) AS p FROM c)
SELECT lang, round(-sum(p * ln(p)), 6) AS entropy_nat, round(-sum(p * ln(p)) / ln(2), 6) AS entropy_bit,
       round(max(-ln(p)), 6) AS max_self_info_nat FROM p GROUP BY lang""")
def q_h5(spark, d):
    e = H.entropy(H.shares(_bytes(spark, d), ["lang"]), ["lang"])
    return e.select("lang", *[R6(F.col(c)).alias(c) for c in ("entropy_nat", "entropy_bit", "max_self_info_nat")])


@register("h6_divergences", f"""WITH {BYTES_SQL},
c AS (SELECT lang, byte, count(*) AS n FROM b GROUP BY ALL),
l AS (SELECT DISTINCT lang FROM c),
u AS (SELECT x.lang AS lang_p, y.lang AS lang_q, c.byte, sum(CASE WHEN c.lang = x.lang THEN n ELSE 0 END) AS np,
             sum(CASE WHEN c.lang = y.lang THEN n ELSE 0 END) AS nq
      FROM l x JOIN l y ON x.lang < y.lang JOIN c ON c.lang IN (x.lang, y.lang) GROUP BY ALL),
s AS (SELECT lang_p, lang_q, (np + 1.0) / (sum(np) OVER w + count(*) OVER w) AS p, (nq + 1.0) / (sum(nq) OVER w + count(*) OVER w) AS q
      FROM u WINDOW w AS (PARTITION BY lang_p, lang_q))
SELECT lang_p, lang_q, round(-sum(p * ln(q)), 6) AS cross_entropy, round(-sum(p * ln(p)), 6) AS entropy_p,
       round(sum(p * ln(p) - p * ln(q)), 6) AS kl,
       round(0.5 * sum(p * ln(p) - p * ln((p + q) / 2)) + 0.5 * sum(q * ln(q) - q * ln((p + q) / 2)), 6) AS js FROM s GROUP BY ALL""")
def q_h6(spark, d):
    """Byte distributions of every pair of languages, add-one smoothed over the pair's bytes."""
    c = _bytes(spark, d)
    langs = c.select("lang").distinct()
    pairs = langs.select(F.col("lang").alias("lang_p")).join(langs.select(F.col("lang").alias("lang_q")), F.col("lang_p") < F.col("lang_q"))
    sides = [pairs.join(c.withColumnRenamed("lang", f"lang_{x}"), f"lang_{x}").select(
        "lang_p", "lang_q", "byte", *(F.col("n").alias(f"n{y}") if x == y else F.lit(0).cast("bigint").alias(f"n{y}") for y in "pq"))
        for x in "pq"]
    u = sides[0].union(sides[1]).groupBy("lang_p", "lang_q", "byte").agg(F.sum("np").alias("np"), F.sum("nq").alias("nq"))
    w = Window.partitionBy("lang_p", "lang_q")  # the bytes of one pair: 256 rows at most
    share = [((F.col(f"n{x}") + 1.0) / (F.sum(f"n{x}").over(w) + F.count(F.lit(1)).over(w))).alias(x) for x in "pq"]
    out = H.divergences(u.select("lang_p", "lang_q", *share), ["lang_p", "lang_q"])
    return out.select("lang_p", "lang_q", *[R6(F.col(c)).alias(c) for c in ("cross_entropy", "entropy_p", "kl", "js")])


@register("h8_mutual_information", """
WITH j AS (SELECT d.lang AS x, l.quality AS y FROM documents d JOIN labels l USING (doc_id)),
n AS (SELECT count(*) AS n FROM j),
xy AS (SELECT x, y, count(*) AS nxy FROM j GROUP BY ALL),
px AS (SELECT x, count(*) AS nx FROM j GROUP BY x), py AS (SELECT y, count(*) AS ny FROM j GROUP BY y)
SELECT round(sum(nxy / n * ln((nxy / n) / ((nx / n) * (ny / n)))), 6) AS mutual_info
FROM xy JOIN px USING (x) JOIN py USING (y), n""")
def q_h8(spark, d):
    j = D.table(spark, d, "documents").join(D.table(spark, d, "labels"), "doc_id").select(
        F.col("lang").alias("x"), F.col("quality").alias("y"))
    return H.mutual_information(j, "x", "y").select(R6(F.col("mutual_info")).alias("mutual_info"))


@register("h9_perplexity", f"""WITH {UNNEST},
m AS (SELECT vec_id, label, token_id, x, max(x) OVER (PARTITION BY vec_id) AS mx FROM u),
z AS (SELECT vec_id, any_value(label) AS label, any_value(mx) + ln(sum(exp(x - mx))) AS z,
             max(CASE WHEN token_id = label THEN x END) AS xl FROM m GROUP BY vec_id)
SELECT label, count(*)::BIGINT AS n_tokens, round(avg(z - xl), 6) AS mean_nll, round(exp(avg(z - xl)), 6) AS perplexity
FROM z GROUP BY label""")
def q_h9(spark, d):
    lg = logits(spark, d).withColumn("logp", M.label_log_prob(F.col("logits"), F.col("label")))
    p = H.perplexity(lg, ["label"], "logp")
    return p.select("label", "n_tokens", R6(F.col("mean_nll")).alias("mean_nll"), R6(F.col("perplexity")).alias("perplexity"))


@register("h10_pair_scores", f"""
WITH c AS (SELECT {K.utf8('text')} AS c FROM documents),
p AS (SELECT ' ' || t[i] || ' ' || t[i + 1] AS pair FROM (SELECT string_split(ltrim(c), ' ') AS t FROM c),
      LATERAL (SELECT unnest(range(1, len(t))) AS i)),
pc AS (SELECT ('0x' || substr(pair, 2, {tk.DIGITS}))::INT AS "left", ('0x' || substr(pair, {tk.TOKEN_WIDTH + 2}, {tk.DIGITS}))::INT AS "right", count(*) AS n FROM p GROUP BY pair),
uc AS (SELECT ('0x' || x)::INT AS token, count(*) AS n FROM (SELECT unnest(string_split(ltrim(c), ' ')) AS x FROM c) GROUP BY x)
SELECT pc."left", pc."right", pc.n::BIGINT AS count, round(pc.n / (a.n * b.n::DOUBLE), 9) AS score
FROM pc JOIN uc a ON a.token = pc."left" JOIN uc b ON b.token = pc."right"
""")
def q_h10(spark, d):
    """All pairs of adjacent bytes with their score; one pass counts pairs and single bytes."""
    found = H.byte_counts(D.table(spark, d, "documents"), "text", pairs=True)
    single = found.where(F.col("right").isNull()).select(F.col("left").alias("token"), F.col("n").alias("count"))
    pairs = found.where(F.col("right").isNotNull()).withColumnRenamed("n", "count")
    return H.pair_scores(pairs, single).select("left", "right", "count", F.round("score", 9).alias("score"))


def _train_log(spark, d):
    ev = D.table(spark, d, "events").select("event_id", "ts", "value")
    log = ordered_index(ev, [], ["ts", "event_id"], "step")
    return log.select("step", (F.col("value") / 100.0).alias("loss"))


LOG_SQL = "lg AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS step, value / 100.0 AS loss FROM events)"


@register("h11_plateau", f"""WITH {LOG_SQL},
j AS (SELECT a.step, b.loss - a.loss AS drop FROM lg a JOIN lg b ON b.step = a.step - 1000)
SELECT count(*)::BIGINT AS n_checked, count(*) FILTER (WHERE drop < 0.01)::BIGINT AS n_plateau,
       min(step) FILTER (WHERE drop < 0.01)::BIGINT AS first_plateau_step FROM j""")
def q_h11(spark, d):
    p = H.plateau(_train_log(spark, d), "step", "loss", 1000, 0.01)
    return p.agg(F.count(F.lit(1)).cast("bigint").alias("n_checked"),
                 F.count(F.when(F.col("plateau"), 1)).cast("bigint").alias("n_plateau"),
                 F.min(F.when(F.col("plateau"), F.col("step"))).cast("bigint").alias("first_plateau_step"))


@register("h12_epoch_summary", f"""WITH {LOG_SQL}
SELECT ((step - 1) // 2500)::BIGINT AS epoch, count(*)::BIGINT AS n_steps, round(avg(loss), 6) AS mean_loss,
       round(arg_min(loss, step), 6) AS first_loss, round(arg_max(loss, step), 6) AS last_loss FROM lg GROUP BY ALL""")
def q_h12(spark, d):
    log = _train_log(spark, d).withColumn("epoch", F.floor((F.col("step") - 1) / 2500).cast("bigint"))
    s = H.epoch_summary(log, "epoch", "step", "loss")
    return s.select("epoch", "n_steps", *[R6(F.col(c)).alias(c) for c in ("mean_loss", "first_loss", "last_loss")])


@register("h13_log_steps", f"""WITH {LOG_SQL}
SELECT step::BIGINT AS step, round(loss, 6) AS loss FROM lg WHERE step % 100 = 0 OR step = (SELECT count(*) FROM events)""")
def q_h13(spark, d):
    log = _train_log(spark, d)
    total = log.agg(F.max("step").alias("total")).withColumn("_k", F.lit(1))
    j = log.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")
    return H.log_steps(j, "step", F.col("total"), 100).select("step", R6(F.col("loss")).alias("loss"))


@register("h14_duration_labels", """
WITH s AS (SELECT event_id, value * 30.0 AS sec FROM events),
m AS (SELECT event_id, sec, floor(sec / 60) AS mi FROM s)
SELECT event_id, round(sec, 6) AS seconds,
  CASE WHEN sec < 60 THEN printf('%ds', round_even(sec, 0)::BIGINT)
       WHEN mi < 60 THEN printf('%dm%02ds', mi::BIGINT, round_even(sec - mi * 60, 0)::BIGINT)
       ELSE printf('%dh%02dm', floor(mi / 60)::BIGINT, (mi - floor(mi / 60) * 60)::BIGINT) END AS label
FROM m""")
def q_h14(spark, d):
    ev = D.table(spark, d, "events").select("event_id", (F.col("value") * 30.0).alias("sec"))
    return ev.select("event_id", R6(F.col("sec")).alias("seconds"), H.duration_label(F.col("sec")).alias("label"))


@register("h15_power_law_fit", """
WITH r AS (SELECT user_id, sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) + 1 AS n, avg(value) / 100.0 AS loss
           FROM events GROUP BY user_id)
SELECT count(*)::BIGINT AS n_runs, round(-regr_slope(ln(loss), ln(n)), 6) AS alpha,
       round(regr_intercept(ln(loss), ln(n)) / -regr_slope(ln(loss), ln(n)), 6) AS log_n_c FROM r""")
def q_h15(spark, d):
    ev = D.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    runs = ev.groupBy("user_id").agg((F.sum("k") + 1).alias("n"), (F.avg("value") / 100.0).alias("loss"))
    f = H.power_law_fit(runs, "n", "loss")
    return f.select("n_runs", R6(F.col("alpha")).alias("alpha"), R6(F.col("log_n_c")).alias("log_n_c"))
