"""Registered queries: per-token metrics (E) and tool-use reward (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import toolcalls as T
from . import derived as D
from . import sqlkit as K
from .registry import register

R6 = lambda c: F.round(c, 6)


# --- derived logit rows (embeddings) -----------------------------------------------------

def logit_rows(spark, d):
    """One position per embedding: seq = vec_id div 10, pos = vec_id % 10; label 9 is
    ignored (-100); loss mask 1 from position 2 on."""
    e = D.table(spark, d, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("logits"), "label",
                    F.floor(F.col("vec_id") / 10).cast("bigint").alias("seq"), (F.col("vec_id") % 10).cast("int").alias("pos"),
                    F.when(F.col("label") == 9, F.lit(-100)).otherwise(F.col("label")).alias("label_used"),
                    F.when(F.col("vec_id") % 10 >= 2, 1).otherwise(0).alias("mask"))


def with_teacher(spark, d):
    r = logit_rows(spark, d)
    t = D.table(spark, d, "embeddings").select((F.col("vec_id") - 1).alias("vec_id"),
                                               F.col("embedding").cast("array<double>").alias("teacher"))
    return r.join(t, "vec_id")


# DuckDB cannot nest aggregates; logsumexp via a window max.
LOGITS_SQL = """lr AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS logits, label, vec_id // 10 AS seq, vec_id % 10 AS pos,
         CASE WHEN label = 9 THEN -100 ELSE label END AS label_used, CASE WHEN vec_id % 10 >= 2 THEN 1 ELSE 0 END AS mask
  FROM embeddings),
ux AS (SELECT vec_id, unnest(logits) AS x FROM lr),
ux2 AS (SELECT vec_id, x, max(x) OVER (PARTITION BY vec_id) AS m FROM ux),
lse AS (SELECT vec_id, any_value(m) + ln(sum(exp(x - m))) AS z FROM ux2 GROUP BY vec_id)"""


@register("e1_label_log_probs", f"""
WITH {LOGITS_SQL}
SELECT lr.vec_id, round(lr.logits[lr.label + 1] - lse.z, 6) AS log_prob FROM lr JOIN lse USING (vec_id)""")
def q_e1(spark, d):
    r = logit_rows(spark, d)
    return r.select("vec_id", R6(M.label_log_prob(F.col("logits"), F.col("label"))).alias("log_prob"))


@register("e2_next_token_ce", f"""
WITH {LOGITS_SQL}
SELECT count(*)::BIGINT AS n_tokens, round(avg(-(a.logits[b.label_used + 1] - lse.z)), 6) AS ce
FROM lr a JOIN lr b ON b.seq = a.seq AND b.pos = a.pos + 1 JOIN lse ON lse.vec_id = a.vec_id
WHERE b.label_used <> -100""")
def q_e2(spark, d):
    out = M.next_token_ce(logit_rows(spark, d), ["seq"], "pos", "logits", "label_used")
    return out.select("n_tokens", R6(F.col("ce")).alias("ce"))


@register("e3_masked_ce", f"""
WITH {LOGITS_SQL}
SELECT round(sum(CASE WHEN label_used = -100 THEN 0 ELSE -(logits[label_used + 1] - lse.z) END * mask)
             / (sum(mask) + 1e-8), 6) AS ce
FROM lr JOIN lse USING (vec_id)""")
def q_e3(spark, d):
    return M.masked_ce(logit_rows(spark, d), "logits", "label_used", "mask").select(R6(F.col("ce")).alias("ce"))


LOGS = f"WITH {K.token_logs_cte()}"


@register("e4_seq_logp_sums", f"""{LOGS}
SELECT user_id, seq_no, round(sum(policy_logp * mask), 6) AS policy, round(sum(ref_logp * mask), 6) AS ref
FROM logs GROUP BY user_id, seq_no""")
def q_e4(spark, d):
    p = M.masked_seq_sums(D.token_logs(spark, d), ["user_id", "seq_no"], {"policy": "policy_logp", "ref": "ref_logp"}, "mask")
    return p.select("user_id", "seq_no", R6(F.col("policy")).alias("policy"), R6(F.col("ref")).alias("ref"))


PREFERENCE_SQL = f"""{LOGS},
s AS (SELECT user_id, seq_no // 2 AS pair_no, seq_no % 2 AS side, sum(policy_logp * mask) AS policy,
             sum(ref_logp * mask) AS ref FROM logs GROUP BY ALL),
z AS (SELECT c.user_id, c.pair_no, 0.15 * ((c.policy - r.policy) - (c.ref - r.ref)) AS z
      FROM s c LEFT JOIN s r ON c.user_id = r.user_id AND c.pair_no = r.pair_no AND r.side = 1 WHERE c.side = 0),
l AS (SELECT user_id, pair_no, ln(1 + exp(-z)) AS loss FROM z)"""


@register("e5_preference_loss", f"{PREFERENCE_SQL} SELECT user_id, pair_no, round(loss, 6) AS loss FROM l")
def q_e5(spark, d):
    return _pair_losses(spark, d).select("user_id", "pair_no", R6(F.col("loss")).alias("loss"))


@register("e5_preference_mean", f"""{PREFERENCE_SQL}
SELECT round(avg(loss), 6) AS loss, count(loss)::BIGINT AS n_pairs, count(*) FILTER (WHERE loss IS NULL)::BIGINT AS n_unpaired FROM l""")
def q_e5_mean(spark, d):
    m = M.preference_mean(_pair_losses(spark, d))
    return m.select(R6(F.col("loss")).alias("loss"), "n_pairs", "n_unpaired")


def _pair_losses(spark, d):
    lg = D.token_logs(spark, d).withColumn("pair_no", F.floor(F.col("seq_no") / 2).cast("bigint")) \
        .withColumn("side", (F.col("seq_no") % 2).cast("int"))
    s = M.masked_seq_sums(lg, ["user_id", "pair_no", "side"], {"policy": "policy_logp", "ref": "ref_logp"}, "mask")
    return M.preference_loss(s, ["user_id", "pair_no"], "side")


@register("e6_per_token_kl", f"""{LOGS}
SELECT event_id, round(exp(ref_logp - policy_logp) - (ref_logp - policy_logp) - 1, 6) AS kl FROM logs""")
def q_e6(spark, d):
    lg = D.token_logs(spark, d)
    return lg.select("event_id", R6(M.per_token_kl(F.col("ref_logp"), F.col("policy_logp"))).alias("kl"))


@register("e7_group_advantages", f"""{LOGS},
g AS (SELECT event_id, user_id, (rn - 1) // {D.GROUP_SIZE} AS grp, value / 100.0 AS reward FROM logs),
st AS (SELECT user_id, grp, count(*) AS n, avg(reward) AS m, stddev_pop(reward) AS sd FROM g GROUP BY ALL)
SELECT event_id, CASE WHEN n = {D.GROUP_SIZE} THEN round((reward - m) / (sd + 1e-4), 6) END AS advantage FROM g JOIN st USING (user_id, grp)""")
def q_e7(spark, d):
    """Events of an incomplete last group stay, without an advantage."""
    lg = D.token_logs(spark, d).select("event_id", "user_id", F.floor((F.col("rn") - 1) / D.GROUP_SIZE).alias("grp"),
                                       (F.col("value") / 100.0).alias("reward"))
    out = M.group_advantages(lg, ["user_id", "grp"], "reward", D.GROUP_SIZE, strict=False)
    return out.select("event_id", R6(F.col("advantage")).alias("advantage"))


def _adv_logs(spark, d):
    return D.token_logs(spark, d).withColumn("adv", (F.col("k") - 50) / 50.0)


def _seq_loss_sql(tok: str) -> str:
    return f"""{LOGS},
t AS (SELECT user_id, seq_no, mask, {tok} AS l FROM (SELECT *, (k - 50) / 50.0 AS adv,
        exp(policy_logp - old_logp) AS ratio, exp(ref_logp - policy_logp) - (ref_logp - policy_logp) - 1 AS kl FROM logs)),
s AS (SELECT user_id, seq_no, sum(l * mask) / greatest(sum(mask), 1) AS sl FROM t GROUP BY ALL)
SELECT round(avg(sl), 6) AS loss, count(*)::BIGINT AS n_seqs FROM s"""


@register("e8_grpo_loss", _seq_loss_sql("-(least(ratio * adv, least(greatest(ratio, 0.8), 1.2) * adv) - 0.1 * kl)"))
def q_e8(spark, d):
    out = M.grpo_loss(_adv_logs(spark, d), ["user_id", "seq_no"], "policy_logp", "old_logp", "ref_logp", "adv", "mask")
    return out.select(R6(F.col("loss")).alias("loss"), "n_seqs")


@register("e9_cispo_loss", _seq_loss_sql("-(least(ratio, 5.0) * adv * policy_logp - 0.1 * kl)"))
def q_e9(spark, d):
    out = M.cispo_loss(_adv_logs(spark, d), ["user_id", "seq_no"], "policy_logp", "old_logp", "ref_logp", "adv", "mask")
    return out.select(R6(F.col("loss")).alias("loss"), "n_seqs")


GAE_SQL = f"""{LOGS},
dl AS (SELECT user_id, seq_no, pos, event_id, mask, v_est,
         reward + 1.0 * coalesce(lead(v_est) OVER (PARTITION BY user_id, seq_no ORDER BY pos), 0.0) - v_est AS delta FROM logs),
adv AS (SELECT a.user_id, a.seq_no, a.pos, a.event_id, a.mask, a.v_est, sum(power(0.95, b.pos - a.pos) * b.delta) AS advantage
        FROM dl a JOIN dl b ON a.user_id = b.user_id AND a.seq_no = b.seq_no AND b.pos >= a.pos GROUP BY ALL)"""


def _gae(spark, d):
    lg = D.token_logs(spark, d)
    keys = ["user_id", "seq_no"]
    return M.gae(lg, keys, "pos", "reward", "v_est", 1.0, 0.95, carry=tuple(c for c in lg.columns if c not in keys))


@register("e10_gae", f"""{GAE_SQL}
SELECT event_id, round(advantage * 16777216) / 16777216 AS advantage FROM adv""")
def q_e10(spark, d):
    # binary-grid rounding: decimal ties are common here (two-decimal inputs times 0.95)
    return _gae(spark, d).select("event_id", (F.round(F.col("advantage") * 16777216) / 16777216).alias("advantage"))


NORM_SQL = f"""{GAE_SQL},
a1 AS (SELECT *, advantage * mask AS am FROM adv),
m AS (SELECT user_id, sum(am) / greatest(sum(mask), 1) AS mu FROM a1 GROUP BY user_id),
v AS (SELECT a1.user_id, sum(power(am - mu, 2) * mask) / greatest(sum(mask), 1) AS var FROM a1 JOIN m USING (user_id) GROUP BY a1.user_id),
nr AS (SELECT a1.*, CASE WHEN var > 1e-6 THEN (am - mu) / sqrt(var + 1e-8) * mask ELSE am END AS na
       FROM a1 JOIN m USING (user_id) JOIN v USING (user_id))"""


def _normed(spark, d):
    return M.normalise_advantages(_gae(spark, d), ["user_id"], "advantage", "mask", "v_est")


@register("e11_normalised_returns", f"""{NORM_SQL}
SELECT event_id, round(na, 6) AS norm_advantage, round(na + v_est, 6) AS returns FROM nr""")
def q_e11(spark, d):
    return _normed(spark, d).select("event_id", R6(F.col("norm_advantage")).alias("norm_advantage"),
                                    R6(F.col("returns")).alias("returns"))


@register("e12_ppo_policy_loss", f"""{NORM_SQL},
t AS (SELECT nr.user_id, nr.seq_no, nr.mask, exp(l.policy_logp - l.old_logp) AS ratio, nr.na FROM nr JOIN logs l USING (event_id)),
s AS (SELECT user_id, seq_no, sum(-least(ratio * na, least(greatest(ratio, 0.8), 1.2) * na) * mask) / greatest(sum(mask), 1) AS sl
      FROM t GROUP BY ALL)
SELECT round(avg(sl), 6) AS loss, count(*)::BIGINT AS n_seqs FROM s""")
def q_e12(spark, d):
    out = M.ppo_policy_loss(_normed(spark, d), ["user_id", "seq_no"], "policy_logp", "old_logp", "norm_advantage", "mask")
    return out.select(R6(F.col("loss")).alias("loss"), "n_seqs")


@register("e13_ppo_value_loss", f"""{NORM_SQL},
t AS (SELECT nr.user_id, nr.seq_no, nr.mask, l.v_est AS v, l.old_v AS vo, nr.na + nr.v_est AS r FROM nr JOIN logs l USING (event_id)),
s AS (SELECT user_id, seq_no, sum(0.5 * greatest(power(v - r, 2), power(least(greatest(v, vo - 0.2), vo + 0.2) - r, 2)) * mask)
             / greatest(sum(mask), 1) AS sl FROM t GROUP BY ALL)
SELECT round(avg(sl), 6) AS loss, count(*)::BIGINT AS n_seqs FROM s""")
def q_e13(spark, d):
    out = M.ppo_value_loss(_normed(spark, d), ["user_id", "seq_no"], "v_est", "old_v", "returns", "mask")
    return out.select(R6(F.col("loss")).alias("loss"), "n_seqs")


def _softmax_rows_sql(src: str, col: str, temp: float, name: str, cut: str | None = None) -> str:
    xs = f"{col}[1:{cut}]" if cut else col
    return f"""{name}_u AS (SELECT vec_id, i, x / {temp} AS x FROM (SELECT vec_id, unnest({xs}) AS x,
                 generate_subscripts({xs}, 1) AS i FROM {src})),
{name} AS (SELECT vec_id, i, x - (max(x) OVER w + ln(sum(exp(x - max(x) OVER w2)) OVER w)) AS lp
           FROM {name}_u WINDOW w AS (PARTITION BY vec_id), w2 AS (PARTITION BY vec_id))"""


def _lsm_sql(src: str, col: str, temp: float, name: str, cut: str | None = None) -> str:
    xs = f"{col}[1:{cut}]" if cut else col
    return f"""{name}_u AS (SELECT vec_id, unnest({xs}) / {temp} AS x, generate_subscripts({xs}, 1) AS i FROM {src}),
{name}_m AS (SELECT vec_id, i, x, max(x) OVER (PARTITION BY vec_id) AS m FROM {name}_u),
{name}_z AS (SELECT vec_id, any_value(m) + ln(sum(exp(x - m))) AS z FROM {name}_m GROUP BY vec_id),
{name} AS (SELECT vec_id, i, x - z AS lp FROM {name}_m JOIN {name}_z USING (vec_id))"""


TEACH_SQL = """pairs AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS s, CAST(b.embedding AS DOUBLE[]) AS t,
                 CASE WHEN a.label = 9 THEN -100 ELSE a.label END AS label_used,
                 CASE WHEN a.vec_id % 10 >= 2 THEN 1 ELSE 0 END AS mask
          FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


@register("e14_distillation_kl", f"""
WITH {TEACH_SQL}, {_lsm_sql('pairs', 's', 2.0, 'ls')}, {_lsm_sql('pairs', 't', 2.0, 'lt')}
SELECT round(4.0 * sum(exp(lt.lp) * (lt.lp - ls.lp)) / count(DISTINCT ls.vec_id), 6) AS distill,
       count(DISTINCT ls.vec_id)::BIGINT AS n_rows
FROM ls JOIN lt USING (vec_id, i)""")
def q_e14(spark, d):
    out = M.distillation_loss(with_teacher(spark, d), "logits", "teacher", 2.0)
    return out.select(R6(F.col("distill")).alias("distill"), "n_rows")


@register("e15_mixed_distillation", f"""
WITH {TEACH_SQL}, {_lsm_sql('pairs', 's', 1.0, 'ls', '48')},
kept AS (SELECT * FROM pairs WHERE mask = 1), {_lsm_sql('kept', 's', 1.0, 'ks', '48')}, {_lsm_sql('kept', 't', 1.0, 'kt', '48')},
ce AS (SELECT sum(CASE WHEN p.label_used = -100 THEN 0 ELSE -ls.lp END * p.mask) / (sum(p.mask) + 1e-8) AS ce
       FROM pairs p JOIN ls ON ls.vec_id = p.vec_id AND ls.i = CASE WHEN p.label_used = -100 THEN 1 ELSE p.label_used + 1 END),
di AS (SELECT sum(exp(kt.lp) * (kt.lp - ks.lp)) / count(DISTINCT ks.vec_id) AS distill FROM ks JOIN kt USING (vec_id, i))
SELECT round(ce, 6) AS ce, round(distill, 6) AS distill, round(0.5 * ce + 0.5 * distill, 6) AS loss FROM ce, di""")
def q_e15(spark, d):
    r = with_teacher(spark, d).withColumn("student", F.slice("logits", 1, 48))
    out = M.mixed_distillation_loss(r, "student", "teacher", "label_used", "mask", 0.5, 1.0)
    return out.select(R6(F.col("ce")).alias("ce"), R6(F.col("distill")).alias("distill"), R6(F.col("loss")).alias("loss"))


ROUTE_SQL = """g AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) - 1 AS expert FROM embeddings),
gm AS (SELECT vec_id, expert, exp(x - max(x) OVER (PARTITION BY vec_id)) AS ex FROM g),
sc AS (SELECT vec_id, expert, ex / sum(ex) OVER (PARTITION BY vec_id) AS s FROM gm),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, expert) - 1 AS slot FROM sc),
top AS (SELECT *, sum(s) OVER (PARTITION BY vec_id) AS tot FROM rk WHERE slot < 2)"""


@register("e16_expert_routing", f"""
WITH {ROUTE_SQL}
SELECT vec_id, slot::INT AS slot, expert::INT AS expert, round(s / (tot + 1e-20), 6) AS weight FROM top""")
def q_e16(spark, d):
    e = D.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("gate"))
    r = M.route_experts(e, ["vec_id"], "gate", 2)
    return r.select("vec_id", F.col("slot").cast("int").alias("slot"), "expert", R6(F.col("weight")).alias("weight"))


@register("e17_load_balance", f"""
WITH {ROUTE_SQL},
n AS (SELECT count(DISTINCT vec_id) AS n FROM sc),
pe AS (SELECT expert, sum(s) AS ss FROM sc GROUP BY expert),
ld AS (SELECT expert, count(*) AS nr FROM top GROUP BY expert)
SELECT round(sum(coalesce(nr, 0) / n * (ss / n)) * count(*) * 5e-4, 9) AS aux_loss FROM pe LEFT JOIN ld USING (expert), n""")
def q_e17(spark, d):
    e = D.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("gate"))
    r = M.route_experts(e, ["vec_id"], "gate", 2)
    return M.load_balance(r).select(F.round("aux_loss", 9).alias("aux_loss"))


@register("e17_loss_with_routing", f"""
WITH {ROUTE_SQL}, {LOGITS_SQL},
n AS (SELECT vec_id % 4 AS layer, count(DISTINCT vec_id) AS n FROM sc GROUP BY 1),
pe AS (SELECT vec_id % 4 AS layer, expert, sum(s) AS ss FROM sc GROUP BY ALL),
ld AS (SELECT vec_id % 4 AS layer, expert, count(*) AS nr FROM top GROUP BY ALL),
aux AS (SELECT layer, sum(coalesce(nr, 0) / n * (ss / n)) * count(*) * 5e-4 AS a FROM pe LEFT JOIN ld USING (layer, expert) JOIN n USING (layer) GROUP BY layer),
ce AS (SELECT count(*)::BIGINT AS n_tokens, avg(-(a.logits[b.label_used + 1] - lse.z)) AS ce
       FROM lr a JOIN lr b ON b.seq = a.seq AND b.pos = a.pos + 1 JOIN lse ON lse.vec_id = a.vec_id WHERE b.label_used <> -100)
SELECT n_tokens, round(ce, 6) AS ce, round((SELECT sum(a) FROM aux), 6) AS aux_loss, round(ce + (SELECT sum(a) FROM aux), 6) AS loss FROM ce""")
def q_e17_loss(spark, d):
    """Four layers' routing, by vec_id, added to the cross-entropy of E2."""
    e = D.table(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 4).alias("layer"), F.col("embedding").cast("array<double>").alias("gate"))
    aux = M.load_balance(M.route_experts(e, ["vec_id", "layer"], "gate", 2), ["layer"])
    out = M.loss_with_routing(M.next_token_ce(logit_rows(spark, d), ["seq"], "pos", "logits", "label_used"), aux)
    return out.select("n_tokens", R6(F.col("ce")).alias("ce"), R6(F.col("aux_loss")).alias("aux_loss"), R6(F.col("loss")).alias("loss"))


@register("e18_kl_early_stop", f"""{LOGS}
SELECT user_id, round(avg(old_logp - policy_logp) * 16777216) / 16777216 AS approx_kl,
       avg(old_logp - policy_logp) > 0.25 AS stop
FROM logs GROUP BY user_id""")
def q_e18(spark, d):
    # binary-grid rounding: averages of multiples of 0.05 hit exact decimal ties
    out = M.kl_early_stop(D.token_logs(spark, d), ["user_id"], "old_logp", "policy_logp")
    return out.select("user_id", (F.round(F.col("approx_kl") * 16777216) / 16777216).alias("approx_kl"), "stop")


# --- F: tool use -------------------------------------------------------------------

RESP = f"WITH {K.tool_responses_cte()}"
CALLS_SQL = f"""{RESP},
blk AS (SELECT conv_id, turn, unnest(regexp_extract_all(response, '(?s)```json\\s*(.*?)\\s*```', 1)) AS block,
               generate_subscripts(regexp_extract_all(response, '(?s)```json\\s*(.*?)\\s*```', 1), 1) - 1 AS call_no FROM resp),
-- DuckDB's parser lets a trailing comma pass; of repeated names the last one counts
calls AS (SELECT conv_id, turn, call_no, nullif(regexp_extract_all(block, '"name"\\s*:\\s*(null|"[^"]*")', 1)[-1], 'null') AS q,
                 trim(q, '"') AS name FROM blk
          WHERE CASE WHEN json_valid(block) AND NOT regexp_matches(block, ',\\s*[}}\\]]')
                     THEN json_type(block) = 'OBJECT' AND list_contains(json_keys(block), 'name') ELSE false END)"""


@register("f1_tool_calls", f"""{CALLS_SQL}
SELECT conv_id, turn, call_no::INT AS call_no, name FROM calls""")
def q_f1(spark, d):
    c = T.extract_calls(D.tool_responses(spark, d), "response", ["conv_id", "turn"])
    return c.select("conv_id", "turn", F.col("call_no").cast("int").alias("call_no"), "name")


@register("f2_catalogue_usage", lambda: f"""{CALLS_SQL},
cat AS (SELECT unnest({K.slist(T.TOOL_NAMES)}) AS name, unnest({[len(t['function']['parameters']['required']) for t in T.TOOLS]}) AS n_required)
SELECT cat.name, cat.n_required::INT AS n_required, count(c.name)::BIGINT AS n_calls
FROM cat LEFT JOIN calls c ON c.name = cat.name GROUP BY cat.name, cat.n_required""")
def q_f2(spark, d):
    cat = T.catalogue(spark)
    calls = T.extract_calls(D.tool_responses(spark, d), "response", ["conv_id", "turn"])
    used = calls.groupBy("name").agg(F.count(F.lit(1)).cast("bigint").alias("n_calls"))
    return (cat.join(used, "name", "left")
            .select("name", F.size("required").cast("int").alias("n_required"),
                    F.coalesce("n_calls", F.lit(0)).cast("bigint").alias("n_calls")))


WORD_SQL = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


@register("f8_rewards", lambda: f"""{CALLS_SQL},
valid AS (SELECT DISTINCT conv_id, turn FROM calls WHERE name IN {tuple(T.TOOL_NAMES)}),
nc AS (SELECT conv_id, turn, count(*) AS n_calls FROM calls GROUP BY ALL),
tk AS (SELECT conv_id, turn, regexp_extract_all(lower(response), {K.s(WORD_SQL)}) AS toks FROM resp),
gr AS (SELECT conv_id, turn, len(toks) - 2 AS n,
         len(list_distinct(list_transform(range(0, greatest(len(toks) - 2, 0)), lambda i: array_to_string(toks[i + 1:i + 3], chr(1))))) AS nd
       FROM tk),
base AS (SELECT r.conv_id, r.turn, coalesce(nc.n_calls, 0)::BIGINT AS n_calls, v.conv_id IS NOT NULL AS valid_tool,
    CASE WHEN length(regexp_replace(r.response, '^\\s+|\\s+$', '', 'g')) BETWEEN 20 AND 800 THEN 0.5 ELSE -0.5 END AS length_score,
    coalesce(r.gt <> '', false) AND contains(lower(r.response), regexp_replace(lower(r.gt), '^\\s+|\\s+$', '', 'g')) AS gt_hit,
    CASE WHEN gr.n > 0 THEN least(0.5, (gr.n - gr.nd) * 1.0 / gr.n) ELSE 0.0 END AS rep_penalty
  FROM resp r LEFT JOIN valid v USING (conv_id, turn) LEFT JOIN nc USING (conv_id, turn) JOIN gr USING (conv_id, turn))
SELECT conv_id, turn, n_calls, valid_tool, length_score, gt_hit, round(rep_penalty, 6) AS rep_penalty,
  round(length_score + CASE WHEN valid_tool THEN 1.0 ELSE 0.0 END + CASE WHEN gt_hit THEN 1.0 ELSE 0.0 END - rep_penalty, 6) AS reward
FROM base""")
def q_f8(spark, d):
    r = T.rewards(spark, D.tool_responses(spark, d), ["conv_id", "turn"])
    return r.select("conv_id", "turn", "n_calls", "valid_tool", "length_score", "gt_hit",
                    R6(F.col("rep_penalty")).alias("rep_penalty"), R6(F.col("reward")).alias("reward"))
