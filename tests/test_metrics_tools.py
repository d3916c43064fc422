"""Loss / advantage metrics, tool-call parsing and reward, candidate selection, statistics."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.operators import candidates as G
from weft.operators import metrics as M
from weft.operators import stats as H
from weft.operators import toolcalls as T
from weft.operators.ordering import ordered_index


def test_label_log_prob_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 100))
    labels = rng.integers(0, 100, 5)
    df = spark.createDataFrame([(i, x[i].tolist(), int(labels[i])) for i in range(5)], "i INT, l ARRAY<DOUBLE>, y INT")
    got = [r[0] for r in df.orderBy("i").select(M.label_log_prob(F.col("l"), F.col("y"))).collect()]
    ref = [x[i, labels[i]] - (x[i].max() + np.log(np.exp(x[i] - x[i].max()).sum())) for i in range(5)]
    assert got == pytest.approx(ref)


def test_preference_loss_hand_value(spark):
    # chosen: ref -1, policy -0.5; rejected: ref -1, policy -2
    s = spark.createDataFrame([(0, 0, -0.5, -1.0), (0, 1, -2.0, -1.0)], "pair INT, side INT, policy DOUBLE, ref DOUBLE")
    loss = M.preference_loss(s, ["pair"], "side", 0.15).first()["loss"]
    z = 0.15 * ((-0.5 + 2.0) - 0.0)
    assert loss == pytest.approx(math.log1p(math.exp(-z)))
    assert loss < math.log(2)


def test_group_advantages_zero_mean_and_size_check(spark):
    df = spark.createDataFrame([(g, r) for g, rs in enumerate([[1.0, 2.0, 3.0], [.5, 1.5, 2.5]]) for r in rs], "g INT, r DOUBLE")
    out = M.group_advantages(df, ["g"], "r", 3).collect()
    for g in (0, 1):
        assert sum(r["advantage"] for r in out if r["g"] == g) == pytest.approx(0.0, abs=1e-9)
    bad = spark.createDataFrame([(0, 3.0), (0, 1.0), (1, 0.5)], "g INT, r DOUBLE")
    with pytest.raises(Exception):
        M.group_advantages(bad, ["g"], "r", 2).collect()


def test_clipped_losses(spark):
    df = spark.createDataFrame([(0, 0, math.log(1.2), 0.0, 0.0, 1.0, 1), (1, 0, math.log(3.0), 0.0, math.log(3.0), 1.0, 1)],
                               "s INT, p INT, new DOUBLE, old DOUBLE, ref DOUBLE, adv DOUBLE, mask INT")
    g = M.grpo_loss(df, ["s"], "new", "old", "ref", "adv", "mask", beta=0.0).first()["loss"]
    assert g == pytest.approx(-(1.2 + 1.2) / 2)  # ratio 1.2 stays, 3.0 clipped to 1.2
    c = M.cispo_loss(df, ["s"], "new", "old", "ref", "adv", "mask", beta=0.0, epsilon_high=2.0).first()["loss"]
    assert c == pytest.approx(-(1.2 * math.log(1.2) + 2.0 * math.log(3.0)) / 2)


def test_gae_matches_backward_loop(spark):
    rng = np.random.default_rng(1)
    r, v = rng.normal(size=(4, 10)), rng.normal(size=(4, 10))
    rows = [(b, t, float(r[b, t]), float(v[b, t])) for b in range(4) for t in range(10)]
    df = spark.createDataFrame(rows, "b INT, t INT, r DOUBLE, v DOUBLE")
    got = {(x["b"], x["t"]): x["advantage"] for x in M.gae(df, ["b"], "t", "r", "v", 0.99, 0.95).collect()}
    for b in range(4):
        last = 0.0
        for t in reversed(range(10)):
            nv = v[b, t + 1] if t < 9 else 0.0
            last = r[b, t] + 0.99 * nv - v[b, t] + 0.99 * 0.95 * last
            assert got[(b, t)] == pytest.approx(last)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 18])
@pytest.mark.parametrize("gamma,lam", [(1.0, 0.95), (0.9, 0.0), (1.0, 1.0)])
def test_advantages_of_sequences_cut_into_pieces(spark, monkeypatch, piece, gamma, lam):
    monkeypatch.setattr(M, "GAE_PIECE", piece)
    rng = np.random.default_rng(piece)
    seqs = {("a", 0): 1, ("a", None): 9, (None, 3): 4, ("b", 0): 40, ("", 7): 2}
    rows, want = [], {}
    for (k, j), n in seqs.items():
        r, v, last = rng.normal(size=n), rng.normal(size=n), 0.0
        for t in reversed(range(n)):
            last = r[t] + gamma * (v[t + 1] if t + 1 < n else 0.0) - v[t] + gamma * lam * last
            want[k, j, t] = last
        rows += [(k, j, t, float(r[t]), float(v[t]), f"x{t}") for t in range(n)]
    df = spark.createDataFrame(rows, "k STRING, j INT, t INT, r DOUBLE, v DOUBLE, extra STRING").repartition(3)
    got = M.gae(df, ["k", "j"], "t", "r", "v", gamma, lam, carry=("t", "extra")).collect()
    assert {(x["k"], x["j"], x["t"]): pytest.approx(x["advantage"]) for x in got} == want
    assert all(x["extra"] == f"x{x['t']}" for x in got) and len(got) == len(rows)
    assert M.gae(df.limit(0), ["k", "j"], "t", "r", "v").count() == 0


def test_one_very_long_sequence(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit(1).alias("s"), F.col("id").alias("t"), (F.col("id") % 7 / 7).alias("r"), (F.col("id") % 5 / 5).alias("v"))
    got = M.gae(df, ["s"], "t", "r", "v", 1.0, 0.95)
    t = np.arange(n)
    r, v = t % 7 / 7, t % 5 / 5
    first, delta = 0.0, r + np.r_[v[1:], 0] - v
    for k in range(599, -1, -1):  # 0.95 ** 600 is below 1e-13
        first = delta[k] + 0.95 * first
    assert got.where("t = 0").first()["advantage"] == pytest.approx(first)
    assert got.count() == n


def test_penalty_top_p_and_draw_in_the_row(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=n).tolist(), s) for i, (n, s) in enumerate([(5, [0, 0, 4, 9, -1, None]), (1, []), (6400, list(range(0, 6400, 3))), (3, [1])])]
    df = spark.createDataFrame([*rows, (4, None, [1]), (5, [], [0])], "r INT, l ARRAY<DOUBLE>, seen ARRAY<INT>")
    got = {r["r"]: r["x"] for r in df.select("r", G.apply_repetition_penalty(F.col("l"), F.col("seen"), 1.3).alias("x")).collect()}
    for i, x, seen in rows:
        assert got[i] == pytest.approx([(y / 1.3 if y > 0 else y * 1.3) if k in seen else y for k, y in enumerate(x)])
    assert got[4] is None and got[5] == []
    probs = G.candidate_probs(df, "l", 0.8, 50)
    kept = probs.select("r", "probs", G.top_p_filter(F.col("probs"), 0.9).alias("kept")).withColumn("token", G.weighted_draw(F.col("kept"), F.col("r")))
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    for r in kept.collect():
        if not r["probs"]:
            assert not r["kept"] and r["token"] is None
            continue
        p = np.array(r["probs"])
        order = sorted(range(len(p)), key=lambda k: (-p[k], k))
        mass = np.cumsum(p[order])
        want = [k for n, k in enumerate(order) if p[k] > 0 and (n < 2 or mass[n - 2] < 0.9)]
        assert np.flatnonzero(r["kept"]).tolist() == sorted(want) and sum(r["kept"]) == pytest.approx(1)
        u = int(hashlib.md5(f"42:sample-draw:{r['r']}".encode()).hexdigest()[:8], 16) / 2**32
        assert r["token"] == next(k for k in sorted(want) if sum(r["kept"][:k + 1]) >= u)


def test_routing_loss_by_hand(spark):
    # two tokens, three experts, one slot: expert 0 has both; mean scores 0.5, 0.3, 0.2
    gates = [[math.log(x) for x in p] for p in ([0.6, 0.2, 0.2], [0.4, 0.4, 0.2])]
    df = spark.createDataFrame([(i, layer, g) for layer in (0, 1) for i, g in enumerate(gates)], "t INT, layer INT, g ARRAY<DOUBLE>")
    per = M.load_balance(M.route_experts(df, ["t", "layer"], "g", 1), ["layer"], 0.1)
    assert [r["aux_loss"] for r in per.collect()] == pytest.approx([1.0 * 0.5 * 3 * 0.1] * 2)
    out = M.loss_with_routing(spark.createDataFrame([(2.0,)], "ce DOUBLE"), per).first()
    assert (out["aux_loss"], out["loss"]) == (pytest.approx(0.3), pytest.approx(2.3))


def test_preference_mean_counts_unpaired(spark):
    s = spark.createDataFrame([(0, 0, -0.5, -1.0), (0, 1, -2.0, -1.0), (1, 0, -1.0, -1.0)], "pair INT, side INT, policy DOUBLE, ref DOUBLE")
    r = M.preference_mean(M.preference_loss(s, ["pair"], "side", 0.15)).first()
    assert (r["n_pairs"], r["n_unpaired"]) == (1, 1)
    assert r["loss"] == pytest.approx(math.log1p(math.exp(-0.15 * 1.5)))


def test_advantages_of_a_hot_batch_and_of_an_unmasked_one(spark):
    rows = [(0, float(i % 5), 1, 1.0) for i in range(500)] + [(1, 3.0, 0, 1.0)]
    df = spark.createDataFrame(rows, "b INT, a DOUBLE, m INT, v DOUBLE")
    out = M.normalise_advantages(df, ["b"], "a", "m", "v").collect()
    hot = [r["norm_advantage"] for r in out if r["b"] == 0]
    assert sum(hot) == pytest.approx(0, abs=1e-9) and max(hot) == pytest.approx(2 / math.sqrt(2 + 1e-8))
    assert [r["norm_advantage"] for r in out if r["b"] == 1] == [0.0]
    raw = M.normalise_advantages(df, ["b"], "a", "m", "v", raw_returns=True).where("b = 1").first()
    assert raw["returns"] == 4.0


def test_neighbours_in_blocks_match_numpy(spark):
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(300, 8)), rng.normal(size=(7, 8))
    x[5] = 0
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id LONG, v ARRAY<DOUBLE>").repartition(3)
    w = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "q LONG, v ARRAY<DOUBLE>")
    got = H.top_neighbours(v, w, "id", "v", "q", "v", 4).orderBy("query_id", "rank").collect()
    cos = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)).T
    cos[:, 5] = -9
    assert [r["vec_id"] for r in got] == np.argsort(-cos, axis=1)[:, :4].ravel().tolist()


def test_neighbours_prune_blocks_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(10, 12)) * 4, 60, axis=0) + rng.normal(size=(600, 12)) * 0.3
    x[100:140] = x[100]  # one vector many times: ties by id
    q = np.vstack([x[100], x[7], rng.normal(size=(3, 12)), np.zeros(12)])
    odd = [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (None, x[0].tolist()), (903, [None, *x[0].tolist()[1:]])]
    v = spark.createDataFrame([*((i, r.tolist()) for i, r in enumerate(x)), *odd], "id LONG, v ARRAY<DOUBLE>").repartition(3)
    w = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "id LONG, v ARRAY<DOUBLE>")
    cos = (q[:5] / np.linalg.norm(q[:5], axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
    for centres in (1 << 17, 7):
        monkeypatch.setattr(H, "CENTRES", centres)
        got = {}
        for r in H.top_neighbours(v, w, "id", "v", "id", "v", 5).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["cosine"]))
        assert sorted(got) == [0, 1, 2, 3, 4] and [i for i, _ in got[0]] == [100, 101, 102, 103, 104]
        for k, found in got.items():
            assert [c for _, c in found] == pytest.approx(sorted(cos[k], reverse=True)[:5])
    blocks = H.vector_blocks(v, "id", "v").persist()
    asked, every = H.block_pairs(blocks, w, 5).count(), blocks.count() * 5
    assert asked < 0.6 * every
    assert "CartesianProduct" not in H.top_neighbours(v, w, "id", "v", "id", "v", 5)._jdf.queryExecution().executedPlan().toString()


def test_explained_variance_equals_eigenvalues(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 6)) * [5, 4, 2, 1, 0.5, 0.1] @ np.linalg.qr(rng.normal(size=(6, 6)))[0] + 3
    df = spark.createDataFrame([*((r.tolist(),) for r in x), (None,), ([None] + [1.0] * 5,)], "v ARRAY<DOUBLE>").repartition(3)
    got = [r["ratio"] for r in H.explained_variance(H.moments(df, "v"), 4, 200).orderBy("component").collect()]
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert got == pytest.approx((values / values.sum())[:4].tolist(), rel=1e-6)


def test_kl_and_distillation_zero_when_equal(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], -0.3, -0.3)], "s ARRAY<DOUBLE>, t ARRAY<DOUBLE>, a DOUBLE, b DOUBLE")
    assert df.select(M.per_token_kl(F.col("a"), F.col("b"))).first()[0] == pytest.approx(0.0)
    assert M.distillation_loss(df, "s", "t", 2.0).first()["distill"] == pytest.approx(0.0, abs=1e-12)
    peaked = spark.createDataFrame([([10.0, 0.0, 0.0], [0.0, 0.0, 10.0])], "s ARRAY<DOUBLE>, t ARRAY<DOUBLE>")
    assert M.distillation_loss(peaked, "s", "t").first()["distill"] > 1.0


def test_value_loss_and_routing(spark):
    df = spark.createDataFrame([(0, 1.0, 0.5, 0.0, 1)], "s INT, v DOUBLE, vo DOUBLE, r DOUBLE, m INT")
    assert M.ppo_value_loss(df, ["s"], "v", "vo", "r", "m").first()["loss"] == pytest.approx(0.5 * 1.0)
    g = spark.createDataFrame([(0, [1.0, 3.0, 2.0, 0.0])], "t INT, gate ARRAY<DOUBLE>")
    routed = M.route_experts(g, ["t"], "gate", 2).orderBy("slot").collect()
    assert [r["expert"] for r in routed] == [1, 2]
    assert sum(r["weight"] for r in routed) == pytest.approx(1.0)


CASES = [
    (0, 'x ```json\n{"name": "get_current_weather", "arguments": {"location": "上海"}}\n``` y'),
    (1, '```json {"name": "a"} ``` and ```json\n{"name": "get_exchange_rate", "arguments": {"from_currency": "EUR", "to_currency": "CNY"}}\n```'),
    (2, "no calls here"),
    (3, '```json\n{"name": "x", "arguments": {\n```'),
    (4, '```json\n{"arguments": {}}\n```'),
    (5, '```json\n{"name": null}\n```'),
    (6, "```json\n{'name': 'get_current_time'}\n```"),
    (7, '```json\n{"name": "get_current_time"} trailing\n```'),
    (8, '```json\n{"name": "get_current_time"} {\n```'),
    (9, '```json\n{"name": "get_current_time",}\n```'),
    (10, '```json\n{"name": "x", "name": "get_current_time"}\n```'),
    (11, '```json\n{"name": "get_current_time", "v": NaN}\n```'),
    (12, '```json\n' + "[" * 100_000 + '\n```'),
    (13, None),
]


def test_extract_calls_by_strict_json(spark):
    df = spark.createDataFrame(CASES, "k INT, response STRING")
    got = sorted(((r["k"], r["call_no"], r["name"]) for r in T.extract_calls(df, "response", ["k"]).collect()), key=str)
    assert got == sorted([(0, 0, "get_current_weather"), (1, 0, "a"), (1, 1, "get_exchange_rate"), (5, 0, None),
                          (10, 0, "get_current_time"), (11, 0, "get_current_time")], key=str)


# reply, answer, calls found, names a known tool, reward; all worked out by hand:
# +-0.5 for the length, +1 for a known tool, +1 for the answer, minus the share of repeated 3-grams (0.5 at
# most; the three back-quotes of a fence repeat once)
REWARDS = [
    ('x ```json\n{"name": "get_current_weather"}\n``` y', None, 1, True, 1.5 - 1 / 16),
    ("```json\n{'name': 'get_current_weather'}\n```", None, 0, False, 0.5 - 1 / 14),
    ('```json\n{"name": "get_current_weather"} trailing\n```', "TRAILING", 0, False, 1.5 - 1 / 15),
    ('```json\n{"name": "get_current_weather"} {\n```', None, 0, False, 0.5 - 1 / 15),
    ('```json\n{"name": "x", "name": "get_current_time"}\n```', None, 1, True, 1.5 - 4 / 22),
    ('```json\n{"name": "get_current_time", "name": "x"}\n```', None, 1, False, 0.5 - 4 / 22),
    ('```json\n{"name": "get_current_time", "v": NaN}\n```', "", 1, True, 1.5 - 1 / 20),
    ("short", None, 0, False, -0.5),
    ("short", "SHORT ", 0, False, 0.5),
    ("short", "  ", 0, False, 0.5),
    ("one two three four five six", "seven", 0, False, 0.5),
    ("the cat the cat the cat the cat", "cat", 0, False, 1.0),          # 6 three-grams, 2 distinct: 4/6, capped at 0.5
    ("aa bb cc dd aa bb cc ee ff gg", None, 0, False, 0.5 - 1 / 8),     # 8 three-grams, one repeated
    ("z" * 801, None, 0, False, -0.5),
]


def test_rewards_hand_values(spark):
    df = spark.createDataFrame([(i, r, g) for i, (r, g, *_) in enumerate(REWARDS)], "k INT, response STRING, gt STRING")
    got = {r["k"]: r for r in T.rewards(spark, df, ["k"]).collect()}
    for i, (reply, gt, n, valid, reward) in enumerate(REWARDS):
        r = got[i]
        assert (r["n_calls"], r["valid_tool"]) == (n, valid), reply
        assert r["reward"] == pytest.approx(reward), reply


def test_top_k_ties_and_top_p_width(spark):
    df = spark.createDataFrame([(0, [5.0, 5.0, 5.0, 4.0])], "r INT, l ARRAY<DOUBLE>")
    c = G.candidate_table(df, ["r"], "l", top_k=2)
    assert c.where("prob > 0").count() == 3
    probs = [math.log(p) for p in (0.5, 0.3, 0.15, 0.05)]
    d2 = spark.createDataFrame([(0, probs)], "r INT, l ARRAY<DOUBLE>")
    cand = G.candidate_probs(d2, "l")
    wide, narrow = (cand.select(G.top_p_filter(F.col("probs"), 0.5, strict)).first()[0] for strict in (False, True))
    assert wide == pytest.approx([0.625, 0.375, 0, 0]) and narrow == [1.0, 0, 0, 0]
    assert df.select(G.greedy(F.col("l"))).first()[0] == 0


def test_durations_and_entropy(spark):
    df = spark.createDataFrame([(45.0,), (125.0,), (3780.0,), (0.0,), (59.6,)], "s DOUBLE")
    assert [r[0] for r in df.select(H.duration_label(F.col("s"))).collect()] == ["45s", "2m05s", "1h03m", "0s", "60s"]
    uni = spark.createDataFrame([(0, i) for i in range(8)], "g INT, x INT")
    dist = H.distribution(uni, ["g"], "x").withColumn("p", F.col("count") / F.col("_tot"))
    assert H.entropy(dist, ["g"]).first()["entropy_bit"] == pytest.approx(3.0)


def test_ordered_index_on_a_hot_key(spark):
    rows = [(0 if i % 3 else 1, i) for i in range(3000)]  # key 0 holds two thirds of the rows
    df = spark.createDataFrame(rows, "k INT, t INT")
    got = ordered_index(df, ["k"], ["t"], "rn", num_partitions=8).collect()
    by_key = {}
    for r in sorted(got, key=lambda r: (r["k"], r["t"])):
        by_key.setdefault(r["k"], []).append(r["rn"])
    for k, rns in by_key.items():
        assert rns == list(range(1, len(rns) + 1))
    assert len(got) == 3000
