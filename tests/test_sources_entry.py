"""Sources on tiny JSONL fixtures, and the driver contract."""

import json

import pytest
from pyspark.sql import functions as F

from weft.sources import readers as R


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_jsonl_readers(spark, tmp_path):
    text = _write(tmp_path / "t.jsonl", [json.dumps({"text": t}) for t in ["a", "b", "c"]])
    assert R.read_text_jsonl(spark, text).count() == 3
    conv = [{"conversations": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo",
                                                                   "tool_calls": "[]"}]}]
    c = R.read_conversations_jsonl(spark, _write(tmp_path / "c.jsonl", [json.dumps(x) for x in conv]))
    row = c.first()["conversations"]
    assert row[0]["role"] == "user" and row[0]["tools"] is None and row[1]["tool_calls"] == "[]"
    pairs = [{"chosen": [{"role": "user", "content": "q"}], "rejected": [{"role": "user", "content": "r"}]}]
    assert R.read_pairs_jsonl(spark, _write(tmp_path / "p.jsonl", [json.dumps(x) for x in pairs])).count() == 1
    agent = _write(tmp_path / "a.jsonl", [json.dumps({"conversations": [], "gt": "42"})])
    assert R.read_agent_jsonl(spark, agent).first()["gt"] == "42"
    bad = _write(tmp_path / "bad.jsonl", ['{"conversations": [], "gt": "1"}', "{not json"])
    with pytest.raises(Exception):
        R.read_agent_jsonl(spark, bad).collect()
    assert R.sample_count(R.read_text_jsonl(spark, text)).first()["n_samples"] == 3


@pytest.mark.parametrize("read", [R.read_text_jsonl, R.read_conversations_jsonl, R.read_prompts_jsonl,
                                  R.read_pairs_jsonl, R.read_agent_jsonl])
def test_readers_refuse_a_bad_line(spark, tmp_path, read):
    bad = _write(tmp_path / "bad.jsonl", ["{}", '{"text": "cut off'])
    with pytest.raises(Exception):
        read(spark, bad).collect()


def test_assemble_and_shards(spark, tmp_path):
    turns = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", "c")],
                                  "conv_id INT, turn INT, role STRING, text STRING")
    m = {r["conv_id"]: [x["content"] for x in r["messages"]] for r in R.assemble_messages(turns).collect()}
    assert m == {1: ["a", "b"], 2: ["c"]}
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    R.write_shards(df, str(tmp_path / "s"), 4, ["id"])
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4
    m = {r["shard"]: r for r in R.read_manifest(spark, str(tmp_path / "s")).collect()}
    assert sum(r["n_rows"] for r in m.values()) == 100 and [m[k]["first_key"]["id"] for k in range(4)] == sorted(m[k]["first_key"]["id"] for k in range(4))
    assert [r["n_wrong"] for r in R.check_shards(spark, str(tmp_path / "s"), ["id"]).collect()] == [0] * 4
    # rows of unlike size: shards of like size, and a builder that runs once
    calls = spark.sparkContext.accumulator(0)
    grow = F.udf(lambda i: (calls.add(1), "x" * (1000 if i < 10 else 10))[1])
    R.write_shards(spark.range(210).withColumn("t", grow("id")), str(tmp_path / "u"), 3, ["id"], F.length("t"))
    sizes = {r["shard"]: r["n_bytes"] for r in R.read_manifest(spark, str(tmp_path / "u")).collect()}
    assert calls.value == 210 and sum(sizes.values()) == 12_000 and max(sizes.values()) <= 5000
    assert R.write_shards(spark.range(0), str(tmp_path / "e"), 3, ["id"]).count() == 0
    assert R.corpus(spark.createDataFrame([("x",), (None,)], "text STRING")).count() == 1


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() > 0 and "n_tokens" in out.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 80
    assert set(sql) <= set(qs)
    own = {q for q in qs if not q.startswith("op") and q != "pipeline"}
    assert own - set(sql) == {"b7_train_default", "b10_tokenize_default"}
