"""Streaming output equals batch output for row-local builders."""

from pyspark.sql import functions as F

from weft.operators import rows
from weft.operators import toolcalls as T
from weft.operators import vocab as V
from weft.streaming.rows_stream import file_stream, stream_per_batch, stream_rows


def test_stream_rows_equal_batch_rows(spark, tmp_path):
    src = tmp_path / "docs"
    data = [(i, f"document number {i} " * (i % 7 + 1)) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id INT, text STRING")
    for part in range(3):  # three arriving files
        df.where(F.col("doc_id") % 3 == part).coalesce(1).write.mode("append").parquet(str(src))

    def build(x):
        return rows.pretrain_rows(x, ["doc_id"], "text", V.BYTE_VOCAB, 48).select("doc_id", "input_ids", "labels")

    stream = file_stream(spark, str(src), df.schema, max_files_per_trigger=1)
    out = stream_rows(stream, build, "t1", str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = sorted((r["doc_id"], r["input_ids"], r["labels"]) for r in spark.read.parquet(out).collect())
    want = sorted((r["doc_id"], r["input_ids"], r["labels"]) for r in build(df).collect())
    assert got == want


def test_stream_per_batch_rewards(spark, tmp_path):
    src = tmp_path / "replies"
    data = [(i, 0, f"reply {i} ```json\n{{\"name\": \"get_current_time\"}}\n``` done", "reply") for i in range(20)]
    df = spark.createDataFrame(data, "conv_id INT, turn INT, response STRING, gt STRING")
    for part in range(2):
        df.where(F.col("conv_id") % 2 == part).coalesce(1).write.mode("append").parquet(str(src))
    stream = file_stream(spark, str(src), df.schema, max_files_per_trigger=1)
    out = stream_per_batch(stream, lambda b: T.rewards(spark, b, ["conv_id", "turn"]), "t2",
                           str(tmp_path / "out2"), str(tmp_path / "ckpt2"))
    got = sorted((r["conv_id"], r["reward"]) for r in spark.read.parquet(out).collect())
    want = sorted((r["conv_id"], r["reward"]) for r in T.rewards(spark, df, ["conv_id", "turn"]).collect())
    assert got == want and len(got) == 20


def test_file_stream_reads_a_table_of_one_file_or_many(spark, tmp_path):
    df = spark.range(20)
    df.repartition(3).write.parquet(str(tmp_path / "many" / "rows.parquet"))
    spark.range(100, 120).write.parquet(str(tmp_path / "many" / "other.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "written"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "written").glob("part-*.parquet")).rename(tmp_path / "one" / "rows.parquet")
    for kind in ("one", "many"):
        stream = file_stream(spark, str(tmp_path / kind), df.schema, max_files_per_trigger=1, table="rows.parquet")
        out = stream_rows(stream, lambda x: x, kind, str(tmp_path / f"out-{kind}"), str(tmp_path / f"ckpt-{kind}"))
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(20))


def test_registered_streams_read_folders_of_part_files(spark, tmp_path):
    from weft.plans.q_stream import q_s1, q_s2
    spark.createDataFrame([(i, f"text {i}", "en") for i in range(9)], "doc_id LONG, text STRING, lang STRING") \
        .repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0, "assistant", f"reply {i}") for i in range(9)], "conv_id LONG, turn INT, role STRING, text STRING") \
        .repartition(2).write.parquet(str(tmp_path / "conversations.parquet"))
    assert [(r["lang"], r["n_docs"]) for r in q_s1(spark, str(tmp_path)).collect()] == [("en", 9)]
    assert q_s2(spark, str(tmp_path)).count() == 9
