"""Registered queries that run the row builders as streams (file source, availableNow)
and read the sink back; their oracles are the batch queries' oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import rows
from ..operators import toolcalls as T
from ..operators import vocab as V
from ..session import shared_path
from ..streaming.rows_stream import file_stream, stream_per_batch, stream_rows
from . import derived as D
from . import q_metrics
from .registry import ORACLES, register


def _schema(spark, d, table):
    return D.table(spark, d, table).schema


@register("s1_stream_pretrain_rows", lambda: ORACLES["d1_pretrain_rows"]())
def q_s1(spark, d):
    src = file_stream(spark, d, _schema(spark, d, "documents"), max_files_per_trigger=1, table="documents.parquet")
    src = src.repartition(2 * spark.sparkContext.defaultParallelism)  # a file of long texts is one task otherwise

    def build(df):
        r = rows.pretrain_rows(df.select("doc_id", "lang", "text"), ["doc_id"], "text", V.BYTE_VOCAB, 512)
        return r.select("doc_id", "lang", "n_raw_tokens", "input_ids", "labels")

    run = uuid.uuid4().hex[:12]
    out = stream_rows(src, build, f"s1-{run}", shared_path(spark, f"stream-out/s1-{run}"),
                      shared_path(spark, f"stream-ckpt/s1-{run}"))
    back = spark.read.parquet(out)
    body = 510
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum(F.least("n_raw_tokens", F.lit(body)) + 2).cast("bigint").alias("n_tokens"),
        F.sum(F.size(F.filter("labels", lambda x: x != -100))).cast("bigint").alias("n_label_tokens"),
        F.sum(F.when(F.col("n_raw_tokens") > body, 1).otherwise(0)).cast("bigint").alias("n_truncated"),
        F.sum(F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)).cast("bigint").alias("id_sum"),
        F.sum(F.aggregate("labels", F.lit(0).cast("bigint"), lambda a, x: a + F.when(x != -100, x).otherwise(0)))
        .cast("bigint").alias("label_sum"))


@register("s2_stream_tool_rewards", lambda: ORACLES["f8_rewards"]())
def q_s2(spark, d):
    src = file_stream(spark, d, _schema(spark, d, "conversations"), max_files_per_trigger=1, table="conversations.parquet")
    blocks = F.array(*[F.lit(b) for b in D.TOOL_BLOCKS])
    replies = src.where(F.col("role") == "assistant").select(
        "conv_id", "turn",
        F.concat(F.col("text"), F.lit("\n"), F.element_at(blocks, (F.col("conv_id") % len(D.TOOL_BLOCKS) + 1).cast("int")))
        .alias("response"),
        F.when(F.col("conv_id") % 4 == 0, F.split_part(F.col("text"), F.lit(" "), F.lit(1)))
        .when(F.col("conv_id") % 4 == 1, F.lit("  ")).when(F.col("conv_id") % 4 == 2, F.lit("zzqx"))
        .otherwise(F.lit(None).cast("string")).alias("gt"))
    run = uuid.uuid4().hex[:12]
    out = stream_per_batch(replies, lambda b: T.rewards(spark, b, ["conv_id", "turn"]), f"s2-{run}",
                           shared_path(spark, f"stream-out/s2-{run}"), shared_path(spark, f"stream-ckpt/s2-{run}"))
    r = spark.read.parquet(out)
    R6 = q_metrics.R6
    return r.select("conv_id", "turn", "n_calls", "valid_tool", "length_score", "gt_hit",
                    R6(F.col("rep_penalty")).alias("rep_penalty"), R6(F.col("reward")).alias("reward"))

