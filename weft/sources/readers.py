"""Sources and sinks (A1-A10): declared-schema JSONL readers, table loading,
conversation assembly and sharded output."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path, ship

MESSAGE = "STRUCT<role: STRING, content: STRING, reasoning_content: STRING, tools: STRING, tool_calls: STRING>"
SIMPLE_MESSAGE = "STRUCT<role: STRING, content: STRING>"
TEXT_SCHEMA = "text STRING"
CONVERSATION_SCHEMA = f"conversations ARRAY<{MESSAGE}>"
PAIR_SCHEMA = f"chosen ARRAY<{SIMPLE_MESSAGE}>, rejected ARRAY<{SIMPLE_MESSAGE}>"
PROMPT_SCHEMA = f"conversations ARRAY<{SIMPLE_MESSAGE}>"
AGENT_SCHEMA = f"conversations ARRAY<{MESSAGE}>, gt STRING"


def _strict_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A malformed line fails the read. Unlike the reference, a blank line is skipped."""
    return spark.read.option("mode", "FAILFAST").schema(schema).json(path)


def read_text_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A1: ``{"text": ...}`` per line."""
    return _strict_jsonl(spark, path, TEXT_SCHEMA)


def read_conversations_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A2: conversations with the five-field message schema; absent fields are NULL."""
    return _strict_jsonl(spark, path, CONVERSATION_SCHEMA)


def read_prompts_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A4: RL prompts, conversations of (role, content)."""
    return _strict_jsonl(spark, path, PROMPT_SCHEMA)


def read_pairs_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A3: preference pairs."""
    return _strict_jsonl(spark, path, PAIR_SCHEMA)


def read_agent_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A5: tool-use samples."""
    return _strict_jsonl(spark, path, AGENT_SCHEMA)


def sample_count(df: DataFrame) -> DataFrame:
    """Number of samples, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_samples"))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows of long texts over all cores where the scan has no more tasks than cores: a file of
    one row group is read by one task, however many splits it has. Larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() <= cores else df


def corpus(df: DataFrame, text_col: str = "text", fraction: float | None = None,
           seed: int = 42) -> DataFrame:
    """The text column feeding vocabulary training, optionally Bernoulli-sampled."""
    out = df.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    return out.sample(fraction=fraction, seed=seed) if fraction is not None else out


def assemble_messages(turns: DataFrame, key_col: str = "conv_id", order_col: str = "turn",
                      role_col: str = "role", content_col: str = "text") -> DataFrame:
    """A10: flat turn rows -> one message array per conversation, in turn order
    (one shuffle by conversation key)."""
    msg = F.struct(F.col(order_col).alias("o"), F.col(role_col).alias("role"),
                   F.col(content_col).alias("content"))
    grouped = turns.groupBy(key_col).agg(F.array_sort(F.collect_list(msg)).alias("_m"))
    return grouped.select(key_col, F.transform("_m", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"),
        F.lit(None).cast("string").alias("reasoning_content"),
        F.lit(None).cast("string").alias("tools"),
        F.lit(None).cast("string").alias("tool_calls"))).alias("messages"))


def write_shards(df: DataFrame, path: str, n_shards: int, order_cols: list[str], size: Column | None = None) -> DataFrame:
    """Finished rows in key order, cut into about ``n_shards`` shards of like size (``size`` is
    a row's bytes; by default the length of its JSON), one folder per shard. Returns the manifest,
    written to ``path/_manifest``: shard, n_rows, n_bytes, first_key, last_key.

    The rows are built and written once; ranging samples the written rows. The cuts come from the
    prefix sum of bytes: within a range as it is written, from range to range by a table of
    one row per range. A row longer than a shard makes the next shard begin later, never splits."""
    spark = df.sparkSession
    ship(spark)
    stage = shared_path(spark, f"shards-{uuid.uuid4().hex}")
    rows = df.withColumn("_size", (F.octet_length(F.to_json(F.struct("*"))) if size is None else size).cast("long"))
    rows.write.parquet(stage + "/rows")
    rows = spark.read.parquet(stage + "/rows")
    parts = max(n_shards, spark.sparkContext.defaultParallelism)
    ranged = rows.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)

    def run(batches):
        at, part = 0, TaskContext.get().partitionId()
        for b in batches:
            sizes = b.column("_size").to_numpy(zero_copy_only=False)
            start = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield b.append_column("_part", pa.array(np.full(b.num_rows, part, np.int32))).append_column("_start", pa.array(start))
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_start", T.LongType())])
    ranged.mapInArrow(run, schema).write.parquet(stage + "/ranged")
    ranged = spark.read.parquet(stage + "/ranged")
    ends = ranged.groupBy("_part").agg(F.max(F.col("_start") + F.col("_size")).alias("n")).orderBy("_part").collect()  # a row per range
    before, total = {}, 0
    for r in ends:
        before[r["_part"]], total = total, total + r["n"]
    each = max(1, -(-total // max(1, n_shards)))
    offsets = spark.createDataFrame(list(before.items()), "_part INT, _before LONG")
    cut = (ranged.join(F.broadcast(offsets), "_part").withColumn("shard", F.floor((F.col("_before") + F.col("_start")) / each).cast("int")))
    cut.drop("_part", "_before", "_start", "_size").write.partitionBy("shard").parquet(path)
    key = F.struct(*order_cols)
    manifest = cut.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_size").alias("n_bytes"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    manifest.coalesce(1).write.parquet(path.rstrip("/") + "/_manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path.rstrip("/") + "/_manifest")


def check_shards(spark: SparkSession, path: str, order_cols: list[str]) -> DataFrame:
    """(shard, n_wrong): how the shards differ from their manifest in rows, first or last key, plus one
    where a shard begins at or before the end of the one before it."""
    key = F.struct(*order_cols)
    found = spark.read.parquet(path).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    both = read_manifest(spark, path).join(found, "shard", "full_outer")
    wrong = sum((F.when(F.col(a).eqNullSafe(F.col(b)), 0).otherwise(1) for a, b in (("n_rows", "n"), ("first_key", "lo"), ("last_key", "hi"))), F.lit(0))
    late = F.lag("hi").over(Window.orderBy("shard")) > F.col("lo")  # one row per shard
    return both.select("shard", (wrong + F.coalesce(late.cast("int"), F.lit(0))).cast("bigint").alias("n_wrong"))
