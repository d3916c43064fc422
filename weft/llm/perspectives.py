"""6. Chat formatting by multi-party perspective rotation, in DataFrame operations only.

Every speaker of a conversation but ``system`` is a participant; for each one the whole
dialogue is rendered with its own turns as ``assistant``, the others' as ``user name=...``,
system turns as they are. The result has one row per conversation, participant and turn:
the segment, where it starts in that rendering, and the character span to train on (the own
turns' text and closing marker). Segments in order of ``turn_index`` are the rendering;
``whole`` joins them where a dialogue fits in a row.

A conversation may hold a large part of all rows, so turns are dealt by range of
(conversation, order) and written once; starts are summed within a range and then carried
over a small table of one row per conversation, participant and range.

Defined results: a null or blank role is the speaker ``unknown``; a null text is empty; rows
of null conv_id are one conversation; turns go by turn (null first), then speaker, then md5
of the text; repeated rows are repeated turns; white space in a speaker's name becomes
``_``; markers inside a text are broken up (``<|im_`` becomes ``<| im_``); a conversation of
system turns alone has no participant and gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.session import shared_path

START, STOP = "<|im_start|>", "<|im_end|>"
RANGE_CHARS = 32 << 20


def _turns(conversations: DataFrame) -> DataFrame:
    name = F.regexp_replace(F.trim(F.coalesce("role", F.lit(""))), r"[ \t\n\x0B\f\r]+", "_")
    text = F.coalesce("text", F.lit(""))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(name == "", "unknown").otherwise(name).alias("speaker"),
        F.replace(text, F.lit("<|im_"), F.lit("<| im_")).alias("body"), F.md5(text).alias("digest"))


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, participant, turn_index, speaker, is_target, segment, seg_start, seg_length, mask_start, mask_end."""
    spark = conversations.sparkSession
    turns = _turns(conversations)
    size = turns.agg(F.sum(F.length("body") + 64)).first()[0] or 0
    ranges = max(int(size // RANGE_CHARS) + 1, spark.sparkContext.defaultParallelism)
    path = shared_path(spark, f"turns-{uuid.uuid4().hex}")
    # equal rows are told apart, so that a turn repeated without end spreads over ranges too
    (turns.withColumn("copy", F.monotonically_increasing_id())
     .repartitionByRange(ranges, "conv_id", "turn", "speaker", "digest", "copy")
     .withColumn("range", F.spark_partition_id()).write.parquet(path))
    turns = spark.read.parquet(path).withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    people = turns.where("speaker <> 'system'").select("conv", F.col("speaker").alias("participant")).distinct()
    rows = turns.join(people, "conv")
    own = F.col("speaker") == F.col("participant")
    label = (F.when(F.col("speaker") == "system", "system").when(own, "assistant")
             .otherwise(F.concat(F.lit("user name="), "speaker")))
    rows = rows.withColumn("is_target", own).withColumn("head", F.concat(F.lit(START), label, F.lit("\n"))).withColumn(
        "segment", F.concat("head", "body", F.lit(STOP + "\n")))
    rows = rows.withColumn("n", F.length("segment").cast("long"))
    key = ["conv", "participant", "range"]
    inside = Window.partitionBy(*key).orderBy("turn", "speaker", "digest", "copy")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("i", F.row_number().over(inside) - 1).withColumn(
        "s", F.coalesce(F.sum("n").over(before), F.lit(0)))
    earlier = Window.partitionBy("conv", "participant").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.join(people, "conv").select("conv", "participant", "range", F.lit(1).alias("one"), _length().alias("n"))
    sums = sums.groupBy(*key).agg(F.sum("one").alias("count"), F.sum("n").alias("chars"))
    carry = sums.select(*key, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("count"),
                        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars"))
    rows = rows.join(carry, key)
    start = F.col("s") + F.col("chars")
    mask = start + F.length("head")
    return rows.select(
        "conv_id", "participant", (F.col("i") + F.col("count")).cast("long").alias("turn_index"), "speaker", "is_target", "segment",
        start.alias("seg_start"), F.col("n").alias("seg_length"), F.when(F.col("is_target"), mask).alias("mask_start"),
        F.when(F.col("is_target"), mask + F.length("body") + len(STOP)).alias("mask_end"))


def _length():
    """Length of a segment, from its turn and participant."""
    label = (F.when(F.col("speaker") == "system", 6).when(F.col("speaker") == F.col("participant"), 9)
             .otherwise(F.length("speaker") + 10))
    return (label + F.length("body") + len(START) + len(STOP) + 2).cast("long")


def whole(segments: DataFrame) -> DataFrame:
    """(conv_id, participant, rendering, spans): for dialogues that fit in one row each."""
    rows = segments.groupBy("conv_id", "participant").agg(
        F.array_sort(F.collect_list(F.struct("turn_index", "segment", "mask_start", "mask_end"))).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x.mask_start.isNotNull()), lambda x: F.struct(x.mask_start, x.mask_end))
    return rows.select("conv_id", "participant", F.array_join("t.segment", "").alias("rendering"), spans.alias("spans"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, md5(coalesce(text, '')) AS digest, replace(coalesce(text, ''), '<|im_', '<| im_') AS body,
         CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown'
              ELSE regexp_replace(trim(coalesce(role, '')), '[ \t\n\x0B\f\r]+', '_', 'g') END AS speaker
  FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.*, p.participant, t.speaker = p.participant AS is_target,
         '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.participant THEN 'assistant'
                                ELSE 'user name=' || t.speaker END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS segment FROM r),
w AS (
  SELECT *, row_number() OVER o - 1 AS turn_index,
         coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, digest
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg_start
  FROM s WINDOW o AS (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, digest))
SELECT conv_id, participant, CAST(turn_index AS BIGINT) AS turn_index, speaker, is_target, segment,
       CAST(seg_start AS BIGINT) AS seg_start, CAST(length(segment) AS BIGINT) AS seg_length,
       CASE WHEN is_target THEN CAST(seg_start + length(head) AS BIGINT) END AS mask_start,
       CASE WHEN is_target THEN CAST(seg_start + length(head) + length(body) + 10 AS BIGINT) END AS mask_end
FROM w
"""
