"""Skew-safe row numbering within a key (or globally).

``row_number() over (partition by k order by o)`` sends every row of a key to one
task, and without a key it sends the whole table to one task. Here the table is
range-partitioned on (key, order) instead, so a hot key is spread over many
partitions; each partition numbers its rows locally and a tiny table of
per-(partition, key) counts turns local numbers into global ones.

The range bounds come from sampling, and two separately planned exchanges can sample
different bounds, so the range-partitioned table is written once to the shared folder
and both the counts and the numbering are read from that one copy; it survives lost
executors and holds no cache.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path

#: Rows of one range; the number of ranges follows the data.
RANGE_ROWS = 5_000_000


def ordered_index(df: DataFrame, key_cols: list[str], order_cols: list[str],
                  out_col: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number per key in (order_cols) order. ``order_cols`` must make
    the order total (end with a unique column) for the numbering to be deterministic."""
    spark = df.sparkSession
    n = num_partitions or max(spark.sparkContext.defaultParallelism, df.count() // RANGE_ROWS + 1)
    sort_cols = [*key_cols, *order_cols]
    path = shared_path(spark, f"ordered-{uuid.uuid4().hex}")
    (df.repartitionByRange(n, *sort_cols)
     .sortWithinPartitions(*sort_cols)
     .withColumn("_pid", F.spark_partition_id())
     .withColumn("_mono", F.monotonically_increasing_id())
     .write.parquet(path))
    ranged = spark.read.parquet(path)
    stats = ranged.groupBy("_pid", *key_cols).agg(F.min("_mono").alias("_first"),
                                                   F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*key_cols).orderBy("_pid") if key_cols else Window.orderBy("_pid")
    stats = stats.withColumn("_offset", F.coalesce(
        F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = ranged.join(stats.select("_pid", *key_cols, "_first", "_offset"), ["_pid", *key_cols])
    return joined.withColumn(out_col, (F.col("_offset") + F.col("_mono") - F.col("_first") + 1)
                             .cast("bigint")).drop("_pid", "_mono", "_first", "_offset")
