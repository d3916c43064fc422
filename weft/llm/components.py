"""Connected components of a links table by least labels and pointer jumping, in Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of the links; the component is its least node.

    A round takes each node's label down to the least of its neighbours' and then to its
    label's own label, so the rounds grow with the logarithm of a component's width. Each
    round is written to the shared folder, which cuts the lineage. Neighbours are only
    aggregated to their minimum (map-side combined), so a component of any size spreads over
    the tasks that its links spread over."""
    spark = links.sparkSession
    base = shared_path(spark, f"components-{uuid.uuid4().hex}")
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    one.union(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).write.parquet(f"{base}/links")
    both = spark.read.parquet(f"{base}/links")
    both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("component")).write.parquet(f"{base}/0")
    step, before = 0, None
    while True:
        now = spark.read.parquet(f"{base}/{step}")
        state = now.agg(F.sum(F.xxhash64("node", "component").cast("decimal(20,0)"))).first()[0]
        if state == before:
            return now
        low = (both.join(now, F.col("v") == F.col("node")).groupBy(F.col("u").alias("node"))
               .agg(F.min("component").alias("least")))
        low = now.join(low, "node").select("node", F.least("component", "least").alias("least"))
        jump = now.select(F.col("node").alias("least"), F.col("component").alias("next"))
        low.join(jump, "least").select("node", F.least("least", "next").alias("component")).write.parquet(f"{base}/{step + 1}")
        before, step = state, step + 1
