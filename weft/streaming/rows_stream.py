"""Training rows from a stream of arriving files (Structured Streaming).

The row builders are row-local (each output row depends on one input row), so they
run unchanged on a streaming DataFrame: no watermark and no state are needed. Two
ways to run them:

* ``stream_rows``: the builder's column expressions are applied to the stream itself
  and written with the exactly-once file sink;
* ``stream_per_batch``: for builders that group by the row key inside the batch (tool
  reward, which explodes calls and regroups them per reply), each micro-batch runs the
  batch builder and overwrites its own ``batch_id=`` folder, so a retried batch
  replaces its output instead of duplicating it.

Checkpoint and output folders default to the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path


def file_stream(spark: SparkSession, folder: str, schema, file_glob: str | None = None,
                max_files_per_trigger: int | None = None, table: str | None = None) -> DataFrame:
    """Files arriving in a folder; with ``table``, of that name in the folder, be it one file or a
    folder of part files. A streaming source takes a single file only by a pattern, so the name's
    last letter is written as one."""
    reader = spark.readStream.schema(schema).format("parquet")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder if table is None else f"{folder.rstrip('/')}/{table[:-1]}[{table[-1]}]")


def stream_rows(stream: DataFrame, builder: Callable[[DataFrame], DataFrame], name: str,
                out_path: str | None = None, checkpoint: str | None = None) -> str:
    """Apply a row-local builder to a stream; run until the available input is done."""
    spark = stream.sparkSession
    out_path = out_path or shared_path(spark, f"stream-out/{name}")
    checkpoint = checkpoint or shared_path(spark, f"stream-ckpt/{name}")
    q = (builder(stream).writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out_path


def stream_per_batch(stream: DataFrame, builder: Callable[[DataFrame], DataFrame], name: str,
                     out_path: str | None = None, checkpoint: str | None = None) -> str:
    """Run a batch builder on every micro-batch; output is idempotent per batch id."""
    spark = stream.sparkSession
    out_path = out_path or shared_path(spark, f"stream-out/{name}")
    checkpoint = checkpoint or shared_path(spark, f"stream-ckpt/{name}")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        builder(batch).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out_path
