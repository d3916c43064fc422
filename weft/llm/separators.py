"""10. Token counts by a separator scan of flat token files.

A flat file is little-endian 16-bit identifiers, one document after another, each closed by
the identifier ``SEPARATOR``; there is no index. Files are read whole by Spark's
``binaryFile`` source and cut into blocks of ``BLOCK`` identifiers, without regard to
documents. One vectorised pass per block finds the separators. A prefix scan over the
blocks' small summaries (identifiers, separators, last separator before the block) then
stitches the documents that cross blocks, and numbers them.

``write_flat`` makes such files from a text column: identifier = tokenizer id + 2, 0 pads,
1 separates; the separator's two bytes are the line separator of Spark's text sink, so the
files hold nothing else. Document ``k`` of file ``p`` is row ``k`` of input partition ``p``.

Defined results: null and empty texts have 0 tokens; identifiers after a file's last
separator are an unclosed document (``closed`` false); a file's odd last byte is ignored; an
empty file holds no document; repeated rows and null ids count row by row; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.session import shared_path

from . import subword

SEPARATOR, SHIFT, BLOCK = 1, 2, 1 << 20


def _flat(path: str | None):
    def run(batches):
        for b in batches:
            for lo, hi, ids, first in subword.encode_column(b.column("text"), path):
                raw = (ids + SHIFT).astype("<u2")
                at = (first * 2).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(raw.tobytes())])],
                    names=["value"])
    return run


def write_flat(docs: DataFrame, out: str, path: str | None = None) -> None:
    """One flat file per partition of docs under the folder ``out``."""
    rows = docs.select("text").mapInArrow(_flat(path), "value binary").select(F.col("value").cast("string"))
    rows.write.option("lineSep", "\x01\x00").option("compression", "none").text(out)


def _order(batches):
    n, p = 0, TaskContext.get().partitionId()
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.full(b.num_rows, p), pa.int32()), pa.array(np.arange(n, n + b.num_rows))],
            names=["doc_id", "file", "document"])
        n += b.num_rows


def order_of(docs: DataFrame) -> DataFrame:
    """(doc_id, file, document): where write_flat puts each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(_order, "doc_id long, file int, document long")


def _scan(separator: int, block: int):
    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content")):
                raw = np.frombuffer(content.as_buffer(), "<u2", count=len(content.as_buffer()) // 2)
                for k, lo in enumerate(range(0, len(raw), block)):
                    part = raw[lo:lo + block]
                    at = np.flatnonzero(part == separator)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()]), pa.array([k], pa.int64()), pa.array([len(part)], pa.int64()),
                         pa.array([at], pa.list_(pa.int64()))], names=["path", "block", "n", "at"])
    return run


def blocks(spark: SparkSession, folder: str, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """(path, block, n, at): every block's identifiers and the places of its separators."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(_scan(separator, block), "path string, block long, n long, at array<long>")


def documents(summaries: DataFrame) -> DataFrame:
    """(path, document, start, n_tokens, closed) of all documents, from the blocks' summaries."""
    # A file's blocks are one small row each; the scan below reads no identifier again.
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = summaries.select("path", "block", "n", "at", F.size("at").cast("long").alias("count"), F.max("block").over(
        Window.partitionBy("path")).alias("last"))
    rows = rows.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "number", F.coalesce(F.sum("count").over(before), F.lit(0)))
    rows = rows.withColumn("ends", F.transform("at", lambda x: x + F.col("base")))
    rows = rows.withColumn("carry", F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before) + 1, F.lit(0)))
    open_end = F.when((F.col("block") == F.col("last")) & (F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("carry")) < F.col("base") + F.col("n")),
                      F.array(F.col("base") + F.col("n"))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("stops", F.concat("ends", open_end)).withColumn(
        "starts", F.concat(F.array("carry"), F.transform("ends", lambda x: x + 1)))
    out = rows.select("path", "number", "count", "starts", F.posexplode("stops").alias("i", "stop"))
    start = F.element_at("starts", F.col("i") + 1)
    return out.select("path", (F.col("number") + F.col("i")).alias("document"), start.alias("start"),
                      (F.col("stop") - start).alias("n_tokens"), (F.col("i") < F.col("count")).alias("closed"))


def token_counts(docs: DataFrame, path: str | None = None, files: bool = False) -> DataFrame:
    """doc_id, n_tokens, file, document, start of every row: written flat, then scanned.

    The rows are read twice, for the texts and for the order of the ids. ``files`` says that docs
    reads files as they are, so both readings have one order; otherwise ids and texts are written
    to the shared folder first, since a shuffle may order other columns otherwise."""
    spark = docs.sparkSession
    folder = shared_path(spark, f"flat-{uuid.uuid4().hex}")
    if not files:
        docs.select("doc_id", "text").write.parquet(f"{folder}-rows")
        docs = spark.read.parquet(f"{folder}-rows")
    write_flat(docs, folder, path)
    found = documents(blocks(spark, folder)).withColumn(
        "file", F.regexp_extract("path", r"part-(\d+)", 1).cast("int"))
    rows = order_of(docs).join(found.drop("path"), ["file", "document"], "left")
    # a row without its document would mean that the partitions were read in another order
    n = F.coalesce("n_tokens", F.raise_error(F.lit("flat files and rows differ")).cast("long"))
    return rows.select("doc_id", n.alias("n_tokens"), "file", "document", "start")
