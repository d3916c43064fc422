"""Blocks of documents that ask a sharded table and get its answers back.

Documents are dealt into blocks of about ``BLOCK_BYTES`` of text. A block asks only for
its distinct keys (n-grams, words), the keys meet the sharded table in a shuffle join, and
the answers return to the block, where its texts are scored. So neither the table nor the
corpus passes through one place, and a key costs one row per block, not one per occurrence.
Texts travel once, as zstd-compressed Arrow batches.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 8192


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """(block int, blob binary) rows holding all rows of docs, and the number of blocks, which follows
    both bytes and rows.

    Rows are dealt by a hash of id, text and the row's place in its partition: copies spread, also
    rows that are repeated in full. docs is to be a scan of files, which gives every row the same
    place again when a task is retried."""
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = max(int((size or 0) // block_bytes), rows // block_rows) + 1
    dealt = docs.withColumn("__block", F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(n)).cast("int"))

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in batches:
            rows = pa.Table.from_batches([b])
            rows = rows.take(pa.compute.sort_indices(rows.column("__block")))
            key = rows.column("__block").to_numpy()
            rows = rows.drop_columns("__block")
            edge = [0, *(key[1:] != key[:-1]).nonzero()[0] + 1, len(key)]
            for lo, hi in zip(edge, edge[1:]):
                if hi > lo:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema, options=options) as w:
                        w.write_table(rows.slice(lo, hi - lo).combine_chunks())
                    yield pa.RecordBatch.from_arrays([pa.array([key[lo]], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                     names=["block", "blob"])
    return dealt.mapInArrow(run, "block int, blob binary"), n


def unpack(rows: pa.Table):
    """The Arrow batches packed in the blobs of one block."""
    for blob in rows.column("blob"):
        with pa.ipc.open_stream(blob.as_buffer()) as r:
            yield from r
