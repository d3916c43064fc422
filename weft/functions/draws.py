"""Deterministic per-row random draws.

A draw is a uniform number in [0, 1) computed from the row key:
``first 8 hex digits of md5("<seed>:<purpose>:<key>") / 2^32``.
It is stable under repartitioning and task retries (``rand(seed)`` is not), and
DuckDB computes the identical number, which makes randomised operators checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def uniform(key: Column | str, purpose: str, seed: int = 42) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_32)


def uniform_sql(key_sql: str, purpose: str, seed: int = 42) -> str:
    """The same draw as DuckDB SQL text (used by the oracles)."""
    return (f"(('0x' || substr(md5('{seed}:{purpose}:' || CAST({key_sql} AS VARCHAR)), 1, 8))"
            f"::BIGINT / {TWO_POW_32})")
