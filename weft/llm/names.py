"""Working column names that no input column can clash with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def numbered(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with every column but the used ones renamed to its number, and what undoes that: it takes
    a frame with these columns, drops all others, and gives docs' columns back."""
    names = [c if c in used else f"c{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda rows: rows.select(*names).toDF(*docs.columns)
