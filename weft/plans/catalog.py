"""All registered queries (importing the query modules registers them)."""

from __future__ import annotations

from . import registry


def _load() -> None:
    from . import q_text  # noqa: F401
    for mod in ("q_vocab", "q_metrics", "q_stats", "q_stream", "q_sources"):
        try:
            __import__(f"{__package__}.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"{__package__}.{mod}":
                raise


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return registry.oracle_texts()
