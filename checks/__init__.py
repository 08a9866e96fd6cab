"""Queries over the given tables, each with the SQL that has to agree with it."""

from importlib import import_module

MODULES = (
    "source_queries",
    "column_queries",
    "table_queries",
    "window_queries",
    "recommend_queries",
    "ml_queries",
    "streaming_queries",
    "flow_queries",
)


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"checks.{name}")
