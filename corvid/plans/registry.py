"""Named queries: a Spark builder plus (where SQL can say it) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Builder
    sql: str | None
    doc: str


_REGISTRY: dict[str, NamedQuery] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = NamedQuery(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def all_queries() -> dict[str, NamedQuery]:
    # import for side effects: each module registers its queries
    from corvid.plans import q_feed, q_geo, q_imaging, q_ml, q_paths, q_profile, q_sources  # noqa: F401
    return dict(_REGISTRY)
