"""Query registry: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str | None = None):
    def deco(fn):
        REGISTRY[name or fn.__name__] = fn
        return fn

    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # Importing the modules fills the registry.
    from . import queries, queries_io, queries_runs, queries_stream  # noqa: F401

    return dict(REGISTRY)
