"""Query registry: name -> Spark builder, and name -> DuckDB oracle text."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query builder ``fn(spark, sf_dir) -> DataFrame``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (q_panel, q_ratios, q_credit, q_statements, q_text,  # noqa: F401
                   q_rating, q_stream)
