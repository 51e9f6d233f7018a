"""The query registry: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and the
DuckDB oracle ``ORACLES[name]`` (SQL over the driver tables as views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    """Register a query builder (and, when given, its oracle SQL)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round_cols(df: DataFrame, cols, digits: int) -> DataFrame:
    """Round order-dependent means to fixed digits (same on both sides)."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
