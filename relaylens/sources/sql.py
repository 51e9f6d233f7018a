"""SQL text over named DataFrames."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def sql_query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text in which ``{name}`` placeholders refer to ``views``; any
    other brace is left as it is.

    Each DataFrame is registered under a unique temporary view name, so
    concurrent or repeated calls cannot see each other's inputs. Errors
    raise (nothing is swallowed). The result is analysed immediately, so
    it keeps its inputs even after the views are dropped.
    """
    names = {}
    for key, df in (views or {}).items():
        name = f"{key}_{uuid.uuid4().hex[:10]}"
        df.createOrReplaceTempView(name)
        names[key] = name
    try:
        return spark.sql(re.sub(r"\{(\w+)\}", lambda m: names.get(m[1], m[0]), sql))
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
