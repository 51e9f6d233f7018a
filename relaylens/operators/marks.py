"""High/low-water marks, incremental filters and row-count metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X


def high_water_mark(df: DataFrame, ts: str, by=None) -> DataFrame:
    """Newest and oldest time (A12, A16) and the row count, globally or per
    ``by``. Only the needed columns are read from the scan."""
    aggs = [F.max(ts).alias("high_water_mark"), F.min(ts).alias("low_water_mark"),
            F.count(F.lit(1)).alias("rows")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def since(df: DataFrame, ts: str, mark) -> DataFrame:
    """Rows strictly newer than ``mark`` (F5); the comparison is pushed to
    the parquet scan (row-group skipping on min/max statistics)."""
    m = F.lit(mark).cast(df.schema[ts].dataType) if not hasattr(mark, "_jc") else mark
    return df.where(X.newer_than(ts, m))


def stored_exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table is stored at ``path``. Only a missing or empty
    folder means no; storage and permission errors are raised."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def with_row_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row-count metric to ``df`` without an extra job (A15); read
    ``obs.get`` after the first action on the returned frame."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs
