"""Bridge transaction analytics: chain-code lookup and latency per minute."""

from __future__ import annotations

from itertools import chain as _chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X


def chain_code_map():
    """The fixed chain-id table as a map literal (36 entries)."""
    return F.create_map(*_chain.from_iterable(
        (F.lit(k), F.lit(v)) for k, v in sorted(K.CHAIN_CODES.items())))


def chain_dim(spark):
    """The fixed chain-id table as a two-column DataFrame."""
    return spark.createDataFrame(sorted(K.CHAIN_CODES.items()), "code int, name string")


def map_codes(df: DataFrame, cols, dim: DataFrame | None = None,
              default: str = K.UNKNOWN_CHAIN, code: str = "code",
              name: str = "name") -> DataFrame:
    """Replace code columns by names; unknown, NULL, unparsable and too wide
    codes -> ``default`` (P18, J4).

    Without ``dim`` the fixed 36-entry table is inlined as a map literal:
    no join, no shuffle, evaluated inside the generated code. With a
    ``dim`` DataFrame each column becomes a left equi-join; Spark broadcasts
    the dimension only when its measured size is under the broadcast
    threshold and falls back to a shuffle join beyond it.
    """
    if isinstance(cols, str):
        cols = [cols]
    if dim is None:
        m = chain_code_map()
        return df.withColumns({
            c: F.coalesce(F.try_element_at(m, F.col(c).try_cast("int")), F.lit(default))
            for c in cols})
    out = df
    d = dim.select(F.col(code).alias("__code"), F.col(name).alias("__name"))
    for c in cols:
        out = (out.join(d, out[c].try_cast(d.schema["__code"].dataType) == d["__code"], "left")
                  .withColumn(c, F.coalesce(F.col("__name"), F.lit(default)))
                  .drop("__code", "__name"))
    return out


def latency_minute(df: DataFrame, start: str = "timestamp", end: str = "dest_timestamp",
                   positive_only: bool = True) -> DataFrame:
    """Mean bridge latency in seconds per source minute.

    Latency is accumulated in whole microseconds so the mean does not
    depend on summation order.
    """
    f = df.select(X.floor_to("minute", start).alias("minute"),
                  X.latency_micros(start, end).alias("lat_us"))
    if positive_only:
        f = f.where(F.col("lat_us") > 0)
    f = f.where(F.col("minute").isNotNull())
    return f.groupBy("minute").agg(
        (F.avg(F.col("lat_us").cast("double")) / 1e6).alias("avg_latency_s"),
        F.count(F.lit(1)).alias("transfers"))
