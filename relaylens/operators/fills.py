"""Fill (relayed transfer) analytics: latency, fees, volumes, relayer yield.

Input schema (FIXTURES F6): ``input_time``/``output_time`` as zone-labelled
text, ``token_symbol``, ``output_symbol``, ``output_token``, ``relayer``,
``src_chain`` as text and ``input_amount_usd``/``output_amount_usd`` as
double.

Every daily statistic (mean, max, min) is ONE aggregate with three
functions, i.e. one shuffle on the day key with map-side partial
aggregation, so a hot day costs no more than an evenly spread one.
Group keys that are NULL are dropped, as a pandas ``groupby`` drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.nulls import nan_to_null


def prepare_fills(df: DataFrame, parse=X.parse_ts) -> DataFrame:
    """Typed view of raw fills: parsed times (NULL when unparsable), NaN
    amounts as NULL, and the input ``day``."""
    return (df
            .withColumn("input_ts", parse(F.col("input_time")))
            .withColumn("output_ts", parse(F.col("output_time")))
            .withColumn("input_amount_usd", nan_to_null("input_amount_usd"))
            .withColumn("output_amount_usd", nan_to_null("output_amount_usd"))
            .withColumn("day", X.to_day("input_ts")))


def latency_daily(fills: DataFrame) -> DataFrame:
    """Mean / max / min fill latency in seconds per input day (A3).

    Only filled transfers count (F3). The latency is accumulated as whole
    microseconds, so the mean does not depend on summation order.
    """
    f = (prepare_fills(fills)
         .where(X.is_filled("output_time"))
         .select("day", X.latency_micros("input_ts", "output_ts").cast("double").alias("lat_us"))
         .where(F.col("day").isNotNull()))
    return (f.groupBy("day")
             .agg((F.avg("lat_us") / 1e6).alias("avg_latency_s"),
                  (F.max("lat_us") / 1e6).alias("max_latency_s"),
                  (F.min("lat_us") / 1e6).alias("min_latency_s")))


def _same_token_fills(fills: DataFrame) -> DataFrame:
    return (prepare_fills(fills)
            .where(X.same_token("output_symbol", "token_symbol"))
            .where(F.col("day").isNotNull()))


def fee_daily(fills: DataFrame) -> DataFrame:
    """Mean / max / min fee (input USD - output USD) per day, same-token
    fills only (A4)."""
    f = _same_token_fills(fills).select(
        "day", X.fee("input_amount_usd", "output_amount_usd").alias("fee"))
    return f.groupBy("day").agg(F.avg("fee").alias("avg_fee"),
                                F.max("fee").alias("max_fee"),
                                F.min("fee").alias("min_fee"))


def fee_pct_daily(fills: DataFrame) -> DataFrame:
    """Mean / max / min fee fraction (fee / input USD) per day, same-token
    fills only (A5). Input 0 gives NULL, which the statistics skip."""
    f = _same_token_fills(fills).select(
        "day", X.fee_fraction("input_amount_usd", "output_amount_usd").alias("fee_pct"))
    return f.groupBy("day").agg(F.avg("fee_pct").alias("avg_fee_pct"),
                                F.max("fee_pct").alias("max_fee_pct"),
                                F.min("fee_pct").alias("min_fee_pct"))


def volume_by(fills: DataFrame, key: str, value: str = "input_amount_usd",
              alias: str = "volume_usd") -> DataFrame:
    """Total USD per ``key`` in descending order.

    An all-NULL group sums to 0.0 as in pandas; ties are broken by the key
    so the order is deterministic.
    """
    f = fills.select(F.col(key), nan_to_null(value).alias("v")).where(F.col(key).isNotNull())
    return (f.groupBy(key)
             .agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias(alias))
             .orderBy(F.col(alias).desc(), F.col(key)))


def relayer_fees(fills: DataFrame) -> DataFrame:
    """Total fee earned per relayer over all fills."""
    f = (fills.where(F.col("relayer").isNotNull())
              .select("relayer", X.fee(nan_to_null("input_amount_usd"),
                                       nan_to_null("output_amount_usd")).alias("fee")))
    return f.groupBy("relayer").agg(F.coalesce(F.sum("fee"), F.lit(0.0)).alias("total_fees"))


def relayer_yield(fills: DataFrame) -> DataFrame:
    """Unweighted mean of per-fill yield percent per relayer (A10)."""
    f = (fills.where(F.col("relayer").isNotNull())
              .select("relayer", X.yield_pct(nan_to_null("input_amount_usd"),
                                             nan_to_null("output_amount_usd")).alias("y")))
    return f.groupBy("relayer").agg(F.avg("y").alias("avg_yield_pct"))


def token_share(fills: DataFrame) -> DataFrame:
    """Percent of same-token and of different-token fills, both over ALL
    rows, so they need not add up to 100 (A11); NULL for no rows. One global aggregate."""
    same = X.same_token("output_symbol", "token_symbol")
    diff = X.different_token("output_symbol", "token_symbol", "output_token")
    return fills.agg(
        F.try_divide(F.lit(100) * F.count_if(same), F.count(F.lit(1))).alias("same_token_pct"),
        F.try_divide(F.lit(100) * F.count_if(diff), F.count(F.lit(1))).alias("diff_token_pct"))
