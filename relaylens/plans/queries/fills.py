"""Fill statistics: latency, fees, volumes, relayer yield, token share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import fills
from ...session import run_folder
from .. import bindings as B
from .. import flows
from ..registry import ORACLES, register
from ..registry import round_cols as _round


FILLS = f"WITH fills AS ({B.fills_sql()})\n"
FILLS_CHAIN = f"WITH fills AS ({B.fills_sql(with_chain=True)})\n"
LAT_US = "(epoch_us(out_ts) - epoch_us(in_ts))"


@register("latency_daily", FILLS + f"""
SELECT CAST(in_ts AS DATE) AS day,
       sum(CAST({LAT_US} AS DOUBLE)) / count(*) / 1e6 AS avg_latency_s,
       max({LAT_US}) / 1e6 AS max_latency_s,
       min({LAT_US}) / 1e6 AS min_latency_s
FROM fills WHERE out_ts IS NOT NULL AND in_ts IS NOT NULL GROUP BY 1""")
def q_latency_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Mean/max/min fill latency per input day."""
    return fills.latency_daily(B.fills_view(spark, sf))


@register("fee_daily", FILLS + """
SELECT CAST(in_ts AS DATE) AS day, sum(fee) / count(fee) AS avg_fee, max(fee) AS max_fee, min(fee) AS min_fee
FROM (SELECT in_ts, input_amount_usd - output_amount_usd AS fee FROM fills
      WHERE output_symbol = token_symbol AND in_ts IS NOT NULL) GROUP BY 1""")
def q_fee_daily(spark, sf):
    """Mean/max/min fee per day over same-token fills."""
    return fills.fee_daily(B.fills_view(spark, sf))


@register("fee_pct_daily", FILLS + """
SELECT CAST(in_ts AS DATE) AS day, round(avg(p), 10) AS avg_fee_pct, round(max(p), 10) AS max_fee_pct,
       round(min(p), 10) AS min_fee_pct
FROM (SELECT in_ts, (input_amount_usd - output_amount_usd) / nullif(input_amount_usd, 0) AS p FROM fills
      WHERE output_symbol = token_symbol AND in_ts IS NOT NULL) GROUP BY 1""")
def q_fee_pct_daily(spark, sf):
    """Mean/max/min fee fraction per day over same-token fills (A5, P20)."""
    return _round(fills.fee_pct_daily(B.fills_view(spark, sf)),
                  ["avg_fee_pct", "max_fee_pct", "min_fee_pct"], 10)


@register("volume_by_token", FILLS + """
SELECT token_symbol, coalesce(sum(input_amount_usd), 0.0) AS volume_usd
FROM fills WHERE token_symbol IS NOT NULL GROUP BY 1""")
def q_volume_by_token(spark, sf):
    """USD volume per input token, descending."""
    return fills.volume_by(B.fills_view(spark, sf), "token_symbol")


@register("volume_by_chain", FILLS_CHAIN + """
SELECT src_chain, coalesce(sum(input_amount_usd), 0.0) AS volume_usd
FROM fills WHERE src_chain IS NOT NULL GROUP BY 1""")
def q_volume_by_chain(spark, sf):
    """USD volume per source chain, descending."""
    return fills.volume_by(B.fills_view(spark, sf, with_chain=True), "src_chain")


@register("relayer_fees", FILLS + """
SELECT relayer, coalesce(sum(input_amount_usd - output_amount_usd), 0.0) AS total_fees
FROM fills WHERE relayer IS NOT NULL GROUP BY 1""")
def q_relayer_fees(spark, sf):
    """Total fees per relayer."""
    return fills.relayer_fees(B.fills_view(spark, sf))


@register("relayer_yield", FILLS + """
SELECT relayer, round(avg((input_amount_usd - output_amount_usd) * 100 / nullif(input_amount_usd, 0)), 8)
       AS avg_yield_pct
FROM fills WHERE relayer IS NOT NULL GROUP BY 1""")
def q_relayer_yield(spark, sf):
    """Mean per-fill yield percent per relayer."""
    return _round(fills.relayer_yield(B.fills_view(spark, sf)), ["avg_yield_pct"], 8)


@register("token_share", FILLS + """
SELECT 100 * count(*) FILTER (WHERE output_symbol = token_symbol) / count(*) AS same_token_pct,
       100 * count(*) FILTER (WHERE output_symbol IS DISTINCT FROM token_symbol
                                AND token_symbol IS NOT NULL AND output_token IS NOT NULL) / count(*)
         AS diff_token_pct
FROM fills""")
def q_token_share(spark, sf):
    """Percent of same-token and different-token fills over all rows."""
    return fills.token_share(B.fills_view(spark, sf))


@register("fill_exports_latency", ORACLES["latency_daily"])
def q_fill_exports_latency(spark, sf):
    """Daily fill latency from two landed CSV exports (split by input
    symbol), read back with the declared fills schema."""
    root = run_folder(spark, "fill_exports", sf)
    f = B.fills_view(spark, sf)
    first = F.coalesce(F.col("token_symbol"), F.lit("")).isin("F", "O")
    (f.withColumn("export", F.when(first, "p1").otherwise("p2"))
      .write.partitionBy("export").option("header", True).csv(root))      # both exports in one job
    return fills.latency_daily(flows.read_fill_exports(spark, [f"{root}/export=p1", f"{root}/export=p2"]))


NULL_TEXT = ("nan", "NULL", "NA", "None")


@register("fills_null_text", FILLS + f"""
SELECT token_symbol, count(*) AS fills, count(out_ts) AS filled, coalesce(sum(input_amount_usd), 0.0) AS volume_usd
FROM fills GROUP BY 1""")
def q_fills_null_text(spark, sf):
    """Fill exports that write missing values as 'nan', 'NULL', 'NA' or 'None',
    read back as NULL in text and number columns (S1)."""
    root = run_folder(spark, "fills_null_text", sf)
    f = B.fills_view(spark, sf)
    word = F.element_at(F.array(*[F.lit(t) for t in NULL_TEXT]), F.pmod(F.xxhash64("input_time", "relayer"), F.lit(4)).cast("int") + 1)
    f.select(*[F.coalesce(F.col(c).cast("string"), word).alias(c) for c in f.columns]).write.option("header", True).csv(root)
    back = flows.read_fill_exports(spark, [root])
    return back.groupBy("token_symbol").agg(
        F.count(F.lit(1)).alias("fills"), F.count("output_time").alias("filled"),
        F.coalesce(F.sum("input_amount_usd"), F.lit(0.0)).alias("volume_usd"))
