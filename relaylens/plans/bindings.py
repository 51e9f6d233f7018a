"""Bindings: the driver's test tables re-expressed as the domain inputs.

The driver tables are TPC-H-like (orders, lineitem, part, customer,
nation) plus an ``events`` stream. Each binding maps them onto one input
of the order-flow workflows (FIXTURES.md) with plain column expressions.

Where an expression is portable SQL it is written once and used both by
Spark (``selectExpr``) and by the DuckDB oracle, so both engines see the
same *inputs*; the operators under test and the oracle SQL over these
inputs are written independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_mod(col: str, m: int, labels) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(labels))
    return f"CASE {col} % {m} {whens} END"


CHAIN_NAMES = [c for c, _ in K.PACK_CHAINS]
CHAIN_LABELS = [n for _, n in K.PACK_CHAINS]

# ----------------------------------------------------------------- fills
# Fills: one per line item; the input leg is the order, the output leg the
# shipment. Amounts are whole dollars, so sums are exact in any order.
FILL_BAD_INPUT = "l_linenumber = 5 AND l_returnflag = 'A'"   # unparsable input_time
FILL_UNFILLED = "l_linenumber = 7"                            # missing output_time
FILL_COLUMNS = [
    ("token_symbol", "CASE WHEN o_orderstatus = 'P' AND l_linenumber = 6 THEN NULL ELSE o_orderstatus END"),
    ("output_symbol", "l_linestatus"),
    ("output_token", "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END"),
    ("input_amount_usd", "CAST(floor(l_extendedprice) AS DOUBLE)"),
    ("output_amount_usd", "CAST(floor(l_extendedprice * (1 - l_discount)) AS DOUBLE)"),
    ("relayer", "CAST(l_suppkey AS STRING)"),
]


def fills_view(spark: SparkSession, sf_dir: str, with_chain: bool = False) -> DataFrame:
    """Raw fills with text times ``'yyyy-MM-dd HH:mm:ss.SSSSSS UTC'``.

    ``with_chain`` adds ``src_chain`` (customer nation), which costs two
    more joins; queries that do not group by chain leave it out.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    chain = F.lit(None).cast("string")
    if with_chain:
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        j = j.join(c, j["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"])
        chain = F.col("n_name")

    def text(c):
        return F.concat(F.date_format(c, TIME_TEXT), F.lit(" UTC"))

    return j.select(
        F.when(F.expr(FILL_BAD_INPUT), F.lit("not a time")).otherwise(text("o_orderdate")).alias("input_time"),
        F.when(F.expr(FILL_UNFILLED), F.lit(None).cast("string")).otherwise(text("l_shipdate")).alias("output_time"),
        *[F.expr(e).alias(a) for a, e in FILL_COLUMNS],
        chain.alias("src_chain"),
    )


def fills_sql(with_chain: bool = False) -> str:
    """DuckDB: the same fills with typed times ``in_ts``/``out_ts``."""
    cols = ",\n    ".join(f"{e} AS {a}" for a, e in FILL_COLUMNS)
    joins = "lineitem JOIN orders ON l_orderkey = o_orderkey"
    chain = "CAST(NULL AS VARCHAR)"
    if with_chain:
        joins += " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
        chain = "n_name"
    return f"""SELECT
    CASE WHEN {FILL_BAD_INPUT} THEN NULL ELSE o_orderdate END AS in_ts,
    CASE WHEN {FILL_UNFILLED} THEN NULL ELSE l_shipdate END AS out_ts,
    {cols},
    {chain} AS src_chain
  FROM {joins}"""


# ------------------------------------------------------------ order documents
ORDER_DOC_COLUMNS = [
    ("orderid", "CAST(l_orderkey AS STRING)"),
    ("makerSrc", "CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 5 = 0 "
                 "THEN 'So' || CAST(o_custkey AS STRING) ELSE '0x' || CAST(o_custkey AS STRING) END"),
    ("receiverDst", "CASE WHEN l_suppkey % 7 = 0 THEN 'So' || CAST(l_suppkey AS STRING) "
                    "ELSE '0x' || CAST(l_suppkey AS STRING) END"),
    ("giveOfferWithMetadata_finalAmount",
     "CASE WHEN l_discount = 0 THEN '0' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) * 100 AS STRING) END"),
    ("giveOfferWithMetadata_metadata_decimals", "CASE WHEN l_linenumber = 7 THEN 'nan' ELSE '2' END"),
    ("giveOfferWithMetadata_metadata_symbol",
     "CASE WHEN p_brand = 'Brand#1' THEN 'S' WHEN p_brand = 'Brand#2' THEN 'scUSD' "
     "ELSE 'T' || substr(p_brand, 7) END"),
    ("giveOfferWithMetadata_chainId", "CAST(o_custkey % 8 AS STRING)"),
    ("takeOfferWithMetadata_finalAmount",
     "CAST(CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) * 1000000 AS STRING)"),
    ("takeOfferWithMetadata_metadata_decimals", "'6'"),
    ("takeOfferWithMetadata_metadata_symbol",
     "CASE WHEN p_size = 1 THEN 'S' WHEN p_type = 'STANDARD' THEN 'SOL' WHEN p_type = 'MEDIUM' THEN 'WETH' "
     "WHEN p_type = 'PROMO' THEN 'wstEth' WHEN p_type = 'LARGE' THEN 'BNB' WHEN p_type = 'SMALL' THEN 'USDC' "
     "ELSE 'WBNB' END"),
    ("takeOfferWithMetadata_chainId", "CAST(l_suppkey % 8 AS STRING)"),
    ("createdSrcEventMetadata_transactionHash",
     "'0xs' || CAST(l_orderkey AS STRING) || 'n' || CAST(l_linenumber AS STRING)"),
    ("fulfilledDstEventMetadata_transactionHash",
     "'0xd' || CAST(l_orderkey AS STRING) || 'n' || CAST(l_linenumber AS STRING)"),
    ("preswapData_inAmount",
     "CASE WHEN l_returnflag = 'R' THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) ELSE 'nan' END"),
    ("preswapData_outAmount",
     "CASE WHEN l_returnflag = 'R' THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) * 100 AS STRING) ELSE 'nan' END"),
    ("preswapData_tokenInMetadata_name",
     "CASE WHEN l_returnflag = 'R' AND p_type = 'PROMO' THEN 'USD-Coin' WHEN l_returnflag = 'R' THEN lower(p_type) "
     "WHEN l_returnflag = 'N' THEN 'nan' ELSE 'None' END"),
    ("preswapData_tokenInMetadata_symbol",
     "CASE WHEN l_returnflag = 'R' THEN upper(substr(p_type, 1, 3)) ELSE 'nan' END"),
    ("preswapData_tokenInMetadata_decimals", "CASE WHEN l_returnflag = 'R' THEN '0' ELSE 'nan' END"),
    ("preswapData_tokenOutMetadata_name", "CASE WHEN l_returnflag = 'R' THEN 'Token ' || p_brand ELSE 'nan' END"),
    ("preswapData_tokenOutMetadata_symbol", "CASE WHEN l_returnflag = 'R' THEN 'T' || substr(p_brand, 7) ELSE 'nan' END"),
    ("preswapData_tokenOutMetadata_decimals", "CASE WHEN l_returnflag = 'R' THEN '2' ELSE 'nan' END"),
    ("taker", "'0x' || CAST(l_suppkey AS STRING)"),
    ("percentFee", "CAST(l_linenumber * 4 AS STRING)"),
    ("finalPercentFee", "CAST(l_linenumber * 4 + 1 AS STRING)"),
    ("fixFee", "CAST(o_custkey % 3 AS STRING)"),
    ("state", "CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Created' ELSE 'SentUnlock' END"),
    ("orderMetadata_origin", "o_orderpriority"),
    ("orderMetadata_orderTradeType", "CASE WHEN l_returnflag = 'R' THEN 'PreswapOrder' ELSE 'Normal' END"),
]


def order_docs_view(spark: SparkSession, sf_dir: str, order: int | None = None) -> DataFrame:
    """Flattened order documents (all text), one per line item; ``order`` limits
    them to one order by the stored key, which reaches the scans."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    if order is not None:
        li, o = li.where(F.col("l_orderkey") == order), o.where(F.col("o_orderkey") == order)
    # joined on the key's text, which is the documents' id: what joins them on the id next finds them dealt by it
    j = li.join(p, li["l_partkey"] == p["p_partkey"]).join(
        o, F.col("l_orderkey").cast("string") == o["o_orderkey"].cast("string"))
    return j.selectExpr(*[f"{e} AS {a}" for a, e in ORDER_DOC_COLUMNS])


def order_docs_sql() -> str:
    cols = ",\n    ".join(f"{e} AS {a}" for a, e in ORDER_DOC_COLUMNS)
    return (f"SELECT\n    {cols}\n  FROM lineitem JOIN part ON l_partkey = p_partkey "
            f"JOIN orders ON l_orderkey = o_orderkey")


# ------------------------------------------------------------------ event log
EVENT_LOG_FILTER = "o_orderstatus <> 'P'"
EVENT_LOG_COLUMNS = [
    ("orderid", "CAST(o_orderkey AS STRING)"),
    ("src_evt_time", "o_orderdate"),
    ("src_chain", _case_mod("o_custkey", 8, CHAIN_LABELS)),
    ("dest_chain", _case_mod("o_orderkey", 8, CHAIN_LABELS)),
]


def event_log_view(spark: SparkSession, sf_dir: str, order: int | None = None) -> DataFrame:
    """Aligned order events; orders still pending have no event row, so
    the left join of the order analytics misses for them."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    if order is not None:
        o = o.where(F.col("o_orderkey") == order)
    cols = [F.expr(e).alias(a) for a, e in EVENT_LOG_COLUMNS]
    dest_t = F.timestamp_add("SECOND", F.col("o_orderkey") % 3600, F.col("o_orderdate"))
    return (o.where(F.expr(EVENT_LOG_FILTER))
             .select(*cols[:3], dest_t.alias("dest_evt_time"), cols[3]))


def event_log_sql() -> str:
    c = dict(EVENT_LOG_COLUMNS)
    return (f"SELECT {c['orderid']} AS orderid, {c['src_evt_time']} AS src_evt_time, "
            f"{c['src_chain']} AS src_chain, o_orderdate + to_seconds(o_orderkey % 3600) AS dest_evt_time, "
            f"{c['dest_chain']} AS dest_chain FROM orders WHERE {EVENT_LOG_FILTER}")


# --------------------------------------------------------- leg events (F2 long form)
def source_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-creation events: one per non-pending order."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.expr(EVENT_LOG_FILTER)).select(
        F.col("o_orderkey").alias("orderId"), F.col("o_orderdate").alias("evt_time"),
        F.expr(_case_mod("o_custkey", 8, CHAIN_NAMES)).alias("chain"))


def dest_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilment events: one per shipment, several per order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_suppkey")
    return li.select(F.col("l_orderkey").alias("orderId"), F.col("l_shipdate").alias("evt_time"),
                     F.expr(_case_mod("l_suppkey", 8, CHAIN_NAMES)).alias("chain"))


SOURCE_LEG_SQL = (f"SELECT o_orderkey AS id, o_orderdate AS t, {_case_mod('o_custkey', 8, CHAIN_NAMES)} AS c "
                  f"FROM orders WHERE {EVENT_LOG_FILTER}")
DEST_LEG_SQL = f"SELECT l_orderkey AS id, l_shipdate AS t, {_case_mod('l_suppkey', 8, CHAIN_NAMES)} AS c FROM lineitem"


# ------------------------------------------------------------------ events
EVENT_CATEGORIES = (("click", "CLICK"), ("view", "VIEW"), ("purchase", "PURCHASE"),
                    ("signup", "SIGNUP"), ("error", "ERROR"))
TRANSFER_STATUS = "CASE event_type WHEN 'purchase' THEN 'DONE' WHEN 'error' THEN 'FAILED' ELSE 'PENDING' END"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def bridge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge transfers: event ``e`` is sent, its partner ``e XOR 1`` is the
    arrival; half of the pairs arrive 'before' they were sent."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    dst = ev.select(F.col("event_id").alias("d_id"), F.col("ts").alias("dest_timestamp"))
    return (ev.join(dst, F.col("event_id").bitwiseXOR(F.lit(1)) == F.col("d_id"))
              .select("event_id", F.col("ts").alias("timestamp"), "dest_timestamp",
                      "user_id", "event_type", "value"))


BRIDGE_PAIRS_SQL = ("SELECT e.event_id, e.ts AS timestamp, d.ts AS dest_timestamp, e.user_id, e.event_type, e.value "
                    "FROM events e JOIN events d ON d.event_id = xor(e.event_id, 1)")
