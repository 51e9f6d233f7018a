"""Order analytics: pair and route summaries, order detail, legs, backlog;
the SQL-text path and the sentinel parity mode."""

from __future__ import annotations


from ...functions import constants as K
from ...functions import expr as X
from ...operators import orders
from ...session import run_folder
from ...sources import sinks
from ...sources.sql import sql_query
from .. import bindings as B
from ..registry import register
from ..registry import round_cols as _round


def _clean(x: str) -> str:
    return f"(CASE WHEN {x} IN ('nan', 'None', '') THEN NULL ELSE {x} END)"


def _num(x: str) -> str:
    return f"TRY_CAST({_clean(x)} AS DOUBLE)"


def _ladder(pair: str) -> str:
    leg = f"split({pair}, '-')[2]"
    whens = " ".join(f"WHEN {leg} LIKE '{p}' THEN CAST({v!r} AS DOUBLE)" for p, v in K.USD_PRICE_LADDER)
    return f"CASE {whens} ELSE CAST({K.USD_PRICE_DEFAULT!r} AS DOUBLE) END"


def _chain_case(addr: str, sym: str, chain: str) -> str:
    """Chain label: the address/symbol override if one applies, else the
    event's chain (an unknown test falls through, as in SQL)."""
    non_evm = f"if(NOT starts_with({addr}, '0x'), 'SOL', NULL)"
    sonic = f"if({sym} = 'S' OR starts_with({sym}, 'sc'), 'SONIC', NULL)"
    return f"coalesce({non_evm}, {sonic}, {chain})"


ORDERS_BASE = f"""WITH docs AS ({B.order_docs_sql()}),
ev AS ({B.event_log_sql()}),
j AS (SELECT d.*, e.orderid AS ev_orderid, e.src_evt_time AS ev_src_evt_time, e.src_chain AS ev_src_chain,
             e.dest_evt_time AS ev_dest_evt_time, e.dest_chain AS ev_dest_chain
      FROM docs d LEFT JOIN ev e ON e.orderid = d.orderid),
m0 AS (
  SELECT ev_orderid AS orderid,
    {_chain_case('makerSrc', 'giveOfferWithMetadata_metadata_symbol', 'ev_src_chain')} AS src_chain,
    {_chain_case('receiverDst', 'takeOfferWithMetadata_metadata_symbol', 'ev_dest_chain')} AS dest_chain,
    coalesce({_clean('preswapData_tokenInMetadata_name')}, giveOfferWithMetadata_metadata_symbol) AS in_token,
    takeOfferWithMetadata_metadata_symbol AS out_symbol,
    CASE WHEN {_clean('preswapData_tokenInMetadata_name')} IS NOT NULL
         THEN {_num('preswapData_inAmount')} / pow(10, {_num('preswapData_tokenInMetadata_decimals')})
         ELSE {_num('giveOfferWithMetadata_finalAmount')} / pow(10, {_num('giveOfferWithMetadata_metadata_decimals')})
    END AS amount_in,
    {_num('takeOfferWithMetadata_finalAmount')} / pow(10, {_num('takeOfferWithMetadata_metadata_decimals')})
      AS amount_out
  FROM j WHERE {_num('giveOfferWithMetadata_finalAmount')} > 0),
m1 AS (SELECT *, amount_out / nullif(amount_in, 0) AS final_price, in_token || '-' || out_symbol AS pair,
              src_chain || '-' || dest_chain AS route FROM m0),
m AS (SELECT *, {_ladder('pair')} AS usd_price FROM m1)
"""

SUMMARY = """count({k}) AS tx_count, round(avg(final_price), 6) AS avg_price, sum(amount_in) AS amount_in,
       sum(amount_out) AS amount_out, sum(usd_price * amount_out) AS volume_usd"""


@register("pair_analysis", ORDERS_BASE + f"SELECT pair, {SUMMARY.format(k='pair')} FROM m GROUP BY pair")
def q_pair_analysis(spark, sf):
    """Per-pair count, mean price, in/out totals, USD volume."""
    return _round(orders.pair_analysis(B.order_docs_view(spark, sf), B.event_log_view(spark, sf)),
                  ["avg_price"], 6)


@register("chain_analysis", ORDERS_BASE + f"SELECT route AS chain, {SUMMARY.format(k='route')} FROM m GROUP BY route")
def q_chain_analysis(spark, sf):
    """The same per src-dest route; unknown routes form a NULL route counted 0 (A2)."""
    return _round(orders.chain_analysis(B.order_docs_view(spark, sf), B.event_log_view(spark, sf)),
                  ["avg_price"], 6)


@register("usd_volume", ORDERS_BASE + """
SELECT split(pair, '-')[2] AS out_leg, usd_price, count(*) AS orders, sum(amount_out) AS amount_out,
       sum(usd_price * amount_out) AS volume_usd FROM m GROUP BY 1, 2""")
def q_usd_volume(spark, sf):
    """USD volume per output leg and its reference price."""
    return orders.usd_volume(B.order_docs_view(spark, sf), B.event_log_view(spark, sf))


@register("scale_amount", f"""WITH docs AS ({B.order_docs_sql()})
SELECT orderid,
  {_num('giveOfferWithMetadata_finalAmount')} / pow(10, {_num('giveOfferWithMetadata_metadata_decimals')}) AS give_amount,
  {_num('takeOfferWithMetadata_finalAmount')} / pow(10, {_num('takeOfferWithMetadata_metadata_decimals')}) AS take_amount
FROM docs""")
def q_scale_amount(spark, sf):
    """Raw amounts scaled by their decimals."""
    d = B.order_docs_view(spark, sf)
    return d.select("orderid",
                    X.scale_amount(orders.GIVE_AMOUNT, orders.GIVE_DECIMALS).alias("give_amount"),
                    X.scale_amount(orders.TAKE_AMOUNT, orders.TAKE_DECIMALS).alias("take_amount"))


@register("classify_chain", f"""WITH docs AS ({B.order_docs_sql()}), ev AS ({B.event_log_sql()})
SELECT d.orderid,
  {_chain_case('makerSrc', 'giveOfferWithMetadata_metadata_symbol', 'e.src_chain')} AS src_chain,
  {_chain_case('receiverDst', 'takeOfferWithMetadata_metadata_symbol', 'e.dest_chain')} AS dest_chain
FROM docs d LEFT JOIN ev e ON e.orderid = d.orderid""")
def q_classify_chain(spark, sf):
    """Source and destination chain of every order document."""
    j = orders.enrich_orders(B.order_docs_view(spark, sf), B.event_log_view(spark, sf))
    return j.select("orderid",
                    X.classify_chain(orders.MAKER, orders.GIVE_SYMBOL, "ev_src_chain").alias("src_chain"),
                    X.classify_chain(orders.RECEIVER, orders.TAKE_SYMBOL, "ev_dest_chain").alias("dest_chain"))


def _detail_sql(where: str = "") -> str:
    cols = ",\n  ".join(f"{src} AS {dst}" for dst, src in orders.ORDER_DETAIL_COLUMNS)
    return f"""WITH docs AS ({B.order_docs_sql()}), ev AS ({B.event_log_sql()})
SELECT e.orderid AS ORDERID,
  {cols},
  e.src_evt_time AS SRC_EVT_TIME,
  {_chain_case('makerSrc', 'giveOfferWithMetadata_metadata_symbol', 'e.src_chain')} AS SRC_CHAIN,
  e.dest_evt_time AS DEST_EVT_TIME,
  {_chain_case('receiverDst', 'takeOfferWithMetadata_metadata_symbol', 'e.dest_chain')} AS DEST_CHAIN
FROM docs d LEFT JOIN ev e ON e.orderid = d.orderid {where}"""


@register("order_details", _detail_sql())
def q_order_details(spark, sf):
    """30-column order detail; ORDERID from the event side."""
    return orders.order_details(B.order_docs_view(spark, sf), B.event_log_view(spark, sf))


LOOKUP_ID = "1"


@register("order_lookup", _detail_sql(f"WHERE e.orderid = '{LOOKUP_ID}'"))
def q_order_lookup(spark, sf):
    """One order's detail by id (F1), looked up on the stored key of both tables."""
    docs, log = (f(spark, sf, int(LOOKUP_ID)) for f in (B.order_docs_view, B.event_log_view))
    return orders.order_lookup(orders.order_details(docs, log), LOOKUP_ID)


@register("order_lookup_stored", _detail_sql(f"WHERE e.orderid = '{LOOKUP_ID}'"))
def q_order_lookup_stored(spark, sf):
    """The same from order details stored for lookups: sorted by id, with Bloom filters."""
    target = f"{run_folder(spark, 'order_lookup', sf)}/details"
    sinks.write_for_lookup(orders.order_details(B.order_docs_view(spark, sf), B.event_log_view(spark, sf)), target, "ORDERID")
    return orders.order_lookup(spark.read.parquet(target), LOOKUP_ID)


@register("align_legs", f"""WITH s AS ({B.SOURCE_LEG_SQL}), d AS ({B.DEST_LEG_SQL}),
s1 AS (SELECT id, t, c FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, c) AS rn FROM s) WHERE rn = 1),
d1 AS (SELECT id, t, c FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, c) AS rn FROM d) WHERE rn = 1)
SELECT coalesce(s1.id, d1.id) AS orderid, s1.t AS src_evt_time, s1.c AS src_chain,
       d1.t AS dest_evt_time, d1.c AS dest_chain
FROM s1 FULL OUTER JOIN d1 ON s1.id = d1.id""")
def q_align_legs(spark, sf):
    """Earliest source and destination event per order, full outer."""
    return orders.align_legs(B.source_leg(spark, sf), B.dest_leg(spark, sf), chains=B.CHAIN_NAMES)


@register("backlog", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def q_backlog(spark, sf):
    """Orders with no line item yet."""
    cand = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return orders.backlog(cand, B.table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


@register("distinct_ids", "SELECT DISTINCT l_orderkey FROM lineitem")
def q_distinct_ids(spark, sf):
    """Distinct order ids of the line items."""
    return orders.distinct_ids(B.table(spark, sf, "lineitem"), "l_orderkey")


ROUTE_SQL = """
WITH j AS (
  SELECT d.*, e.src_chain AS ev_src, e.dest_chain AS ev_dest
  FROM {docs} d LEFT JOIN {events} e ON e.orderid = d.orderid
  WHERE try_cast(nullif(nullif(nullif(d.giveOfferWithMetadata_finalAmount, 'nan'), 'None'), '') AS DOUBLE) > 0),
m AS (
  SELECT
    coalesce(if(NOT startswith(makerSrc, '0x'), 'SOL', NULL),
             if(giveOfferWithMetadata_metadata_symbol = 'S'
                OR startswith(giveOfferWithMetadata_metadata_symbol, 'sc'), 'SONIC', NULL), ev_src) AS src,
    coalesce(if(NOT startswith(receiverDst, '0x'), 'SOL', NULL),
             if(takeOfferWithMetadata_metadata_symbol = 'S'
                OR startswith(takeOfferWithMetadata_metadata_symbol, 'sc'), 'SONIC', NULL), ev_dest) AS dst,
    try_cast(takeOfferWithMetadata_finalAmount AS DOUBLE)
      / pow(10, try_cast(nullif(takeOfferWithMetadata_metadata_decimals, 'nan') AS DOUBLE)) AS amount_out
  FROM j)
SELECT concat(src, '-', dst) AS route, count(concat(src, '-', dst)) AS tx_count, sum(amount_out) AS amount_out
FROM m GROUP BY concat(src, '-', dst)
"""


@register("route_volume_sql", ORDERS_BASE + """
SELECT route, count(route) AS tx_count, sum(amount_out) AS amount_out FROM m GROUP BY route""")
def q_route_volume_sql(spark, sf):
    """Route count and output volume written as Spark SQL text (S8) over
    the order documents and the event log passed as views."""
    return sql_query(spark, ROUTE_SQL, {"docs": B.order_docs_view(spark, sf),
                                        "events": B.event_log_view(spark, sf)})


# Parity mode: only the literal text 'nan' marks a missing pre-swap token.
PARITY_BASE = ORDERS_BASE.replace(
    f"coalesce({_clean('preswapData_tokenInMetadata_name')}, giveOfferWithMetadata_metadata_symbol) AS in_token",
    "if(preswapData_tokenInMetadata_name IS NOT DISTINCT FROM 'nan', giveOfferWithMetadata_metadata_symbol, "
    "preswapData_tokenInMetadata_name) AS in_token").replace(
    f"CASE WHEN {_clean('preswapData_tokenInMetadata_name')} IS NOT NULL",
    "CASE WHEN coalesce(preswapData_tokenInMetadata_name <> 'nan', false)")


@register("pair_analysis_parity", PARITY_BASE + f"SELECT pair, {SUMMARY.format(k='pair')} FROM m GROUP BY pair")
def q_pair_analysis_parity(spark, sf):
    """Pair summary with the literal ``= 'nan'`` sentinel test (a 'None'
    pre-swap name is kept as a token)."""
    return _round(orders.pair_analysis(B.order_docs_view(spark, sf), B.event_log_view(spark, sf),
                                       sentinel_mode=True), ["avg_price"], 6)
