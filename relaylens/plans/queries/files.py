"""Flows over files landed (by Spark) from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import schemas
from ...functions import expr as X
from ...operators import shape
from ...session import run_folder
from ...sources import drops, slices
from .. import bindings as B
from .. import flows
from ..registry import ORACLES, register
from .events import CODES_SQL


# Each flow lands its input files (derived by Spark from the driver tables)
# in a fresh folder under spark.checkpoint.dir, runs, and returns its result.

FMT_SQL = "'%Y-%m-%d %H:%M:%S.%f'"
LABEL_SRC = B._case_mod("o_custkey", 8, B.CHAIN_LABELS)
LABEL_DEST = B._case_mod("l_suppkey", 8, B.CHAIN_LABELS)


@register("event_log_build", f"""WITH
s AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, {FMT_SQL}) AS t, {LABEL_SRC} AS c
      FROM orders WHERE o_orderstatus <> 'P'),
d AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, strftime(l_shipdate, {FMT_SQL}) AS t, {LABEL_DEST} AS c FROM lineitem),
s1 AS (SELECT id, t, c FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, c) AS rn FROM s) WHERE rn = 1),
d1 AS (SELECT id, t, c FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, c) AS rn FROM d) WHERE rn = 1),
a AS (SELECT coalesce(s1.id, d1.id) AS orderid, s1.t AS src_evt_time, s1.c AS src_chain,
             d1.t AS dest_evt_time, d1.c AS dest_chain FROM s1 FULL OUTER JOIN d1 ON s1.id = d1.id)
SELECT * FROM a WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND CAST(o_orderkey AS VARCHAR) = a.orderid)""")
def q_event_log_build(spark, sf):
    """L1: packed CSV exports of both legs -> aligned event log of orders not stored yet."""
    root = run_folder(spark, "event_log_build", sf)
    src = B.source_leg(spark, sf).select(F.col("orderId").alias("orderid"),
                                         F.col("evt_time").alias("evt_block_time"), "chain")
    dest = B.dest_leg(spark, sf).select(F.col("orderId").alias("orderid"),
                                        F.col("evt_time").alias("evt_block_time"), "chain")
    flows.write_packed_csv(src, f"{root}/src")
    flows.write_packed_csv(dest, f"{root}/dest")
    stored = (B.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
              .select(F.col("o_orderkey").cast("string").alias("orderid")))
    flows.event_log_build(spark, f"{root}/src", f"{root}/dest", stored, target=f"{root}/event_log",
                          time_format=flows.PACK_TIME)
    return spark.read.parquet(f"{root}/event_log")


def _stored_docs_sql() -> str:
    """The order documents as the loader stores them: text, the pre-swap
    fields 'nan' where the document has no pre-swap object, missing
    values 'nan'."""
    cols = dict(B.ORDER_DOC_COLUMNS)
    name = cols["preswapData_tokenInMetadata_name"]
    out = []
    for alias, e in B.ORDER_DOC_COLUMNS:
        if alias.startswith("preswapData_"):
            e = f"CASE WHEN ({name}) IN ('nan', 'None', '') THEN 'nan' ELSE ({e}) END"
        out.append(f"coalesce({e}, 'nan') AS {alias}")
    return ("SELECT\n    " + ",\n    ".join(out) +
            "\n  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey")


@register("order_detail_load", f"""WITH docs AS ({_stored_docs_sql()})
SELECT * FROM docs WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderstatus = 'O' AND CAST(o_orderkey AS VARCHAR) = docs.orderid)""")
def q_order_detail_load(spark, sf):
    """L2: landed nested order documents (drifting keys) -> text rows of new orders."""
    root = run_folder(spark, "order_detail_load", sf)
    flows.write_order_docs(flows.nest_order_docs(B.order_docs_view(spark, sf)), f"{root}/docs")
    stored = (B.table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
              .select(F.col("o_orderkey").cast("string").alias("orderid")))
    flows.order_detail_load(spark, f"{root}/docs", stored, target=f"{root}/orders", null_text="nan",
                            schema=schemas.ORDER_DOC)
    return spark.read.parquet(f"{root}/orders")


@register("order_detail_mixed", """
SELECT CAST(o_orderkey AS VARCHAR) AS orderid, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 9 AS VARCHAR) END AS giveOfferWithMetadata_chainId,
       CASE WHEN o_custkey % 4 = 0 THEN CAST(o_custkey % 9 AS VARCHAR) END AS giveOfferWithMetadata_chainId_bigIntegerValue,
       o_orderstatus AS state
FROM orders""")
def q_order_detail_mixed(spark, sf):
    """L2 with a declared schema: documents whose chain id has only ``bigIntegerValue`` keep it."""
    root = run_folder(spark, "order_mixed", sf)
    o = B.table(spark, sf, "orders")
    chain = F.col("o_custkey") % 9
    only = F.col("o_custkey") % 4 == 0
    doc = F.struct(F.struct(F.col("o_orderkey").cast("string").alias("stringValue")).alias("orderId"),
                   F.struct(F.struct(F.when(~only, chain.cast("string")).alias("stringValue"),
                                     chain.cast("long").alias("bigIntegerValue")).alias("chainId")).alias("giveOfferWithMetadata"),
                   F.col("o_orderstatus").alias("state"))
    flows.write_order_docs(o.select(F.to_json(doc)), f"{root}/docs")
    flows.order_detail_load(spark, f"{root}/docs", target=f"{root}/orders", schema=schemas.ORDER_DOC)
    kept = ("orderid", "giveOfferWithMetadata_chainId", "giveOfferWithMetadata_chainId_bigIntegerValue", "state")
    return spark.read.parquet(f"{root}/orders").select(*kept)


@register("json_conflicts_kept", """
SELECT o_orderkey, o_orderstatus AS doc_state,
       CASE WHEN o_custkey % 6 = 1 THEN 'fee ' || o_custkey END AS doc_fee_text,
       CASE o_custkey % 6 WHEN 0 THEN CAST(o_custkey AS DOUBLE) WHEN 5 THEN o_custkey + 0.5 END AS doc_fee_number,
       CASE WHEN o_custkey % 6 = 2 THEN o_custkey % 4 = 0 END AS doc_fee_flag,
       CASE o_custkey % 6 WHEN 3 THEN '{"amount":' || o_custkey || ',"unit":"' || o_orderpriority || '"}'
                          WHEN 4 THEN '[' || o_custkey || ',"' || o_orderstatus || '"]' END AS doc_fee_json,
       CASE WHEN o_custkey % 9 > 0 THEN o_custkey % 9 END AS doc_chain_id
FROM orders""")
def q_json_conflicts_kept(spark, sf):
    """Documents whose ``fee`` is a number, text, flag, object or list, stored with that key as VARIANT
    beside the typed ones: every value comes back (P7)."""
    root = run_folder(spark, "json_conflicts", sf)
    fee = """CASE o_custkey % 6 WHEN 0 THEN concat('{"fee":', o_custkey, ',') WHEN 1 THEN concat('{"fee":"fee ', o_custkey, '",')
             WHEN 2 THEN concat('{"fee":', o_custkey % 4 = 0, ',')
             WHEN 3 THEN concat('{"fee":{"unit":"', o_orderpriority, '","amount":', o_custkey, '},')
             WHEN 4 THEN concat('{"fee":[', o_custkey, ',"', o_orderstatus, '"],') ELSE concat('{"fee":', o_custkey, '.5,') END"""
    chain = """CASE WHEN o_custkey % 9 > 0 THEN concat('"chain":{"id":', o_custkey % 9, '},') ELSE '' END"""
    docs = B.table(spark, sf, "orders").select(
        "o_orderkey", F.expr(f"""concat({fee}, {chain}, '"state":"', o_orderstatus, '"}}')""").alias("doc"))
    shape.shred_json_column(docs, "doc").write.parquet(f"{root}/docs")
    return shape.variant_kinds(spark.read.parquet(f"{root}/docs"), "doc_fee").drop("doc_fee")


@register("flatten_mixed_docs", """
SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS fee,
       CASE WHEN o_custkey % 3 = 1 THEN o_custkey END AS fee_amount,
       CASE WHEN o_custkey % 3 = 1 THEN o_orderpriority END AS fee_unit_code, o_orderstatus AS state
FROM orders""")
def q_flatten_mixed_docs(spark, sf):
    """Documents that wrap a value, send it as an object, or leave it out: each
    flattened by its own form (P7)."""
    root = run_folder(spark, "mixed_docs", sf)
    o = B.table(spark, sf, "orders")
    kind = F.col("o_custkey") % 3
    fee = F.struct(F.when(kind == 0, F.col("o_custkey").cast("string")).alias("stringValue"),
                   F.when(kind == 1, F.col("o_custkey")).alias("amount"),
                   F.when(kind == 1, F.struct(F.col("o_orderpriority").alias("code"))).alias("unit"))
    doc = F.struct(F.col("o_orderkey").alias("id"), F.when(kind < 2, fee).alias("fee"),
                   F.struct(F.col("o_orderstatus").alias("stringValue")).alias("state"))
    flows.write_order_docs(o.select(F.to_json(doc)), f"{root}/docs")
    schema = "id BIGINT, fee STRUCT<stringValue: STRING, amount: BIGINT, unit: STRUCT<code: STRING>>, state STRUCT<stringValue: STRING>"
    return shape.flatten_struct(flows.files.read_json_pages(spark, f"{root}/docs", schema=schema, multi_line=False))


@register("price_history", """WITH bars AS (
  SELECT event_type AS instrument, date_trunc('hour', ts) AS ts, max(value) AS CLOSE FROM events GROUP BY 1, 2),
bnd AS (SELECT instrument, min(ts) AS lo, max(ts) AS hi FROM bars GROUP BY 1),
grid AS (SELECT instrument, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM bnd)
SELECT g.instrument, g.ts,
  last_value(b.CLOSE IGNORE NULLS) OVER (PARTITION BY g.instrument ORDER BY g.ts
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CLOSE,
  b.CLOSE IS NULL AS filled
FROM grid g LEFT JOIN bars b ON b.instrument = g.instrument AND b.ts = g.ts""")
def q_price_history(spark, sf):
    """L3: price pages with overlapping edges -> de-duplicated, gap-filled series."""
    root = run_folder(spark, "price_history", sf)
    bars = (B.events(spark, sf)
            .groupBy(F.col("event_type").alias("instrument"), X.floor_to("hour", "ts").alias("ts"))
            .agg(F.max("value").alias("CLOSE")))
    flows.write_price_pages(bars, f"{root}/pages")
    return flows.price_history(spark, f"{root}/pages", step="1 hour", schema=schemas.PRICE_PAGE)


@register("price_history_minute", """WITH bars AS (
  SELECT event_type AS instrument, date_trunc('minute', ts) AS ts, max(value) AS CLOSE FROM events GROUP BY 1, 2),
bnd AS (SELECT instrument, min(ts) AS lo, max(ts) AS hi FROM bars GROUP BY 1),
grid AS (SELECT instrument, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS ts FROM bnd)
SELECT g.instrument, g.ts,
  last_value(b.CLOSE IGNORE NULLS) OVER (PARTITION BY g.instrument ORDER BY g.ts
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CLOSE,
  b.CLOSE IS NULL AS filled
FROM grid g LEFT JOIN bars b ON b.instrument = g.instrument AND b.ts = g.ts""")
def q_price_history_minute(spark, sf):
    """L3 over pages of minute bars: every bar keeps its minute."""
    root = run_folder(spark, "price_minutes", sf)
    bars = (B.events(spark, sf)
            .groupBy(F.col("event_type").alias("instrument"), X.floor_to("minute", "ts").alias("ts"))
            .agg(F.max("value").alias("CLOSE")))
    flows.write_price_pages(bars, f"{root}/pages")
    return flows.price_history(spark, f"{root}/pages", step="1 minute", schema=schemas.PRICE_PAGE)


#: Hourly bars; every eleventh is a second off the grid, every seventh comes again, revised, three seconds later.
REVISED_BARS_SQL = """own AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS instrument, epoch_us(ts) // 3600000000 AS b, max(value) AS v
  FROM events GROUP BY 1, 2),
bars AS (
  SELECT instrument, b * 3600 + CASE WHEN b % 11 = 0 THEN 1 ELSE 0 END AS t, v FROM own
  UNION ALL SELECT instrument, b * 3600 + 3, v + 1 FROM own WHERE b % 7 = 0),
kept AS (SELECT instrument, t // 3600 AS b, arg_max(v, t) AS v FROM bars GROUP BY 1, 2),
bnd AS (SELECT instrument, min(b) AS lo, max(b) AS hi FROM kept GROUP BY 1),
grid AS (SELECT instrument, unnest(range(lo, hi + 1)) AS b FROM bnd)
SELECT g.instrument, make_timestamp(g.b * 3600000000) AS ts,
       last_value(k.v IGNORE NULLS) OVER (PARTITION BY g.instrument ORDER BY g.b) AS CLOSE, k.v IS NULL AS filled
FROM grid g LEFT JOIN kept k ON k.instrument = g.instrument AND k.b = g.b"""


def _revised_bars(spark, sf):
    instrument = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("instrument")
    own = (B.events(spark, sf).groupBy(instrument, F.expr("unix_micros(cast(ts as timestamp)) div 3600000000").alias("b"))
           .agg(F.max("value").alias("CLOSE")))
    bars = own.select("instrument", (F.col("b") * 3600 + (F.col("b") % 11 == 0).cast("int")).alias("t"), "CLOSE")
    again = own.where("b % 7 = 0").select("instrument", (F.col("b") * 3600 + 3).alias("t"), (F.col("CLOSE") + 1).alias("CLOSE"))
    return bars.unionByName(again).select("instrument", X.epoch_to_ts("t").alias("ts"), "CLOSE")


@register("price_history_default_step", "WITH " + REVISED_BARS_SQL)
def q_price_history_default_step(spark, sf):
    """L3 without a step: bars off the grid and revisions a moment later leave it at an hour."""
    root = run_folder(spark, "price_default", sf)
    flows.write_price_pages(_revised_bars(spark, sf), f"{root}/pages")
    return flows.price_history(spark, f"{root}/pages", schema=schemas.PRICE_PAGE)


@register("price_history_rerun", "WITH " + REVISED_BARS_SQL)
def q_price_history_rerun(spark, sf):
    """L3 stored in three loads: the first days, all days, all days again (which appends nothing)."""
    root = run_folder(spark, "price_rerun", sf)
    bars = _revised_bars(spark, sf)
    flows.write_price_pages(bars.where(F.col("ts") < F.lit("2024-01-09").cast("timestamp_ntz")), f"{root}/first")
    flows.write_price_pages(bars, f"{root}/all")
    for pages in ("first", "all", "all"):
        added = flows.price_history(spark, f"{root}/{pages}", target=f"{root}/stored", schema=schemas.PRICE_PAGE)
    if not added.isEmpty():
        raise AssertionError("the same pages were appended twice")
    return flows.read_prices(spark, f"{root}/stored")


@register("price_bars_from_pages", """
SELECT event_type AS instrument, epoch_us(date_trunc('hour', ts)) // 1000000 AS TIMESTAMP, max(value) AS CLOSE
FROM events GROUP BY event_type, date_trunc('hour', ts)""")
def q_price_bars_from_pages(spark, sf):
    """Pages that repeat their neighbour's first bar; only bars at page edges are exchanged."""
    root = run_folder(spark, "price_edges", sf)
    bars = (B.events(spark, sf)
            .groupBy(F.col("event_type").alias("instrument"), X.floor_to("hour", "ts").alias("ts"))
            .agg(F.max("value").alias("CLOSE")))
    flows.write_price_pages(bars, f"{root}/pages")
    pages = flows.files.read_json_pages(spark, f"{root}/pages", multi_line=False, schema=schemas.PRICE_PAGE)
    return shape.dedupe_page_edges(pages, "Data", "TIMESTAMP", by="instrument")


DROP_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE, user_id BIGINT"
DROP_A = ("click", "view", "purchase")


@register("file_drop_aggregate", f"""
SELECT event_id, ts, event_type, value, CAST(NULL AS BIGINT) AS user_id FROM events
WHERE event_type IN {DROP_A}
UNION ALL
SELECT event_id, ts, event_type, CAST(NULL AS DOUBLE) AS value, user_id FROM events
WHERE event_type NOT IN {DROP_A}""")
def q_file_drop_aggregate(spark, sf):
    """L4: listing -> keyword/suffix selection -> header-drift CSV union."""
    root = run_folder(spark, "file_drop", sf)
    ev = B.events(spark, sf)
    w = dict(header=True, timestampNTZFormat=flows.PACK_TIME)
    a = ev.where(F.col("event_type").isin(*DROP_A))
    b = ev.where(~F.col("event_type").isin(*DROP_A))
    a.select("event_id", "ts", "event_type", "value").write.options(**w).csv(f"{root}/bundles/2024-01/a")
    b.select("event_id", "ts", "event_type", "user_id").write.options(**w).csv(f"{root}/bundles/2024-01/b")
    ev.drop("props").write.options(**w).csv(f"{root}/private/2024-01")
    return flows.file_drop_aggregate(spark, root, "BUNDLES/2024-01", DROP_SCHEMA)


@register("file_drop_journal", """SELECT event_id, ts, event_type, CASE WHEN event_id % 3 > 0 THEN value END AS value,
  CASE WHEN event_id % 3 = 0 THEN user_id END AS user_id, CAST(0 AS BIGINT) AS files_left FROM events""")
def q_file_drop_journal(spark, sf):
    """L4 with clean-up (S10): a load breaks off before its commit, one after it and before its
    clean-up, then one more file group lands and everything is loaded and deleted."""
    root = run_folder(spark, "file_drop_journal", sf)
    ev = B.events(spark, sf)
    w = dict(header=True, timestampNTZFormat=flows.PACK_TIME)
    drop, target = f"{root}/landed", f"{root}/stored"
    for k, stop in ((0, "append"), (1, "commit"), (2, None)):
        cols = ["event_id", "ts", "event_type", "user_id" if k == 0 else "value"]
        ev.where(F.col("event_id") % 3 == k).select(*cols).write.options(**w).csv(f"{drop}/bundles/{k}")
        drops.load_drop(spark, drop, "bundles", target, DROP_SCHEMA, timestamp_format=flows.PACK_TIME, clean=True, stop_after=stop)
    left = flows.files.select_files(flows.files.file_inventory(spark, drop), "bundles").count()
    return drops.read_drop(spark, target, DROP_SCHEMA).withColumn("files_left", F.lit(left).cast("bigint"))


@register("file_inventory")
def q_file_inventory(spark, sf):
    """Listing of the landed event CSV drop (rows-only check)."""
    root = run_folder(spark, "inventory", sf)
    B.events(spark, sf).drop("props").write.option("header", True).csv(f"{root}/drop")
    return flows.files.file_inventory(spark, root).select("key", "size")


@register("file_inventory_counts", """
SELECT event_type AS folder, 2 AS files, 1 AS empty_files,
       CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS bytes
FROM events GROUP BY 1""")
def q_file_inventory_counts(spark, sf):
    """Files, files without bytes and bytes per folder of a landed drop, from its listing (S3)."""
    root = run_folder(spark, "inventory_counts", sf)
    ev = B.events(spark, sf).select(F.col("event_id").cast("string"), F.col("event_type").alias("kind"))
    # one task and so one file per folder: a small folder count is what this listing is checked with
    ev.repartition("kind").write.partitionBy("kind").text(root)
    kinds = [r[0] for r in ev.select("kind").distinct().collect()]
    jvm = spark.sparkContext._jvm
    for kind in kinds:
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/kind={kind}/empty.csv")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()
    found = flows.files.file_inventory(spark, root)
    return found.groupBy(F.regexp_extract("key", "kind=([^/]+)/", 1).alias("folder")).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.count_if(F.col("size") == 0).cast("int").alias("empty_files"),
        F.sum("size").alias("bytes"))


BUNDLE_START = 1704844800  # 2024-01-10 00:00:00 UTC


@register("bundle_history", f"""
SELECT event_id, epoch_us(ts) // 1000000 AS timestamp, user_id, value,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS DATETIME
FROM events WHERE epoch_us(ts) // 1000000 > {BUNDLE_START}""")
def q_bundle_history(spark, sf):
    """Bundle pages -> bundles after a mark, with DATETIME."""
    root = run_folder(spark, "bundles", sf)
    rec = B.events(spark, sf).select(
        X.ts_to_epoch("ts").alias("timestamp"), "event_id", "user_id", "value",
        F.array("event_type").alias("tokens"),
        F.struct(F.col("value").alias("delta")).alias("token_balance_delta"),
        X.floor_to("hour", "ts").alias("page"))
    flows.write_json_pages(rec, f"{root}/pages", "data", "page")
    return flows.bundle_history(spark, f"{root}/pages", BUNDLE_START)


@register("resume_from_stored", f"""
SELECT event_id, epoch_us(ts) // 1000000 AS timestamp, value,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS DATETIME FROM events""")
def q_resume_from_stored(spark, sf):
    """L5 resumed: the first load stores the bundles up to a mark, the second
    appends what is not stored yet (S6, S7)."""
    root = run_folder(spark, "resume_stored", sf)
    rec = B.events(spark, sf).select(X.ts_to_epoch("ts").alias("timestamp"), "event_id", "value",
                                     F.array("event_type").alias("tokens"), F.lit("x").alias("token_balance_delta"),
                                     X.floor_to("hour", "ts").alias("page"))
    flows.write_json_pages(rec.where(F.col("timestamp") <= BUNDLE_START), f"{root}/pages/a", "data", "page")
    flows.resume_bundles(spark, f"{root}/pages/*", f"{root}/stored", schema=BUNDLE_FIELDS)
    flows.write_json_pages(rec, f"{root}/pages/b", "data", "page")
    flows.resume_bundles(spark, f"{root}/pages/*", f"{root}/stored", schema=BUNDLE_FIELDS)
    return flows.read_bundles(spark, f"{root}/stored", STORED_BUNDLES)


STORED_BUNDLES = "timestamp BIGINT, event_id BIGINT, value DOUBLE, DATETIME TIMESTAMP_NTZ"
BUNDLE_FIELDS = ("data ARRAY<STRUCT<timestamp: BIGINT, event_id: BIGINT, value: DOUBLE, tokens: ARRAY<STRING>, "
                 "token_balance_delta: STRING>>")


@register("resume_interrupted", ORACLES["resume_from_stored"])
def q_resume_interrupted(spark, sf):
    """L5 newest first, with an interruption: the newest week is loaded without its late bundles, a load of the
    week before breaks off before its commit, then everything comes again, all bundles at once."""
    root = run_folder(spark, "resume_interrupted", sf)
    rec = B.events(spark, sf).select(X.ts_to_epoch("ts").alias("timestamp"), "event_id", "value",
                                     F.array("event_type").alias("tokens"), F.lit("x").alias("token_balance_delta"),
                                     X.floor_to("hour", "ts").alias("page"))
    week, day = 7 * 86400, 86400
    newest = F.col("timestamp") >= BUNDLE_START + week
    late = F.col("event_id") % 5 == 0                     # same-second ones among them
    flows.write_json_pages(rec.where(newest & ~late), f"{root}/pages/newest", "data", "page")
    flows.resume_bundles(spark, f"{root}/pages/newest", f"{root}/stored", schema=BUNDLE_FIELDS)
    flows.write_json_pages(rec.where(~newest & (F.col("timestamp") >= BUNDLE_START - day)), f"{root}/pages/broken", "data", "page")
    broken = flows.bundle_history(spark, f"{root}/pages/broken", -(1 << 62), schema=BUNDLE_FIELDS)
    slices.load(broken, f"{root}/stored", "timestamp", commit=False)
    flows.write_json_pages(rec, f"{root}/pages/all", "data", "page")
    flows.resume_bundles(spark, f"{root}/pages/*", f"{root}/stored", schema=BUNDLE_FIELDS)
    flows.resume_bundles(spark, f"{root}/pages/all", f"{root}/stored", schema=BUNDLE_FIELDS)      # and once more: nothing new
    return flows.read_bundles(spark, f"{root}/stored", STORED_BUNDLES)


@register("loaded_intervals", """
WITH s AS (SELECT DISTINCT epoch_us(ts) // 1000000 // 3600 AS n FROM events WHERE epoch_us(ts) // 3600000000 % 7 < 3 OR ts < TIMESTAMP '2024-01-12'),
i AS (SELECT n, n - row_number() OVER (ORDER BY n) AS island FROM s)
SELECT min(n) AS first, max(n) AS last FROM i GROUP BY island""")
def q_loaded_intervals(spark, sf):
    """The hours that two loads brought, merged (gaps and islands)."""
    root = run_folder(spark, "loaded_intervals", sf)
    rec = B.events(spark, sf).select("event_id", "ts", X.ts_to_epoch("ts").alias("timestamp"))
    slices.load(rec.where(F.expr("timestamp div 3600 % 7 < 3")).drop("ts"), f"{root}/stored", "timestamp")
    slices.load(rec.where(F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz")).drop("ts"), f"{root}/stored", "timestamp")
    return slices.loaded_slices(spark, f"{root}/stored")


def _land_order_book(spark, sf, path):
    """Orders as 500-row order-book pages (bare JSON arrays, one per file);
    every other page lacks ``makerRate`` (drift)."""
    o = B.table(spark, sf, "orders").select(
        (F.col("o_orderkey") / 500).cast("long").alias("page"),
        F.concat(F.lit("0x"), F.col("o_orderkey").cast("string")).alias("orderHash"),
        F.concat(F.lit("m"), F.col("o_custkey").cast("string")).alias("maker"),
        F.round(F.col("o_totalprice") * 100).cast("long").cast("string").alias("makerAmount"),
        (F.col("o_totalprice") / 1000).alias("makerRate"))
    even = F.to_json(F.struct("orderHash", "maker", "makerAmount", "makerRate"))
    odd = F.to_json(F.struct("orderHash", "maker", "makerAmount"))
    js = o.select("page", F.when(F.col("page") % 2 == 0, even).otherwise(odd).alias("value"))
    flows.write_array_pages(js, path)


@register("order_book_snapshot", """
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS orderHash, 'm' || CAST(o_custkey AS VARCHAR) AS maker,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS makerAmount,
       CASE WHEN (o_orderkey // 500) % 2 = 0 THEN o_totalprice / 1000 END AS makerRate
FROM orders""")
def q_order_book_snapshot(spark, sf):
    """Order-book pages (bare arrays, drifting columns) stacked by name."""
    root = run_folder(spark, "order_book", sf)
    _land_order_book(spark, sf, f"{root}/pages")
    return flows.order_book_snapshot(spark, f"{root}/pages", schema=schemas.ORDER_BOOK)


def _land_bridge_pages(spark, sf, path):
    """Bridge transfers as nested transaction documents, one JSON page per
    hour (envelope ``transactions``)."""
    p = B.bridge_pairs(spark, sf)
    iso = flows.ISO_TIME
    tx = p.select(
        X.floor_to("hour", "timestamp").alias("page"),
        F.concat(F.lit("id"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("0xt"), F.col("event_id").cast("string")).alias("txHash"),
        (F.col("user_id") % 40).cast("int").alias("emitterChain"),
        F.lit("0xemitter").alias("emitterAddress"),
        F.col("value").cast("string").alias("tokenAmount"),
        F.date_format("timestamp", iso).alias("timestamp"),
        F.lit("00").alias("payload"),
        F.struct(
            F.struct(F.concat(F.lit("0xo"), F.col("event_id").cast("string")).alias("txHash"),
                     F.lit("confirmed").alias("status"),
                     F.struct(F.lit("wormchain-gateway").alias("type"),
                              F.struct(F.lit(1).alias("originChainId"), F.lit("0xa").alias("originAddress"),
                                       F.lit("0xb").alias("originTxHash")).alias("value")).alias("attribute"))
             .alias("originTx"),
            F.struct(F.date_format("dest_timestamp", iso).alias("timestamp"),
                     ((F.col("user_id") + 7) % 40).cast("int").alias("chainId")).alias("destinationTx"))
         .alias("globalTx"),
        F.struct(((F.col("user_id") + 1) % 40).cast("int").alias("toChain"),
                 ((F.col("user_id") + 2) % 40).cast("int").alias("tokenChain"),
                 (F.col("user_id") % 40).cast("int").alias("fromChain"),
                 F.lit("0xf").alias("fromAddress"), F.lit("0xfee").alias("feeAddress"),
                 F.lit(2).alias("feeChain"), F.col("value").cast("string").alias("amount"),
                 F.lit(8).alias("normalizedDecimals")).alias("standardizedProperties"))
    flows.write_json_pages(tx, path, "transactions", "page")


def _chain_sql(code: str) -> str:
    return f"coalesce((SELECT name FROM codes WHERE code = CAST({code} AS INTEGER)), 'Unknown')"


@register("bridge_transfers", f"""WITH {CODES_SQL}, b AS ({B.BRIDGE_PAIRS_SQL})
SELECT {_chain_sql('user_id % 40')} AS emitterChain, CAST(value AS VARCHAR) AS tokenAmount, timestamp,
       strftime(dest_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS "destinationTx.timestamp",
       CAST((user_id + 7) % 40 AS INTEGER) AS "destinationTx.chainId",
       {_chain_sql('(user_id + 1) % 40')} AS toChain, {_chain_sql('(user_id + 2) % 40')} AS tokenChain, dest_timestamp
FROM b""")
def q_bridge_transfers(spark, sf):
    """L8 first part: nested transaction pages -> flat, chain-named transfers,
    without the dropped columns (P8, P18, P2)."""
    root = run_folder(spark, "bridge_transfers", sf)
    _land_bridge_pages(spark, sf, f"{root}/pages")
    return flows.bridge_transfers(spark, f"{root}/pages", schema=schemas.BRIDGE_PAGE)


@register("bridge_latency_minute", ORACLES["latency_minute"])
def q_bridge_latency_minute(spark, sf):
    """Nested transaction pages -> chain-named transfers -> latency per minute."""
    root = run_folder(spark, "bridge", sf)
    _land_bridge_pages(spark, sf, f"{root}/pages")
    return flows.bridge_latency_minute(spark, f"{root}/pages", schema=schemas.BRIDGE_PAGE)
