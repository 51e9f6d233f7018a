"""Event-table queries: packing, lookups, pages, gap fill, coverage, marks,
bridge latency."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import constants as K
from ...functions import expr as X
from ...operators import bridge, cells, marks, shape, timeseries
from ...session import run_folder
from ...sources.coverage import slice_coverage
from .. import bindings as B
from ..registry import register


PACK_START, PACK_END = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
ITEM_SQL = "CAST(event_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
IN_PACK_RANGE = f"ts >= TIMESTAMP '{PACK_START}' AND ts < TIMESTAMP '{PACK_END}'"


def _packed(spark, sf, start=None, end=None, parts=1):
    ev = B.events(spark, sf).select(F.col("event_id").alias("orderid"), F.col("ts").alias("evt_block_time"),
                                    F.col("event_type").alias("chain"))
    return shape.pack_events(ev, categories=B.EVENT_CATEGORIES, start=start, end=end, parts=parts)


_PACK_COLS = ",\n  ".join(
    f"coalesce(string_agg(CASE WHEN event_type = '{v}' THEN item END, ', ' ORDER BY item), '') AS {n}"
    for v, n in B.EVENT_CATEGORIES)


@register("events_packed", f"""
SELECT date_trunc('hour', ts) AS event_hour, 0 AS part,
  {_PACK_COLS}
FROM (SELECT ts, event_type, {ITEM_SQL} AS item FROM events WHERE {IN_PACK_RANGE})
GROUP BY 1""")
def q_events_packed(spark, sf):
    """Hourly packed event log by event type."""
    return _packed(spark, sf, PACK_START, PACK_END)


@register("events_unpacked", f"""
SELECT CAST(event_id AS VARCHAR) AS orderId, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS evt_time,
       upper(event_type) AS chain
FROM events""")
def q_events_unpacked(spark, sf):
    """Round trip over all events: packed cells (every hour over 16 rows) back
    to one row per event (U1, F10)."""
    return shape.unpack_events(_packed(spark, sf, parts=16))


CELL_BYTES = 4096
#: Half of all events in one hour, and every fifth event three times.
HOT_HOUR_SQL = f"""hot AS (
  SELECT *, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-01-10' + (ts - date_trunc('hour', ts)) ELSE ts END AS t
  FROM events, unnest(range(CASE WHEN event_id % 5 = 0 THEN 3 ELSE 1 END)) AS r(copy)),
items AS (SELECT date_trunc('hour', t) AS event_hour, event_type,
                 CAST(event_id AS VARCHAR) || '-' || strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS item FROM hot),
placed AS (SELECT *, coalesce(sum(strlen(item) + 2) OVER (PARTITION BY event_hour, event_type ORDER BY item
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM items)"""


def _hot_hour(spark, sf):
    ev = B.events(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("event_id") % 5 == 0, 3).otherwise(1))))
    hot = F.lit("2024-01-10").cast("timestamp_ntz") + (F.col("ts") - X.floor_to("hour", "ts"))
    return ev.select(F.col("event_id").alias("orderid"), F.col("event_type").alias("chain"),
                     F.when(F.col("event_id") % 2 == 0, hot).otherwise(F.col("ts")).alias("evt_block_time"))


@register("events_packed_bounded", f"""WITH {HOT_HOUR_SQL}
SELECT event_hour, CAST(pos // ({CELL_BYTES} - (SELECT max(strlen(item)) + 2 FROM items)) AS INTEGER) AS part,
  {_PACK_COLS}
FROM placed GROUP BY 1, 2""")
def q_events_packed_bounded(spark, sf):
    """Packed event log in cells of at most 4096 bytes, in item order, with half of all events in one hour."""
    return cells.pack_bounded(_hot_hour(spark, sf), CELL_BYTES, categories=B.EVENT_CATEGORIES)


@register("events_bounded_unpacked", f"""WITH {HOT_HOUR_SQL}
SELECT CAST(event_id AS VARCHAR) AS orderId, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS evt_time, upper(event_type) AS chain FROM hot""")
def q_events_bounded_unpacked(spark, sf):
    """The bounded cells back to one row per event, repeats included."""
    return shape.unpack_events(cells.pack_bounded(_hot_hour(spark, sf), CELL_BYTES, categories=B.EVENT_CATEGORIES, ordered=False))


CODES_SQL = "codes(code, name) AS (VALUES " + ", ".join(
    f"({k}, '{v}')" for k, v in sorted(K.CHAIN_CODES.items())) + ")"


@register("map_codes", f"""WITH {CODES_SQL},
c AS (SELECT c_custkey, c_nationkey AS emitterChain, CAST(c_custkey % 40 AS INTEGER) AS toChain,
             c_nationkey + 10 AS tokenChain FROM customer)
SELECT c.c_custkey, coalesce(a.name, 'Unknown') AS emitterChain, coalesce(b.name, 'Unknown') AS toChain,
       coalesce(t.name, 'Unknown') AS tokenChain
FROM c LEFT JOIN codes a ON a.code = c.emitterChain LEFT JOIN codes b ON b.code = c.toChain
       LEFT JOIN codes t ON t.code = c.tokenChain""")
def q_map_codes(spark, sf):
    """Customer chain ids mapped to names, unknown ids 'Unknown' (P18)."""
    c = B.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("emitterChain"),
        (F.col("c_custkey") % 40).cast("int").alias("toChain"),
        (F.col("c_nationkey") + 10).alias("tokenChain"))
    return bridge.map_codes(c, ["emitterChain", "toChain", "tokenChain"])


BAD_CODES = {5: "'abc'", 7: "'99999999999'", 11: "NULL", 13: "''"}
TEXT_CODE = "CASE c_custkey % 17 " + " ".join(f"WHEN {k} THEN {v}" for k, v in BAD_CODES.items()) + \
    " ELSE CAST(c_custkey % 40 AS STRING) END"


@register("map_codes_text", f"""WITH {CODES_SQL},
c AS (SELECT c_custkey, {TEXT_CODE} AS code_text, CAST(c_custkey AS BIGINT) * 4294967296 + c_custkey % 40 AS wide FROM customer)
SELECT c.c_custkey, coalesce(a.name, 'Unknown') AS code_text, coalesce(b.name, 'Unknown') AS wide
FROM c LEFT JOIN codes a ON a.code = TRY_CAST(c.code_text AS INTEGER)
       LEFT JOIN codes b ON b.code = TRY_CAST(c.wide AS INTEGER)""")
def q_map_codes_text(spark, sf):
    """Codes as text, some unparsable, missing or too wide: 'Unknown' (P18)."""
    c = B.table(spark, sf, "customer").select(
        "c_custkey", F.expr(TEXT_CODE).alias("code_text"),
        (F.col("c_custkey").cast("bigint") * 4294967296 + F.col("c_custkey") % 40).alias("wide"))
    return bridge.map_codes(c, ["code_text", "wide"])


@register("map_codes_dim", """
SELECT c_custkey, coalesce(a.n_name, 'Unknown') AS emitterChain, coalesce(b.n_name, 'Unknown') AS toChain
FROM customer LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = c_custkey % 40""")
def q_map_codes_dim(spark, sf):
    """Customer chain ids looked up in a dimension table."""
    c = B.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("emitterChain"),
                                              (F.col("c_custkey") % 40).alias("toChain"))
    return bridge.map_codes(c, ["emitterChain", "toChain"], dim=B.table(spark, sf, "nation"),
                            code="n_nationkey", name="n_name")


@register("json_field", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_field(spark, sf):
    """Nested field of a JSON text column, declared schema."""
    ev = B.events(spark, sf)
    return ev.select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"))


@register("json_props_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def q_json_props_flatten(spark, sf):
    """Event properties kept as JSON text, schema inferred over all rows and
    flattened (drift mode)."""
    return shape.flatten_json_column(B.events(spark, sf).select("event_id", "props"), "props")


PAGE_A_END, PAGE_B_START = "2024-01-16 00:00:00", "2024-01-14 00:00:00"


def _pages(spark, sf):
    ev = B.events(spark, sf)
    a = ev.where(F.col("ts") < F.lit(PAGE_A_END).cast("timestamp_ntz"))
    b = ev.where(F.col("ts") >= F.lit(PAGE_B_START).cast("timestamp_ntz"))
    return a, b


@register("union_pages", f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts < TIMESTAMP '{PAGE_A_END}'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, NULL AS props FROM events WHERE ts >= TIMESTAMP '{PAGE_B_START}'""")
def q_union_pages(spark, sf):
    """Two overlapping pages stacked by name, one lacking a column."""
    a, b = _pages(spark, sf)
    return shape.union_by_name([a, b.drop("props")])


@register("dedupe_rows", f"""
SELECT DISTINCT * FROM (
  SELECT * FROM events WHERE ts < TIMESTAMP '{PAGE_A_END}'
  UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '{PAGE_B_START}')""")
def q_dedupe_rows(spark, sf):
    """Overlapping pages stacked and de-duplicated."""
    a, b = _pages(spark, sf)
    return shape.dedupe_rows(shape.union_by_name([a, b]))


@register("gap_fill", """WITH bars AS (
  SELECT event_type, date_trunc('hour', ts) AS event_hour, max(value) AS high, count(*) AS n
  FROM events GROUP BY 1, 2),
bnd AS (SELECT event_type, min(event_hour) AS lo, max(event_hour) AS hi FROM bars GROUP BY 1),
grid AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS event_hour FROM bnd)
SELECT g.event_type, g.event_hour,
  last_value(b.high IGNORE NULLS) OVER (PARTITION BY g.event_type ORDER BY g.event_hour
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high,
  coalesce(b.n, 0) AS n, b.n IS NULL AS filled
FROM grid g LEFT JOIN bars b ON b.event_type = g.event_type AND b.event_hour = g.event_hour""")
def q_gap_fill(spark, sf):
    """Hourly bars per event type with gaps forward-filled (U4)."""
    bars = (B.events(spark, sf)
            .groupBy("event_type", X.floor_to("hour", "ts").alias("event_hour"))
            .agg(F.max("value").alias("high"), F.count(F.lit(1)).alias("n")))
    return timeseries.gap_fill(bars, "event_hour", "event_type", carry="high", zero="n", step="1 hour")


@register("gap_fill_irregular", """WITH bars AS (
  SELECT event_type, make_timestamp(epoch_us(ts) // 600000000 * 600000000) AS bucket, ts, value, event_id FROM events),
last AS (SELECT event_type, bucket, arg_max(value, ts) AS value
         FROM (SELECT event_type, bucket, ts, max(value) AS value FROM bars GROUP BY 1, 2, 3) GROUP BY 1, 2),
bnd AS (SELECT event_type, min(bucket) AS lo, max(bucket) AS hi FROM last GROUP BY 1),
grid AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 10 MINUTE)) AS ts FROM bnd)
SELECT g.event_type, g.ts,
  last_value(b.value IGNORE NULLS) OVER (PARTITION BY g.event_type ORDER BY g.ts
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
  b.bucket IS NULL AS filled
FROM grid g LEFT JOIN last b ON b.event_type = g.event_type AND b.bucket = g.ts""")
def q_gap_fill_irregular(spark, sf):
    """Every event as a bar off the grid, several to a bucket and some revised
    (two values at one time): the latest of each 10 minutes, gaps filled (U4)."""
    return timeseries.gap_fill(B.events(spark, sf).select("event_type", "ts", "value"), "ts", "event_type",
                               carry="value", step="10 minutes")


SLICE_START, SLICE_END, SLICE_STEP_S = "2024-01-01 00:00:00", "2024-01-31 00:00:00", 300


@register("slice_coverage", f"""WITH p AS (
  SELECT epoch_us(TIMESTAMP '{SLICE_END}') AS end_us, {SLICE_STEP_S} * 1000000 AS step_us,
         (epoch_us(TIMESTAMP '{SLICE_END}') - epoch_us(TIMESTAMP '{SLICE_START}')) // ({SLICE_STEP_S} * 1000000) AS total),
k AS (SELECT range AS k FROM range(1, (SELECT total FROM p) + 1)),
c AS (SELECT (p.end_us - epoch_us(ts) + p.step_us - 1) // p.step_us AS k, count(*) AS n
      FROM events, p WHERE epoch_us(ts) < p.end_us AND epoch_us(ts) >= p.end_us - p.total * p.step_us GROUP BY 1)
SELECT k.k AS slice_no, make_timestamp(p.end_us - k.k * p.step_us) AS slice_start,
       make_timestamp(p.end_us - (k.k - 1) * p.step_us) AS slice_end,
       coalesce(c.n, 0) AS rows, c.n IS NULL AS is_empty
FROM k CROSS JOIN p LEFT JOIN c ON c.k = k.k""")
def q_slice_coverage(spark, sf):
    """Rows and empty flag per 5-minute slice of the month."""
    return slice_coverage(B.events(spark, sf), "ts", SLICE_START, SLICE_END, f"{SLICE_STEP_S} seconds")


MARK = "2024-01-15 12:00:00"


@register("since_watermark", f"SELECT * FROM events WHERE ts > TIMESTAMP '{MARK}'")
def q_since_watermark(spark, sf):
    """Rows strictly newer than a mark."""
    return marks.since(B.events(spark, sf), "ts", MARK)


@register("high_water_mark", """
SELECT event_type, max(ts) AS high_water_mark, min(ts) AS low_water_mark, count(*) AS rows
FROM events GROUP BY 1""")
def q_high_water_mark(spark, sf):
    """Newest and oldest time and row count per event type."""
    return marks.high_water_mark(B.events(spark, sf), "ts", by=["event_type"])


@register("observed_rows", """
SELECT event_type, count(*) AS rows, (SELECT count(*) FROM events) AS observed FROM events GROUP BY 1""")
def q_observed_rows(spark, sf):
    """Rows per type beside the row count that an observation saw during a write."""
    ev, seen = marks.with_row_count(B.events(spark, sf).select("event_type"), "rows")
    folder = run_folder(spark, "observed_rows", sf)
    ev.write.parquet(folder)
    per = spark.read.parquet(folder).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    return per.withColumn("observed", F.lit(seen.get["rows"]).cast("bigint"))


@register("epoch_roundtrip", """
SELECT event_id, epoch_us(ts) // 1000000 AS epoch_s, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts_second
FROM events""")
def q_epoch_roundtrip(spark, sf):
    """Timestamp -> epoch seconds -> timestamp."""
    ev = B.events(spark, sf).select("event_id", X.ts_to_epoch("ts").alias("epoch_s"))
    return ev.withColumn("ts_second", X.epoch_to_ts("epoch_s"))


@register("status_filter", f"""
SELECT event_id, ts, user_id, value, status FROM (
  SELECT *, {B.TRANSFER_STATUS} AS status FROM events) WHERE status = 'DONE'""")
def q_status_filter(spark, sf):
    """Transfers with status DONE."""
    t = B.events(spark, sf).select("event_id", "ts", "user_id", "value",
                                   F.expr(B.TRANSFER_STATUS).alias("status"))
    return t.where(X.status_is("status"))


@register("latency_minute", f"""WITH b AS ({B.BRIDGE_PAIRS_SQL})
SELECT date_trunc('minute', timestamp) AS minute,
       sum(CAST(epoch_us(dest_timestamp) - epoch_us(timestamp) AS DOUBLE)) / count(*) / 1e6 AS avg_latency_s,
       count(*) AS transfers
FROM b WHERE epoch_us(dest_timestamp) - epoch_us(timestamp) > 0 GROUP BY 1""")
def q_latency_minute(spark, sf):
    """Mean positive bridge latency per source minute."""
    return bridge.latency_minute(B.bridge_pairs(spark, sf))
