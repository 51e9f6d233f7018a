"""Structured Streaming queries over landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import expr as X
from ...session import run_folder
from ...sources import idindex
from ...streaming import ingest as S
from .. import bindings as B
from .. import flows
from ..registry import ORACLES, register


def _await(q) -> None:
    q.awaitTermination()                   # as long as it takes; a failed query raises


@register("stream_ingest", f"""
SELECT CAST(event_id AS VARCHAR) AS id, status, value AS amount,
       epoch_us(ts) // 1000000 AS timestamp, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS DATETIME
FROM (SELECT *, {B.TRANSFER_STATUS} AS status FROM events) WHERE status = 'DONE'""")
def q_stream_ingest(spark, sf):
    """Transfer pages per day, each repeating the previous day's last hour
    (re-delivery across files); streamed with ``availableNow``."""
    root = run_folder(spark, "stream_ingest", sf)
    _land_transfer_pages(spark, sf, f"{root}/in")
    _await(S.ingest_transfers(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt"))
    return S.read_stored(spark, f"{root}/out")


@register("stream_redelivered_null_ids", f"""
SELECT CASE WHEN event_id % 3 > 0 THEN CAST(event_id AS VARCHAR) END AS id, status, CAST(event_id AS DOUBLE) AS amount,
       epoch_us(ts) // 1000000 AS timestamp, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS DATETIME
FROM (SELECT *, {B.TRANSFER_STATUS} AS status FROM events) WHERE status = 'DONE'""")
def q_stream_redelivered_null_ids(spark, sf):
    """A third of the records have no id; every file comes twice, in batches of their own."""
    root = run_folder(spark, "stream_null_ids", sf)
    rec = _transfer_records(spark, sf).drop("h")
    rec = rec.withColumns({"amount": F.col("id").cast("double"), "id": F.when(F.col("id").cast("long") % 3 > 0, F.col("id"))})
    for again in (0, 1):
        flows.write_json_pages(rec.withColumn("page", F.dayofmonth("day") % 3).drop("day"), f"{root}/in/{again}", "transfers", "page", parts=1)
    _await(S.ingest_transfers(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=3))
    return S.read_stored(spark, f"{root}/out")


@register("stream_empty", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS status, value AS amount, epoch_us(ts) // 1000000 AS timestamp, ts AS DATETIME
FROM events WHERE event_type = 'no such status'""")
def q_stream_empty(spark, sf):
    """T1 where no landed transfer is done yet: the stored table reads as an empty one."""
    root = run_folder(spark, "stream_empty", sf)
    rec = _transfer_records(spark, sf).drop("h").withColumn("status", F.lit("PENDING"))
    flows.write_json_pages(rec.withColumnRenamed("day", "page"), f"{root}/in", "transfers", "page")
    _await(S.ingest_transfers(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt"))
    return S.read_stored(spark, f"{root}/out")


@register("stream_latency_minute", f"""WITH b AS ({B.BRIDGE_PAIRS_SQL}),
p AS (SELECT timestamp, epoch_us(dest_timestamp) - epoch_us(timestamp) AS lat FROM b),
mx AS (SELECT max(timestamp) AS t FROM p WHERE lat > 0)
SELECT date_trunc('minute', timestamp) AS minute, sum(CAST(lat AS DOUBLE)) / count(*) / 1e6 AS avg_latency_s,
       count(*) AS transfers
FROM p WHERE lat > 0 GROUP BY 1
HAVING date_trunc('minute', timestamp) + INTERVAL 1 MINUTE <= (SELECT t FROM mx) - INTERVAL 10 MINUTE""")
def q_stream_latency_minute(spark, sf):
    """Bridge pairs landed as parquet, streamed; closed windows only."""
    root = run_folder(spark, "stream_latency", sf)
    pairs = B.bridge_pairs(spark, sf)
    pairs.write.parquet(f"{root}/in")
    src = spark.readStream.schema(pairs.schema).parquet(f"{root}/in")
    q = (S.stream_latency_minute(src).writeStream.format("parquet").option("path", f"{root}/out")
          .option("checkpointLocation", f"{root}/ckpt").outputMode("append").trigger(availableNow=True).start())
    _await(q)
    return spark.read.parquet(f"{root}/out")


@register("stream_backlog", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS orderid FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey)""")
def q_stream_backlog(spark, sf):
    """Candidate ids (one per line item, so ids repeat across files) stream
    a few files per batch against the stored ids, which start as the fulfilled orders."""
    root = run_folder(spark, "stream_backlog", sf)
    lines = B.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("orderid"), "l_linenumber")
    cand = lines.select("orderid")
    for odd in (0, 1):                     # two landings, so at least two batches
        lines.where(F.col("l_linenumber") % 2 == odd).select("orderid").write.mode("append").parquet(f"{root}/in")
    stored0 = (B.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
               .select(F.col("o_orderkey").cast("string").alias("orderid")))
    S.seed_stored(stored0, f"{root}/stored")
    src = spark.readStream.schema(cand.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    _await(S.stream_backlog(src, f"{root}/stored", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/stored").where(F.col("batch_id") >= 0).select("orderid")


@register("stream_backlog_indexed", ORACLES["stream_backlog"])
def q_stream_backlog_indexed(spark, sf):
    """The streaming backlog over an id table in hash buckets, compacted every other batch while it runs."""
    root = run_folder(spark, "stream_backlog_indexed", sf)
    lines = B.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("orderid"), "l_linenumber")
    for part in range(3):
        lines.where(F.col("l_linenumber") % 3 == part).select("orderid").write.mode("append").parquet(f"{root}/in")
    stored0 = B.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("orderid"))
    idindex.create(stored0, f"{root}/ids", "orderid", rows_per_bucket=2000)
    src = spark.readStream.schema("orderid STRING").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    _await(S.stream_backlog_indexed(src, f"{root}/ids", f"{root}/ckpt", rows_per_bucket=2000, compact_every=2))
    return idindex.read(spark, f"{root}/ids").where("batch_id >= 0").select(F.col("id").alias("orderid"))


RESUME_MARK = 1705276800  # 2024-01-15 00:00:00 UTC


def _transfer_records(spark, sf):
    return B.events(spark, sf).select(
        F.col("event_id").cast("string").alias("id"), F.expr(B.TRANSFER_STATUS).alias("status"),
        F.col("value").alias("amount"),
        F.struct(X.ts_to_epoch("ts").alias("timestamp"), F.lit(1).cast("long").alias("chainId")).alias("sending"),
        F.to_date("ts").alias("day"), F.hour("ts").alias("h"))


def _land_transfer_pages(spark, sf, path):
    """Transfer pages per day, each repeating the previous day's last hour
    (re-delivery across files)."""
    rec = _transfer_records(spark, sf)
    again = rec.where(F.col("h") == 23).withColumn("day", F.date_add("day", 1))
    flows.write_json_pages(rec.unionByName(again).drop("h").withColumn("page", F.col("day")),
                           path, "transfers", "page", partition_by="day")


@register("stream_resume", f"""
SELECT CAST(event_id AS VARCHAR) AS id, status, value AS amount,
       epoch_us(ts) // 1000000 AS timestamp, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS DATETIME
FROM (SELECT *, {B.TRANSFER_STATUS} AS status FROM events)
WHERE status = 'DONE' AND epoch_us(ts) // 1000000 > {RESUME_MARK}""")
def q_stream_resume(spark, sf):
    """T4: backfill strictly after a stored mark from slices that land newest
    first, each repeating its neighbour's last hour, one file per micro-batch."""
    root = run_folder(spark, "stream_resume", sf)
    rec = _transfer_records(spark, sf)
    for slice_no in reversed(range(4)):
        day = F.dayofmonth("day")
        own = (day >= 8 * slice_no) & (day < 8 * slice_no + 8)
        again = (day == 8 * slice_no + 8) & (F.col("h") == 0)
        flows.write_json_pages(rec.where(own | again).drop("h").withColumnRenamed("day", "page"),
                               f"{root}/in/slice={slice_no}", "transfers", "page")
    _await(S.resume_history(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", RESUME_MARK))
    return S.read_stored(spark, f"{root}/out")


ACCOUNT_MARK = 1705276800  # 2024-01-15 00:00:00 UTC


@register("stream_accounts", f"""
WITH t AS (SELECT event_id, epoch_us(ts) // 1000000 AS s FROM (SELECT *, {B.TRANSFER_STATUS} AS status FROM events) WHERE status = 'DONE'),
f AS (SELECT *, s < {ACCOUNT_MARK} AND event_id % 5 > 0 AS first FROM t),
m AS (SELECT max(s) AS newest FROM f WHERE first)
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS landed, count(*) AS on_time, CAST(0 AS BIGINT) AS late, CAST(0 AS BIGINT) AS repeated
FROM f WHERE first
UNION ALL
SELECT 1, count(*), count(*) FILTER (NOT first AND s > newest - 600), count(*) FILTER (NOT first AND s <= newest - 600),
       count(*) FILTER (first)
FROM f, m""")
def q_stream_accounts(spark, sf):
    """What became of the landed transfers of two batches; the second one brings
    those of the first again, a fifth of the old ones late, and the new ones."""
    root = run_folder(spark, "stream_accounts", sf)
    rec = _transfer_records(spark, sf).drop("h")
    first = (F.col("sending.timestamp") < ACCOUNT_MARK) & (F.col("id").cast("long") % 5 > 0)
    for name, part in (("a", rec.where(first)), ("b", rec)):
        flows.write_json_pages(part.withColumnRenamed("day", "page"), f"{root}/in/{name}", "transfers", "page")
        _await(S.ingest_transfers(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", accounts=f"{root}/accounts"))
    return S.read_accounts(spark, f"{root}/accounts").select("batch_id", "landed", "on_time", "late", "repeated")


@register("stream_latency_batches", ORACLES["latency_minute"])
def q_stream_latency_batches(spark, sf):
    """T3 over pairs that land out of order, one file per micro-batch: all of them count."""
    root = run_folder(spark, "stream_latency_batches", sf)
    pairs = B.bridge_pairs(spark, sf)
    for k in range(4):
        pairs.where(F.col("event_id") % 4 == 3 - k).write.mode("append").parquet(f"{root}/in")
    src = spark.readStream.schema(pairs.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    _await(S.store_latency(src, f"{root}/out", f"{root}/ckpt"))
    return S.read_latency(spark, f"{root}/out")
