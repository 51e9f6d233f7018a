"""The command line runs the workflows end to end in its own process."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from relaylens.operators import fills, orders
from relaylens.plans import bindings as B

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cli(*args):
    env = dict(os.environ)
    env.pop("PYSPARK_GATEWAY_PORT", None)
    r = subprocess.run([sys.executable, "-m", "relaylens", "--master", "local[2]", *args],
                       cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]


def test_cli_pairs_and_fills(spark, tmp_dir):
    docs, events = B.order_docs_view(spark, SF001), B.event_log_view(spark, SF001)
    docs.write.parquet(f"{tmp_dir}/docs")
    events.write.parquet(f"{tmp_dir}/events")
    B.fills_view(spark, SF001).write.option("header", True).csv(f"{tmp_dir}/fills")
    _cli("pairs", "--orders", f"{tmp_dir}/docs", "--events", f"{tmp_dir}/events", "--out", f"{tmp_dir}/pairs")
    _cli("fills", f"{tmp_dir}/fills", "--report", "relayer-fees", "--out", f"{tmp_dir}/fees")
    got = spark.read.parquet(f"{tmp_dir}/pairs").withColumn("avg_price", F.round("avg_price", 6))
    want = orders.pair_analysis(docs, events).withColumn("avg_price", F.round("avg_price", 6))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    fees = spark.read.parquet(f"{tmp_dir}/fees")
    assert fees.exceptAll(fills.relayer_fees(B.fills_view(spark, SF001))).count() == 0
    assert fees.count() > 0


def test_cli_event_log_rerun_appends_nothing(spark, tmp_dir):
    from relaylens.plans import flows
    src = B.source_leg(spark, SF001).select(F.col("orderId").alias("orderid"),
                                            F.col("evt_time").alias("evt_block_time"), "chain")
    dest = B.dest_leg(spark, SF001).select(F.col("orderId").alias("orderid"),
                                           F.col("evt_time").alias("evt_block_time"), "chain")
    flows.write_packed_csv(src, f"{tmp_dir}/src")
    flows.write_packed_csv(dest, f"{tmp_dir}/dest")
    args = ("event-log", "--src", f"{tmp_dir}/src", "--dest", f"{tmp_dir}/dest", "--out", f"{tmp_dir}/log")
    _cli(*args)
    n = spark.read.parquet(f"{tmp_dir}/log").count()
    _cli(*args)
    again = spark.read.parquet(f"{tmp_dir}/log")
    assert n > 0 and again.count() == n and again.select("orderid").distinct().count() == n


def test_cli_other_commands_in_process(spark, tmp_dir):
    """Every remaining subcommand on small landed inputs (same session)."""
    from relaylens.__main__ import parser, run
    from relaylens.plans import flows
    from relaylens.plans import catalog as C
    from relaylens.functions import expr as X

    ev = B.events(spark, SF001)
    docs, events = B.order_docs_view(spark, SF001), B.event_log_view(spark, SF001)
    docs.write.parquet(f"{tmp_dir}/docs")
    events.write.parquet(f"{tmp_dir}/events")
    flows.nest_order_docs(docs).write.text(f"{tmp_dir}/landed_docs")
    bars = ev.groupBy(F.col("event_type").alias("instrument"), X.floor_to("hour", "ts").alias("ts")) \
             .agg(F.max("value").alias("CLOSE"))
    flows.write_price_pages(bars, f"{tmp_dir}/prices")
    rec = ev.select(X.ts_to_epoch("ts").alias("timestamp"), "event_id", "user_id", "value",
                    F.array("event_type").alias("tokens"),
                    F.struct(F.col("value").alias("delta")).alias("token_balance_delta"),
                    X.floor_to("hour", "ts").alias("page"))
    flows.write_json_pages(rec, f"{tmp_dir}/bundles", "data", "page")
    ev.select("event_id", "ts", "event_type", "value").write.option("header", True) \
      .option("timestampNTZFormat", flows.PACK_TIME).csv(f"{tmp_dir}/drop/bundles/2024-01")
    C._land_transfer_pages(spark, SF001, f"{tmp_dir}/transfers")
    C._land_order_book(spark, SF001, f"{tmp_dir}/book")
    C._land_bridge_pages(spark, SF001, f"{tmp_dir}/bridge")
    B.table(spark, SF001, "customer").select("c_custkey", F.col("c_nationkey").alias("code")) \
     .write.parquet(f"{tmp_dir}/customer")

    commands = [
        ["details", "--orders", f"{tmp_dir}/docs", "--events", f"{tmp_dir}/events", "--order-id", "1",
         "--out", f"{tmp_dir}/o_details"],
        ["routes", "--orders", f"{tmp_dir}/docs", "--events", f"{tmp_dir}/events", "--out", f"{tmp_dir}/o_routes"],
        ["order-docs", "--docs", f"{tmp_dir}/landed_docs", "--out", f"{tmp_dir}/o_docs", "--nan-text"],
        ["prices", "--pages", f"{tmp_dir}/prices", "--out", f"{tmp_dir}/o_prices"],
        ["bundles", "--pages", f"{tmp_dir}/bundles", "--since", "1704844800", "--out", f"{tmp_dir}/o_bundles"],
        ["file-drop", "--root", f"{tmp_dir}/drop", "--keyword", "bundles/2024-01",
         "--schema", "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE",
         "--out", f"{tmp_dir}/o_drop"],
        ["transfers", f"{tmp_dir}/transfers", "--out", f"{tmp_dir}/o_transfers",
         "--checkpoint", f"{tmp_dir}/ck_transfers"],
        ["codes", "--table", f"{tmp_dir}/customer", "--columns", "code", "--out", f"{tmp_dir}/o_codes"],
        ["order-book", "--pages", f"{tmp_dir}/book", "--hash", "0x1", "--out", f"{tmp_dir}/o_book"],
        ["bridge", "--pages", f"{tmp_dir}/bridge", "--out", f"{tmp_dir}/o_bridge"],
    ]
    for argv in commands:
        run(parser().parse_args(argv), spark)
        out = argv[argv.index("--out") + 1]
        assert spark.read.parquet(out).count() > 0, argv[0]
    assert spark.read.parquet(f"{tmp_dir}/o_docs").count() == docs.count()
    assert spark.read.parquet(f"{tmp_dir}/o_drop").count() == ev.count()
    assert spark.read.parquet(f"{tmp_dir}/o_book").count() == 1
