"""Command line: ``python -m relaylens <command> ...``.

One command per workflow. Inputs are landed files or parquet tables,
outputs are parquet folders (appended for the incremental loads, replaced
for reports). Spark settings come from the environment (``spark-submit``
/ ``spark-defaults.conf``); the session is only given the relaylens SQL
settings.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .operators import bridge, fills, marks, orders
from .plans import flows
from .session import ensure_settings
from .sources import sinks

FILL_REPORTS = {
    "latency": fills.latency_daily,
    "fee": fills.fee_daily,
    "fee-pct": fills.fee_pct_daily,
    "volume-token": lambda df: fills.volume_by(df, "token_symbol"),
    "volume-chain": lambda df: fills.volume_by(df, "src_chain"),
    "relayer-fees": fills.relayer_fees,
    "relayer-yield": fills.relayer_yield,
    "token-share": fills.token_share,
}


def _replace(df, out: str) -> None:
    df.write.mode("overwrite").parquet(out)


def _stored(spark: SparkSession, path: str | None, key: str):
    """The stored ids, ``None`` where nothing is stored yet."""
    return spark.read.parquet(path).select(key) if path and marks.stored_exists(spark, path) else None


def run(args, spark: SparkSession) -> None:
    c = args.command
    if c == "event-log":
        stored = _stored(spark, args.stored or args.out, "orderid")
        flows.event_log_build(spark, args.src, args.dest, stored, target=args.out)
    elif c == "order-docs":
        stored = _stored(spark, args.stored or args.out, "orderid")
        flows.order_detail_load(spark, args.docs, stored, target=args.out,
                                null_text="nan" if args.nan_text else None)
    elif c in ("pairs", "routes"):
        docs, events = spark.read.parquet(args.orders), spark.read.parquet(args.events)
        fn = orders.pair_analysis if c == "pairs" else orders.chain_analysis
        _replace(fn(docs, events, sentinel_mode=args.sentinel_mode), args.out)
    elif c == "details":
        d = orders.order_details(spark.read.parquet(args.orders), spark.read.parquet(args.events))
        _replace(orders.order_lookup(d, args.order_id) if args.order_id else d, args.out)
    elif c == "fills":
        _replace(FILL_REPORTS[args.report](flows.read_fill_exports(spark, args.inputs)), args.out)
    elif c == "prices":
        flows.price_history(spark, args.pages, step=args.step, target=args.out)
    elif c == "file-drop":
        if args.journal or args.clean:
            from .sources import drops
            drops.load_drop(spark, args.root, args.keyword, args.out, args.schema, timestamp_format=flows.PACK_TIME, clean=args.clean)
        else:
            flows.file_drop_aggregate(spark, args.root, args.keyword, args.schema, target=args.out)
    elif c == "bundles":
        if args.since is None:
            flows.resume_bundles(spark, args.pages, args.out)
        else:
            sinks.append_table(flows.bundle_history(spark, args.pages, args.since), args.out)
    elif c == "transfers":
        from .streaming import ingest
        q = ingest.ingest_transfers(spark, args.inputs, args.out, args.checkpoint,
                                    available_now=not args.continuous, since_epoch=args.since,
                                    clean_source=args.clean_source, archive_dir=args.archive_dir)
        q.awaitTermination()
    elif c == "order-book":
        _replace(flows.order_book_snapshot(spark, args.pages, order_hash=args.hash), args.out)
    elif c == "bridge":
        _replace(flows.bridge_latency_minute(spark, args.pages), args.out)
    elif c == "codes":
        _replace(bridge.map_codes(spark.read.parquet(args.table), args.columns), args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m relaylens", description=__doc__.split("\n\n")[0])
    p.add_argument("--master", help="Spark master when not run through spark-submit (default local[*])")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("event-log", help="packed source/destination CSV exports -> new aligned events")
    s.add_argument("--src", required=True)
    s.add_argument("--dest", required=True)
    s.add_argument("--stored", help="stored event log (default: --out)")
    s.add_argument("--out", required=True)

    s = sub.add_parser("order-docs", help="landed order documents -> new flattened text rows")
    s.add_argument("--docs", required=True)
    s.add_argument("--stored", help="stored order table (default: --out)")
    s.add_argument("--out", required=True)
    s.add_argument("--nan-text", action="store_true", help="write missing values as 'nan'")

    for name in ("pairs", "routes"):
        s = sub.add_parser(name, help=f"per-{name[:-1]} summary of orders and their events")
        s.add_argument("--orders", required=True)
        s.add_argument("--events", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--sentinel-mode", action="store_true", help="literal = 'nan' test")

    s = sub.add_parser("details", help="30-column order detail, optionally one order")
    s.add_argument("--orders", required=True)
    s.add_argument("--events", required=True)
    s.add_argument("--order-id")
    s.add_argument("--out", required=True)

    s = sub.add_parser("fills", help="reports over fill CSV exports")
    s.add_argument("inputs", nargs="+")
    s.add_argument("--report", choices=sorted(FILL_REPORTS), required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("prices", help="price pages -> de-duplicated, gap-filled series")
    s.add_argument("--pages", required=True)
    s.add_argument("--step", help="bar distance (default: the most frequent one of the data)")
    s.add_argument("--out", required=True)

    s = sub.add_parser("file-drop", help="listing -> keyword selection -> CSV union")
    s.add_argument("--root", required=True)
    s.add_argument("--keyword", required=True)
    s.add_argument("--schema", help="DDL of declared column types")
    s.add_argument("--out", required=True)
    s.add_argument("--journal", action="store_true", help="load only files that are not loaded yet (needs --schema)")
    s.add_argument("--clean", action="store_true", help="the same, and delete files that are loaded")

    s = sub.add_parser("bundles", help="bundle pages after a mark")
    s.add_argument("--pages", required=True)
    s.add_argument("--since", type=int, help="epoch seconds (exclusive; default: all that are not stored yet)")
    s.add_argument("--out", required=True)

    s = sub.add_parser("transfers", help="incremental transfer stream")
    s.add_argument("inputs")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--since", type=int)
    s.add_argument("--clean-source", choices=("archive", "delete"), help="clear processed files")
    s.add_argument("--archive-dir", help="folder for --clean-source archive")
    s.add_argument("--continuous", action="store_true", help="poll every 10 s instead of stopping")

    s = sub.add_parser("order-book", help="order-book pages -> snapshot")
    s.add_argument("--pages", required=True)
    s.add_argument("--hash")
    s.add_argument("--out", required=True)

    s = sub.add_parser("bridge", help="bridge transaction pages -> latency per minute")
    s.add_argument("--pages", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("codes", help="chain ids -> names in the given columns")
    s.add_argument("--table", required=True)
    s.add_argument("--columns", nargs="+", required=True)
    s.add_argument("--out", required=True)
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"relaylens-{args.command}")
    # Under spark-submit the JVM (and its master) already exists; run as a
    # plain script, default to --master or all local cores.
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        builder = builder.master(args.master or "local[*]")
    spark = ensure_settings(builder.getOrCreate())
    try:
        run(args, spark)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
