"""Derive a k-times larger copy of a test-data directory for scaling checks.

Fact tables (orders, lineitem, events) are repeated k times with their keys
offset per copy, so keys stay unique; dimension tables are copied. Every
table is written as ``files`` parquet files, so scans can split. Usage:
``python tools/replicate.py SRC_DIR OUT_DIR K [FILES]``.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    src, out, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    nfiles = int(sys.argv[4]) if len(sys.argv) > 4 else 16
    from pyspark.sql import functions as F

    from relaylens.session import build_session
    spark = build_session("local[8]", 8)
    offsets = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey"], "events": ["event_id"]}
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in offsets:
            key = offsets[t][0]
            span = spark.read.parquet(f"{src}/{t}.parquet").agg(F.max(key)).first()[0] + 1
            df = (df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
                    .withColumn(key, F.col(key) + F.col("copy") * span).drop("copy"))
        df.repartition(nfiles).write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
