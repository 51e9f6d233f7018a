"""Time-slice coverage of a history walk.

The walk covers ``[end - n*step, end)`` in ``n = floor((end - start) / step)``
whole slices, newest first. Each row is placed in its slice by integer
arithmetic on microseconds — no range join — and the slice grid (whose
size depends on the time range only) is left-joined to the per-slice
counts, so empty slices are reported.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _micros(t) -> int:
    if isinstance(t, str):
        t = datetime.fromisoformat(t)
    if t.tzinfo is None:
        t = t.replace(tzinfo=timezone.utc)
    return int(t.timestamp()) * 1_000_000 + t.microsecond


def _step_micros(step: str) -> int:
    n, unit = step.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit.lower()]
    return int(n) * mult * 1_000_000


def slice_coverage(df: DataFrame, ts: str, start, end, step: str = "5 minutes") -> DataFrame:
    """Rows per slice and whether the slice is empty.

    Columns: ``slice_no`` (1 = newest, the walk order), ``slice_start``,
    ``slice_end`` (half-open), ``rows``, ``is_empty``.
    """
    end_us, step_us = _micros(end), _step_micros(step)
    total = (end_us - _micros(start)) // step_us
    lo_us = end_us - total * step_us
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    kind = df.schema[ts].dataType
    bound = lambda x: F.lit(datetime.fromtimestamp(0, timezone.utc).replace(tzinfo=None) + timedelta(microseconds=x)).cast(kind)
    # The range on the column itself reaches the scan; whole microseconds make it exact.
    counts = (df.where((F.col(ts) >= bound(lo_us)) & (F.col(ts) < bound(end_us))).select(us.alias("__us"))
                .where((F.col("__us") < F.lit(end_us)) & (F.col("__us") >= F.lit(lo_us)))
                .select(F.expr(f"({end_us} - __us + {step_us - 1}) div {step_us}").alias("k"))
                .groupBy("k").agg(F.count(F.lit(1)).alias("rows")))
    spark = df.sparkSession
    grid = spark.range(1, total + 1).select(F.col("id").alias("k"))

    def at(k_expr):
        return F.timestamp_micros(F.lit(end_us) - k_expr * F.lit(step_us)).cast("timestamp_ntz")

    return (grid.join(counts, "k", "left")
                .select(F.col("k").alias("slice_no"),
                        at(F.col("k")).alias("slice_start"), at(F.col("k") - 1).alias("slice_end"),
                        F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNull().alias("is_empty")))

