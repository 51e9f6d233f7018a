"""Regular time series: gap filling of per-key bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_UNIT_US = {"microsecond": 1, "microseconds": 1, "second": 1_000_000, "seconds": 1_000_000,
            "minute": 60_000_000, "minutes": 60_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
            "day": 86_400_000_000, "days": 86_400_000_000}


def _micros(span: str) -> int:
    n, unit = span.split()
    return int(n) * _UNIT_US[unit.lower()]


#: Rows for every bar up to which a series may be filled at a step found in the data.
MAX_GROWTH = 1000
#: Buckets that a gap is exploded by at a time.
CHUNK = 4096


def infer_step(df: DataFrame, ts: str, keys) -> str | None:
    """The most frequent distance between consecutive bars of a key on one day (of equally frequent
    ones the smallest), as ``"<n> microseconds"`` (``None`` if no day of a key has two bars). Bars off
    the grid and revisions a moment later change it as little as they are few."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    by = Window.partitionBy(*_list(keys), "__day").orderBy("__us")
    gaps = (df.where(F.col(ts).isNotNull()).select(*_list(keys), us.alias("__us"), F.to_date(ts).alias("__day"))
              .select((F.col("__us") - F.lag("__us").over(by)).alias("gap")).where("gap > 0"))
    most = gaps.groupBy("gap").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "gap").first()
    return f"{most['gap']} microseconds" if most else None


def filled_growth(df: DataFrame, ts: str, keys, step: str) -> tuple[int, int]:
    """(bars, rows that :func:`gap_fill` makes of them), from the first and last bar of each key."""
    us, step_us = F.unix_micros(F.col(ts).cast("timestamp")), _micros(step)
    ends = (df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*_list(keys), ts]])).groupBy(*_list(keys))
              .agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi")))
    bucket = lambda c: F.expr(f"({c} - pmod({c}, {step_us}L)) div {step_us}L")
    row = ends.agg(F.sum("n").alias("n"), F.sum(bucket("hi") - bucket("lo") + 1).alias("rows")).first()
    return row["n"] or 0, row["rows"] or 0


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def gap_fill(df: DataFrame, ts: str, keys, carry, zero=(), step: str | None = None,
             block: str = "1 day", max_growth: int | None = None) -> DataFrame:
    """Complete a per-key series at a fixed ``step`` (U4).

    A bar belongs to the bucket ``floor(ts / step)`` of the UTC epoch and gets
    the bucket's start as its time. Of several bars in a bucket the latest
    counts, of revisions with the same time the one that compares largest.
    Without ``step`` it is the most frequent distance between bars (``infer_step``),
    so that every bar of a regular series keeps its own bucket and a bar off the
    grid falls into the bucket that it lies in.

    Raises if the result would have more than ``max_growth`` rows for every bar
    (not checked unless given or, at ``MAX_GROWTH``, if the step was found in the
    data: sparse bars at a fine step would fill without end).

    For each key the result runs from its first to its last bucket; ``carry``
    columns take the last known value (forward fill), ``zero`` columns become 0
    and ``filled`` marks generated buckets. Rows with a NULL key or time are
    dropped.

    One scan and one shuffle of the bars, by (key, ``block``): a task never
    holds a key's whole history. A bar is exploded up to the next one; the last
    bar of a block gets the next block's first bucket, and values carried into
    a block, from the small per-key block table.
    """
    keys, carry, zero = _list(keys), _list(carry), _list(zero)
    if step is None:
        step, max_growth = infer_step(df, ts, keys) or block, max_growth or MAX_GROWTH
    if max_growth is not None:
        bars, rows = filled_growth(df, ts, keys, step)
        if rows > max_growth * bars:
            raise ValueError(f"{bars} bars would be filled to {rows} rows at a step of {step}: give a coarser step, or max_growth")
    step_us, block_us = _micros(step), max(_micros(block), _micros(step))
    df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys + [ts]]))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    bars = (df.select(*keys, *dict.fromkeys(carry + zero), us.alias("__us"))
              .withColumn("__i", F.expr(f"(__us - pmod(__us, {step_us}L)) div {step_us}L"))
              .withColumn("__b", F.expr(f"(__us - pmod(__us, {block_us}L)) div {block_us}L"))
              .repartition(*keys, "__b"))
    inside = Window.partitionBy(*keys, "__b").orderBy("__us", *dict.fromkeys(carry + zero))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    bars = bars.select(*keys, "__b", "__i", F.lead("__i").over(inside).alias("__next"),
                       F.min("__i").over(upto).alias("__first"), *[F.col(c).alias(f"__zero_{c}") for c in zero],
                       *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in carry])
    bars = bars.where("__next is null or __next <> __i")

    across = Window.partitionBy(*keys).orderBy("__b")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = bars.where("__next is null").select(
        *keys, "__b", F.lead("__first").over(across).alias("__resume"),
        *[F.last(c, ignorenulls=True).over(before).alias(f"__in_{c}") for c in carry])
    out = bars.join(ends, keys + ["__b"], "left")
    until = F.coalesce("__next", "__resume", F.col("__i") + 1)
    # a long gap is exploded by chunks, so that no row holds all its buckets
    out = out.select(*keys, "__i", until.alias("__until"), *[F.coalesce(F.col(c), F.col(f"__in_{c}")).alias(c) for c in carry],
                     *[f"__zero_{c}" for c in zero],
                     F.explode(F.expr(f"sequence(0L, (coalesce(__next, __resume, __i + 1) - 1 - __i) div {CHUNK}L)")).alias("__chunk"))
    lo = F.col("__i") + F.col("__chunk") * CHUNK
    out = out.withColumn("__j", F.explode(F.sequence(lo, F.least(F.col("__until") - 1, lo + (CHUNK - 1)))))
    filled = F.col("__j") != F.col("__i")
    return out.select(*keys, F.timestamp_micros(F.col("__j") * step_us).cast(df.schema[ts].dataType).alias(ts), *carry,
                      *[F.when(filled, F.lit(0)).otherwise(F.coalesce(F.col(f"__zero_{c}"), F.lit(0))).alias(c) for c in zero],
                      filled.alias("filled"))
