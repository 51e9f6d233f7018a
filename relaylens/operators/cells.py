"""Packed cells of bounded size (A14): an hour of any size as cells of at most N bytes, in item order.

``shape.pack_events`` collects an hour, or a fixed share of it, into one cell. Here the
cells follow from the data: items are laid out by ranges of (hour, category, item) and
written, every item gets its byte offset within its hour and category (the bytes of the
ranges before it, plus a running sum inside its range), and the offset says which cell the
item is in. No task holds more than a range of items or a cell, however large an hour is.

Equal items are counted before they are laid out, so that one event that comes again
and again is one row; its copies are dealt over cells by arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X
from ..session import run_folder


def packed_items(df: DataFrame, ts: str, id_col: str, cat: str, categories, time_format: str) -> DataFrame:
    """``event_hour, cat, item, n, width``: the distinct items of the known categories, how often
    each comes, and its bytes in a cell, separator included."""
    item = F.concat(F.col(id_col).cast("string"), F.lit(K.PACK_FIELD_SEP), F.date_format(F.col(ts), time_format))
    own = df.select(X.floor_to("hour", ts).alias("event_hour"), F.col(cat).alias("cat"), item.alias("item"))
    own = own.where(F.col("cat").isin([v for v, _ in categories]) & F.col("item").isNotNull())
    return (own.groupBy("event_hour", "cat", "item").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("width", (F.octet_length("item") + F.lit(len(K.PACK_ITEM_SEP))).cast("bigint")))


def with_offsets(items: DataFrame, folder: str, ranges: int | None = None) -> DataFrame:
    """Items with ``at``, the bytes of the items before them in their hour and category.

    The ranges are written to ``folder`` first: a lost executor's ranges are read again as they
    were, and what is summed per range is what the offsets are taken from."""
    keys = [F.col(c) for c in ("event_hour", "cat", "item")]
    ranged = items.repartitionByRange(ranges, *keys) if ranges else items.repartitionByRange(*keys)
    ranged.withColumn("range", F.spark_partition_id()).write.parquet(folder)
    laid = items.sparkSession.read.parquet(folder)
    sizes = laid.groupBy("event_hour", "cat", "range").agg(F.sum(F.col("n") * F.col("width")).alias("bytes"))
    before = Window.partitionBy("event_hour", "cat").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("event_hour", "cat", "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("event_hour", "cat", "range").orderBy("item")
                    .rowsBetween(Window.unboundedPreceding, -1))
    run = F.coalesce(F.sum(F.col("n") * F.col("width")).over(inside), F.lit(0))
    laid = laid.withColumn("run", run).join(starts, ["event_hour", "cat", "range"])
    return laid.select("event_hour", "cat", "item", "n", "width", (F.col("start") + F.col("run")).alias("at"))


def pack_bounded(df: DataFrame, max_bytes: int, ts: str = "evt_block_time", id_col: str = "orderid", cat: str = "chain",
                 categories=K.PACK_CHAINS, time_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS",
                 ranges: int | None = None, ordered: bool = True) -> DataFrame:
    """Hourly packed event log whose cells hold at most ``max_bytes``.

    The columns of ``shape.pack_events``; ``part`` numbers an hour's cells, so that the cells of a
    category, one after the other, are its items in order. A category that has fewer cells than
    another one has ``''`` in the others. ``unpack_events`` reads any number of parts.

    An item lies in cell ``at / (max_bytes - W)``, with W the widest item, so what starts in a cell
    fits into it. ``max_bytes`` under 2 W raises. Rows without an id, a time or a known category
    are in no cell, an hour without items has no row, and an empty table gives no rows.
    """
    items = with_offsets(packed_items(df, ts, id_col, cat, categories, time_format),
                         f"{run_folder(df.sparkSession, 'pack_bounded')}/items", ranges)
    widest = items.agg(F.max("width")).first()[0] or 1
    if max_bytes < 2 * widest:
        raise ValueError(f"cells of {max_bytes} bytes are too small for items of {widest} bytes")
    grid = F.lit(max_bytes - widest)
    last = F.col("at") + (F.col("n") - 1) * F.col("width")
    spread = items.withColumn("part", F.explode(F.sequence(F.expr(f"at div {max_bytes - widest}"), F.floor(last / grid))))

    def copies_before(cell):              # copies of an item that start before a cell does
        gap = F.greatest(cell * grid - F.col("at"), F.lit(0))
        return F.least(F.floor((gap + F.col("width") - 1) / F.col("width")), F.col("n"))

    spread = spread.withColumn("copies", (copies_before(F.col("part") + 1) - copies_before(F.col("part"))).cast("int"))
    spread = spread.withColumn("part", F.col("part").cast("int"))

    def cell(value):
        own = F.sort_array(F.collect_list(F.when(F.col("cat") == value, F.struct("item", "copies"))))
        return F.array_join(F.flatten(F.transform(own, lambda x: F.array_repeat(x["item"], x["copies"]))), K.PACK_ITEM_SEP)

    packed = spread.groupBy("event_hour", "part").agg(*[cell(v).alias(name) for v, name in categories])
    return packed.orderBy("event_hour", "part") if ordered else packed
