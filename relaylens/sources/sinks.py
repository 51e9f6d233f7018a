"""Sinks: append, batched append and idempotent batch writes.

Writes go through Spark's file commit protocol, so a lost executor only
re-runs its task and a failed job leaves no partial files behind; errors
are raised, never swallowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_table(df: DataFrame, target: str, fmt: str = "parquet", partition_by=None,
                 table: bool = False) -> None:
    """Append ``df`` to a path (or a catalog table when ``table``)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if table:
        w.saveAsTable(target)
    else:
        w.save(target)


def append_batched(df: DataFrame, target: str, batch_rows: int | None = None,
                   fmt: str = "parquet", even: bool = True) -> None:
    """Append in batches (S9). A task's rows are one batch, and AQE sizes the
    tasks by bytes (``REBALANCE``), so files are few and of even size at any
    scale. ``batch_rows`` (e.g. ``constants.ORDER_BATCH_ROWS``) instead rolls a
    new file after so many rows. ``even=False`` writes the tasks as they are: after a
    join, where AQE has sized them already, it saves a shuffle of all columns."""
    w = (df.hint("rebalance") if even and not batch_rows else df).write.mode("append").format(fmt)
    (w.option("maxRecordsPerFile", batch_rows) if batch_rows else w).save(target)


def write_batch(df: DataFrame, target: str, batch_id: int, fmt: str = "parquet", partition_by=None) -> None:
    """Idempotent write of one micro-batch: the batch owns the directory
    ``batch_id=<n>`` and a replay overwrites it instead of appending twice."""
    w = df.write.mode("overwrite").format(fmt)
    (w.partitionBy(partition_by) if partition_by else w).save(f"{target.rstrip('/')}/batch_id={int(batch_id)}")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a parquet table bucketed and sorted by ``key`` at
    ``path`` and return it read back.

    Two tables bucketed the same way on the join key (same ``buckets``)
    join without a shuffle of either side: use it for tables that are
    joined repeatedly on the order id (event log, order documents,
    stored-id tables).
    """
    (df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def write_for_lookup(df: DataFrame, target: str, key: str, partitions: int | None = None,
                     row_group_bytes: int | None = None, mode: str = "overwrite") -> None:
    """Store ``df`` so that a lookup of one ``key`` reads little (F1).

    Rows are range-partitioned and sorted by the key, so the key's smallest and largest
    value per row group and page tell which to read; a Bloom filter per row group settles
    keys that lie between but are absent. An equality on the stored column
    (``orders.order_lookup``) is pushed down to all three. A key or NULL that holds a large
    share of the rows is split over several ranges by a hash of its rows and of their
    input partition. Appended loads (``mode="append"``) are sorted each by itself: a lookup then
    reads at most one place per load.
    """
    def new(name):
        while name.lower() in {c.lower() for c in df.columns}:
            name += "_"
        return name

    salt = new("__salt")
    # the hash is computed where rows are dealt out; only the partition's number travels with them
    salted = df.withColumn(salt, F.spark_partition_id())
    by = [F.col(f"`{key}`"), F.xxhash64(*[F.col(f"`{c}`") for c in salted.columns])]
    ranged = salted.repartitionByRange(partitions, *by) if partitions else salted.repartitionByRange(*by)
    w = ranged.sortWithinPartitions(f"`{key}`").drop(salt).write.mode(mode)
    w = w.option("parquet.bloom.filter.enabled#" + key, "true")
    (w.option("parquet.block.size", row_group_bytes) if row_group_bytes else w).parquet(target)
