"""Structured Streaming versions of the incremental loads.

* Progress lives in the checkpoint (source offsets + commit log), not in a
  ``max(timestamp)`` query: a restarted query resumes exactly after the
  last committed micro-batch, and a lost executor only re-runs tasks.
* Loads lose nothing, whatever the order of the files: re-delivered records
  are recognised by their id against the stored rows of the same days, and no
  watermark drops what comes late. A batch reads only the stored days that it
  brings.
* Sinks are idempotent: ``foreachBatch`` writers own one ``batch_id=<n>``
  folder each, which a replay overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import constants as K
from ..functions import expr as X
from ..operators.orders import not_stored
from ..sources import idindex
from ..sources.sinks import write_batch
from ..sources.slices import read_declared, values_of

TRANSFER_PAGE = schemas.TRANSFER_PAGE   # DDL text; parsed by the reader


def transfers_stream(spark: SparkSession, in_dir: str, page_schema: T.StructType | str = TRANSFER_PAGE,
                     envelope: str = "transfers", max_files_per_trigger: int | None = None,
                     clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming read of landed transfer pages (one page per line).

    ``clean_source='archive'`` moves processed files to ``archive_dir`` after
    their batch is committed (S10); it is opt-in.
    """
    r = spark.readStream.schema(page_schema).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r.json(in_dir).select(F.inline(F.col(envelope)))


def shape_transfers(df: DataFrame, status: str = K.DONE_STATUS, since_epoch: int | None = None) -> DataFrame:
    """Lift ``sending.timestamp`` (P9), keep ``status`` transfers (F6),
    optionally only those after a mark (F5), add ``DATETIME`` (P23)."""
    out = (df.withColumn("timestamp", F.col("sending.timestamp"))
             .where(X.status_is("status", status)))
    if since_epoch is not None:
        out = out.where(X.newer_than("timestamp", F.lit(since_epoch)))
    return (out.drop("sending")
               .withColumn("DATETIME", X.epoch_to_ts("timestamp")))


def append_new(stream: DataFrame, target: str, checkpoint: str, key: str = "id", ts: str = "DATETIME",
               available_now: bool = True, interval: str = "10 seconds",
               accounts: str | None = None, delay_seconds: int = 600):
    """Append the stream's records that are not stored yet to ``target``, as
    ``batch_id=<n>/day=<date>`` folders (:func:`read_stored` reads them).

    A record is known by its day and ``key``, a record without a key by its day
    and a checksum of all its values, so that one that comes again is not stored
    twice. Of several records of one batch that are known by the same key the one
    with the smallest checksum is stored; a stored record stays. Late and unordered
    records are stored like any other. Stored rows are read with the stream's own
    schema, and only those of the days at hand.

    With ``accounts``, every batch writes one row there: ``landed`` records are
    ``on_time`` + ``late`` (stored, but ``delay_seconds`` or more older than the newest
    record of earlier batches) + ``repeated``. :func:`read_accounts` reads them. A batch
    that is replayed writes its row again in the same place.
    """
    spark = stream.sparkSession
    cols, schema = stream.columns, stored_schema(stream.schema)

    def known(df: DataFrame) -> DataFrame:
        df = df.withColumn("__values", values_of(df, cols))
        return df.withColumn("__known", F.when(F.col(key).isNull(), F.concat(F.lit("values:"), "__values"))
                                         .otherwise(F.concat(F.lit("key:"), F.col(key).cast("string"))))

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = known(batch.withColumn("day", F.to_date(ts))).persist()
        row = F.struct(*(F.col(f"`{c}`") for c in cols))
        new = (batch.groupBy("__known", "day").agg(F.min_by(row, "__values").alias("__row"))
                    .select("__known", "day", "__row.*"))
        days = [r["day"] for r in batch.select("day").distinct().collect()]     # of one micro-batch's files
        stored = known(read_declared(spark, target, schema).where(F.col("batch_id") != F.lit(batch_id))
                       .where(F.col("day").isin([d for d in days if d is not None]) | F.col("day").isNull()))
        stored = stored.select(F.col("__known").alias("__stored"), F.col("day").alias("__day"))
        new = new.join(stored, (new["__known"] == stored["__stored"]) & new["day"].eqNullSafe(stored["__day"]), "left_anti")
        write_batch(new.select(*cols, "day"), target, batch_id, partition_by="day")
        if accounts:
            own = read_declared(spark, target, schema).where(F.col("batch_id") == F.lit(batch_id))
            write_batch(_account(batch, own, read_accounts(spark, accounts), ts, batch_id, delay_seconds), accounts, batch_id)
        batch.unpersist()

    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


ACCOUNTS = "landed BIGINT, on_time BIGINT, late BIGINT, repeated BIGINT, newest TIMESTAMP_NTZ, batch_id BIGINT"


def _account(batch: DataFrame, stored: DataFrame, accounts: DataFrame, ts: str, batch_id: int, delay_seconds: int) -> DataFrame:
    """The account of one batch, counted from the rows that it landed and the rows that it stored."""
    mark = accounts.where(F.col("batch_id") < F.lit(batch_id)).agg(F.max("newest")).first()[0]
    at = F.col(ts).cast("timestamp_ntz")
    limit = F.lit(mark).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(delay_seconds))
    late = F.coalesce(at <= limit, F.lit(False)).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    landed = batch.select(one.alias("landed"), zero.alias("stored"), zero.alias("late"), at.alias("newest"))
    kept = stored.select(zero.alias("landed"), one.alias("stored"), late.alias("late"), at.alias("newest"))
    sums = landed.unionByName(kept).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("landed", "stored", "late")],
                                        F.max("newest").alias("newest"))
    return sums.select("landed", (F.col("stored") - F.col("late")).alias("on_time"), "late",
                       (F.col("landed") - F.col("stored")).alias("repeated"), "newest")


def read_accounts(spark: SparkSession, accounts: str) -> DataFrame:
    """The accounts that :func:`append_new` wrote, a row per batch; empty before the first one."""
    return read_declared(spark, accounts, ACCOUNTS)


def stored_schema(schema: T.StructType) -> T.StructType:
    """Schema of the rows that :func:`append_new` stores, with the folder columns."""
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("day", T.DateType())])


def transfer_schema(spark: SparkSession) -> T.StructType:
    """Schema of the stored transfers of :func:`ingest_transfers`."""
    pages = spark.createDataFrame([], TRANSFER_PAGE)
    return shape_transfers(pages.select(F.inline("transfers"))).schema


def read_stored(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """The records that :func:`append_new` stored, without the folder columns; an empty table where
    nothing is stored yet. ``schema`` is that of the stream (default: shaped transfers)."""
    return read_declared(spark, target, stored_schema(schema or transfer_schema(spark))).drop("batch_id", "day")


def ingest_transfers(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                     available_now: bool = True, interval: str = "10 seconds", since_epoch: int | None = None,
                     max_files_per_trigger: int | None = None, clean_source: str | None = None,
                     archive_dir: str | None = None, accounts: str | None = None, delay_seconds: int = 600):
    """Landed transfer pages -> de-duplicated DONE transfers appended to
    ``out_dir`` (:func:`append_new`; read back with :func:`read_stored`).

    ``available_now=True`` processes everything landed so far and stops
    (tests, backfills); otherwise the query polls every ``interval``.
    ``clean_source`` and ``archive_dir`` clear processed files (S10).
    ``accounts`` names a side table of landed, late and repeated records a batch.
    Returns the started ``StreamingQuery``.
    """
    src = transfers_stream(spark, in_dir, max_files_per_trigger=max_files_per_trigger,
                           clean_source=clean_source, archive_dir=archive_dir)
    return append_new(shape_transfers(src, since_epoch=since_epoch), out_dir, checkpoint,
                      available_now=available_now, interval=interval, accounts=accounts, delay_seconds=delay_seconds)


def resume_history(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, mark_epoch: int,
                   files_per_batch: int = 1, clean_source: str | None = None, archive_dir: str | None = None):
    """T4: backfill slice-named pages strictly after ``mark_epoch``, a few
    files per micro-batch, in whatever order the slices come; rerunning resumes
    from the checkpoint."""
    return ingest_transfers(spark, in_dir, out_dir, checkpoint, since_epoch=mark_epoch,
                            max_files_per_trigger=files_per_batch, clean_source=clean_source, archive_dir=archive_dir)


def store_latency(pairs: DataFrame, target: str, checkpoint: str, start: str = "timestamp",
                  end: str = "dest_timestamp", available_now: bool = True, interval: str = "10 seconds"):
    """T3 without a watermark: every micro-batch adds its sums per minute as
    one ``batch_id=<n>`` folder; :func:`read_latency` merges them. Pairs may
    come in any order and any number of batches."""
    def process(batch: DataFrame, batch_id: int) -> None:
        f = batch.select(X.floor_to("minute", start).alias("minute"), X.latency_micros(start, end).alias("lat_us"))
        sums = (f.where("lat_us > 0 and minute is not null").groupBy("minute")
                 .agg(F.sum("lat_us").alias("lat_us"), F.count(F.lit(1)).alias("transfers")))
        write_batch(sums, target, batch_id)

    w = pairs.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def read_latency(spark: SparkSession, target: str) -> DataFrame:
    """Mean positive latency in seconds and transfers per minute, over all stored batches."""
    g = spark.read.parquet(target).groupBy("minute").agg(F.sum("lat_us").alias("us"), F.sum("transfers").alias("transfers"))
    return g.select("minute", (F.col("us").cast("double") / F.col("transfers") / 1e6).alias("avg_latency_s"), "transfers")


def stream_latency_minute(df: DataFrame, start: str = "timestamp", end: str = "dest_timestamp",
                          delay: str = "10 minutes") -> DataFrame:
    """T3, live: tumbling one-minute mean of positive latency, emitted in
    append mode once the watermark closes the window (state is bounded by
    ``delay``). Pairs that are later than ``delay`` are not counted; use
    :func:`store_latency` where pairs come out of order."""
    lat = X.latency_micros(start, end)
    return (df.select(F.col(start).cast("timestamp").alias("__t"), lat.alias("lat_us"))
              .where(F.col("lat_us") > 0)
              .withWatermark("__t", delay)
              .groupBy(F.window("__t", "1 minute"))
              .agg((F.avg(F.col("lat_us").cast("double")) / 1e6).alias("avg_latency_s"),
                   F.count(F.lit(1)).alias("transfers"))
              .select(F.col("window.start").cast("timestamp_ntz").alias("minute"),
                      "avg_latency_s", "transfers"))


def stream_backlog(candidates: DataFrame, stored_path: str, checkpoint: str, key: str = "orderid",
                   available_now: bool = True, interval: str = "10 seconds"):
    """Stream of candidate ids -> ids not stored yet, appended to the
    stored table itself (``stored_path/batch_id=<n>``).

    Every micro-batch re-reads the stored ids, so ids appended by earlier
    batches of this very query are skipped; the batch's own folder is
    excluded from that read and overwritten, so a replayed batch yields the
    same rows.
    """
    spark = candidates.sparkSession
    schema = spark.read.parquet(stored_path).schema      # once, not by every batch

    def process(batch: DataFrame, batch_id: int) -> None:
        ids = batch.select(key).where(F.col(key).isNotNull()).dropDuplicates([key])
        stored = (spark.read.schema(schema).parquet(stored_path)
                       .where(F.col("batch_id") != F.lit(batch_id)).select(key))
        write_batch(not_stored(ids, stored, key), stored_path, batch_id)

    w = candidates.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def stream_backlog_indexed(candidates: DataFrame, index: str, checkpoint: str, key: str = "orderid",
                           rows_per_bucket: int = 1_000_000, compact_every: int = 100,
                           available_now: bool = True, interval: str = "10 seconds"):
    """T2 on a table of ids in hash buckets (:mod:`sources.idindex`, made by ``idindex.create``): a batch
    reads the buckets of its own ids only. Every ``compact_every`` batches, before it appends, a batch
    compacts the table (``idindex.compact``): it rewrites the newest parts, and the whole table with buckets of
    ``rows_per_bucket`` ids whenever they have grown to half of its base. Read the ids with ``idindex.read``."""
    def process(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            # a replayed batch may have appended already: its ids are then in the rewritten part, brought by itself
            idindex.compact(batch.sparkSession, index, rows_per_bucket)
        idindex.append_new(batch, index, batch_id, key)

    w = candidates.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def seed_stored(df: DataFrame, stored_path: str, key: str = "orderid") -> None:
    """Initial content of a stored-id table (``batch_id=-1``)."""
    write_batch(df.select(key), stored_path, -1)


def compact_stored(spark: SparkSession, stored_path: str, key: str = "orderid") -> int:
    """Compact a stored-id table written by :func:`stream_backlog` into one
    folder; run it while the stream is stopped.

    Crash-safe at every step: the distinct ids are first written to a new
    folder ``batch_id=<lowest - 1>`` (the table is then complete, with
    duplicates), and only afterwards are the older folders deleted. A crash
    at any point leaves a table that still holds every stored id. Returns
    the new folder's batch id.
    """
    stored = spark.read.parquet(stored_path)
    lowest = stored.agg(F.min("batch_id")).first()[0]
    new_id = (lowest if lowest is not None else 0) - 1
    old = [r["batch_id"] for r in stored.select("batch_id").distinct().collect()]   # folder ids only
    write_batch(stored.select(key).where(F.col(key).isNotNull()).dropDuplicates([key]), stored_path, new_id)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for b in old:
        p = jvm.org.apache.hadoop.fs.Path(f"{stored_path.rstrip('/')}/batch_id={int(b)}")
        p.getFileSystem(conf).delete(p, True)
    return new_id
