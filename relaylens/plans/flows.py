"""Multi-step flows (L1–L8): landed files -> shaped tables.

Each flow is a function of file locations and DataFrames; the ``write_*``
helpers land test inputs *derived by Spark from the driver tables* in the
shared checkpoint folder, in the formats the flows consume (packed CSV,
nested JSON documents, JSON pages, drifting CSV sets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import expr as X
from ..operators import bridge, marks, orders, shape, timeseries
from ..sources import files, sinks, slices

PACK_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DOCS_PER_FILE = 250_000


def _observe(df: DataFrame, metrics: dict | None, name: str) -> DataFrame:
    """Attach a row count (A15) that is filled by the first action on the
    result, without an extra job; read ``metrics[name].get`` afterwards."""
    if metrics is None:
        return df
    df, obs = marks.with_row_count(df, name)
    metrics[name] = obs
    return df


def _packed_schema(categories) -> T.StructType:
    return T.StructType([T.StructField("event_hour", T.TimestampNTZType()),
                         T.StructField("part", T.IntegerType())]
                        + [T.StructField(n, T.StringType()) for _, n in categories])


# ------------------------------------------------------------- L1 event log
def write_packed_csv(events: DataFrame, path: str, categories=K.PACK_CHAINS, parts: int = 8) -> None:
    """Land an hourly packed event export (``orderid, evt_block_time, chain``
    rows in) as header CSV, every hour over ``parts`` rows."""
    packed = shape.pack_events(events, categories=categories, parts=parts, ordered=False)
    (packed.write.option("header", True).option("timestampNTZFormat", PACK_TIME)
           .mode("overwrite").csv(path))


def event_log_build(spark: SparkSession, src_csv: str, dest_csv: str, processed: DataFrame | None = None,
                    target: str | None = None, categories=K.PACK_CHAINS,
                    metrics: dict | None = None, time_format: str | None = None) -> DataFrame:
    """Packed source/destination exports -> aligned event log of orders not
    stored yet (L1: S1×2 → U1×2 → J2 → P3 → J3 → S7).

    With the ``time_format`` of the items (``PACK_TIME`` for this library's exports) the legs
    are reduced by hash aggregates, and a time in another form fails the job. Without
    it times are compared as text, whatever their form.

    With a ``metrics`` dict, ``aligned_rows``, ``new_rows`` and the legs'
    duplicate-id counts are registered in it as observations (A15)."""
    schema = _packed_schema(categories)
    src = shape.unpack_events(files.read_csv(spark, src_csv, schema, timestamp_format=PACK_TIME))
    dest = shape.unpack_events(files.read_csv(spark, dest_csv, schema, timestamp_format=PACK_TIME))
    chains = [name for _, name in categories] if time_format else None
    aligned = orders.align_legs(src, dest, metrics=metrics, chains=chains, time_format=time_format)
    aligned = shape.rename_positional(aligned, list(orders.EVENT_COLUMNS))
    aligned = _observe(aligned, metrics, "aligned_rows")
    new = orders.backlog(aligned, processed, "orderid") if processed is not None else aligned
    new = _observe(new, metrics, "new_rows")
    if target:
        sinks.append_table(new, target)
    return new


# ------------------------------------------------------ fill exports (CSV)
def read_fill_exports(spark: SparkSession, paths, schema=None) -> DataFrame:
    """Several fill exports (header CSV) as one DataFrame: one scan over
    all files is the union (S1 + U2). Default schema: ``schemas.FILLS``."""
    from .. import schemas
    return files.read_csv(spark, list(paths), schema or schemas.FILLS)


# --------------------------------------------------------- L2 order documents
def _sv(c: str) -> F.Column:
    return F.struct(F.col(c).alias("stringValue"))


def _meta(prefix: str) -> F.Column:
    return F.struct(
        _sv(f"{prefix}_finalAmount").alias("finalAmount"),
        F.struct(F.col(f"{prefix}_metadata_decimals").alias("decimals"),
                 F.col(f"{prefix}_metadata_symbol").alias("symbol")).alias("metadata"),
        F.struct(F.col(f"{prefix}_chainId").alias("stringValue"),
                 F.col(f"{prefix}_chainId").cast("long").alias("bigIntegerValue")).alias("chainId"))


def nest_order_docs(flat: DataFrame) -> DataFrame:
    """Flat order columns -> one nested JSON document per row (text).

    Documents drift as in the source feed: the ``preswapData`` object exists
    only when the order has a pre-swap token name, and NULL fields (e.g. a
    missing maker) are left out of the document."""
    from ..functions.nulls import clean_text
    p = "preswapData"
    has_preswap = clean_text(f"{p}_tokenInMetadata_name").isNotNull()
    doc = F.struct(
        F.struct(F.col("orderid").alias("stringValue"),
                 F.concat(F.lit("0x"), F.col("orderid")).alias("bytesArrayValue")).alias("orderId"),
        F.col("makerSrc"), F.col("receiverDst"),
        _meta("giveOfferWithMetadata").alias("giveOfferWithMetadata"),
        _meta("takeOfferWithMetadata").alias("takeOfferWithMetadata"),
        F.struct(_sv("createdSrcEventMetadata_transactionHash").alias("transactionHash"))
         .alias("createdSrcEventMetadata"),
        F.struct(_sv("fulfilledDstEventMetadata_transactionHash").alias("transactionHash"))
         .alias("fulfilledDstEventMetadata"),
        F.when(has_preswap, F.struct(
            F.col(f"{p}_inAmount").alias("inAmount"), F.col(f"{p}_outAmount").alias("outAmount"),
            F.struct(*[F.col(f"{p}_tokenInMetadata_{k}").alias(k) for k in ("name", "symbol", "decimals")])
             .alias("tokenInMetadata"),
            F.struct(*[F.col(f"{p}_tokenOutMetadata_{k}").alias(k) for k in ("name", "symbol", "decimals")])
             .alias("tokenOutMetadata"))).alias(p),
        *[F.col(c) for c in ("taker", "percentFee", "finalPercentFee", "fixFee", "state")],
        F.struct(F.col("orderMetadata_origin").alias("origin"),
                 F.col("orderMetadata_orderTradeType").alias("orderTradeType"),
                 F.hex(F.col("orderid")).alias("rawMetadataHex")).alias("orderMetadata"),
    )
    return flat.select(F.to_json(doc).alias("value"))


def write_order_docs(docs: DataFrame, path: str) -> None:
    """Land one JSON document per row (a text column) as gzip files of at most ``DOCS_PER_FILE``
    documents: the keys repeat in every document, and a reader takes one file per task."""
    docs.write.option("compression", "gzip").option("maxRecordsPerFile", DOCS_PER_FILE).text(path)


def order_detail_load(spark: SparkSession, docs_path: str, processed: DataFrame | None = None,
                      target: str | None = None, schema=None,
                      batch_rows: int | None = None, metrics: dict | None = None,
                      null_text: str | None = None, mixed=None) -> DataFrame:
    """Landed order documents -> flat text rows of orders not stored yet
    (L2: J3 → S5 → P7 → P3 → P4 → P2 → S9).

    With a declared ``schema`` (``schemas.ORDER_DOC``) the documents are read
    once. Without one it is inferred over all files, so documents whose keys
    drift merge into one schema (missing keys NULL). ``mixed`` is that of
    ``flatten_struct``: unless given it is found in the documents, so that an
    object without the preferred key keeps its values under a declared schema too.
    The anti join on the id moves the flat columns that are stored, with NULLs (the keys an object
    has beside its preferred one stay behind), and its tasks write their rows as they are.
    ``null_text='nan'`` stores missing values as that text, as the original
    all-text order table does.
    """
    raw = files.read_json_pages(spark, docs_path, envelope=None, schema=schema, multi_line=False)
    raw = _observe(raw, metrics, "documents")
    flat = shape.flatten_struct(raw, sep="_", prefer=K.STRING_VALUE_KEY, mixed=mixed)
    flat = shape.drop_cols(flat, [K.RAW_METADATA_COLUMN], strict=False)
    if processed is not None:
        if not isinstance(flat.schema["orderId"].dataType, T.StringType):
            flat = flat.withColumn("orderId", F.col("orderId").cast("string"))
        flat = orders.backlog(flat, processed, "orderId", "orderid")
    flat = shape.to_strings(flat, null_text=null_text)
    new = _observe(flat.withColumnRenamed("orderId", "orderid"), metrics, "new_rows")
    if target:
        sinks.append_batched(new, target, batch_rows, even=processed is None)
    return new


# ------------------------------------------------------------ L3 price history
def write_price_pages(bars: DataFrame, path: str) -> None:
    """Hourly bars ``instrument, ts, CLOSE`` -> one JSON page per instrument
    and day, each page repeating the first bar of the next day (as an
    inclusive cursor does); pages land under ``instrument=<name>/``."""
    b = bars.select("instrument", X.ts_to_epoch("ts").alias("TIMESTAMP"), "CLOSE",
                    F.to_date("ts").alias("page"))
    first = F.min("TIMESTAMP").over(Window.partitionBy("instrument", "page"))
    edge = (b.withColumn("__first", first).where(F.col("TIMESTAMP") == F.col("__first"))
             .drop("__first").withColumn("page", F.date_sub("page", 1)))
    pages = (b.unionByName(edge)
              .groupBy("instrument", "page")
              .agg(F.to_json(F.struct(F.collect_list(F.struct("TIMESTAMP", "CLOSE")).alias("Data"))).alias("value")))
    pages.select("instrument", "value").write.mode("overwrite").partitionBy("instrument").text(path)


PRICES = "instrument STRING, ts TIMESTAMP_NTZ, CLOSE DOUBLE, filled BOOLEAN"


def price_history(spark: SparkSession, pages_path: str, step: str | None = None, target: str | None = None,
                  schema=None, max_growth: int | None = None) -> DataFrame:
    """Price pages -> de-duplicated, gap-filled series per instrument
    (L3: S5 → U2 → U3 → P23 → U4 → S7). ``schema`` (e.g.
    ``schemas.PRICE_PAGE``) skips inference; the ``instrument`` partition
    column comes from the folder names either way. Without ``step`` the most
    frequent distance of the bars is used (minute pages stay minute bars);
    ``max_growth`` is that of :func:`gap_fill`.

    With ``target``, rows that differ from the stored series are appended as one
    more ``load_id`` and :func:`read_prices` reads the newest of each bar: loading the
    same pages again appends nothing, a revised bar replaces the stored one, and a
    generated bar never replaces a real one. The last real bar stored before the
    pages is taken along, so that the gap between two loads is filled too. Returns
    the series of the pages (without ``target``) or the appended rows.
    """
    pages = files.read_json_pages(spark, pages_path, envelope=None, multi_line=False, schema=schema)
    bars = shape.dedupe_page_edges(pages, "Data", "TIMESTAMP", by="instrument")
    bars = bars.select(F.col("instrument").cast("string").alias("instrument"), X.epoch_to_ts("TIMESTAMP").alias("ts"), "CLOSE")
    if target is None:
        return timeseries.gap_fill(bars, "ts", "instrument", carry="CLOSE", step=step, max_growth=max_growth)
    stored = _stored_prices(spark, target)
    number = stored.agg(F.max("load_id")).first()[0]
    held = _newest_prices(stored)
    starts = bars.groupBy("instrument").agg(F.min("ts").alias("__start"))
    before = (held.where("not filled").join(starts, "instrument").where("ts < __start").groupBy("instrument")
                  .agg(F.max_by(F.struct("ts", "CLOSE"), "ts").alias("b")).select("instrument", "b.*"))
    out = timeseries.gap_fill(bars.unionByName(before), "ts", "instrument", carry="CLOSE", step=step, max_growth=max_growth)
    old = held.select("instrument", "ts", F.col("CLOSE").alias("__close"), F.col("filled").alias("__filled"))
    differs = F.col("__filled").isNull() | ((~F.col("CLOSE").eqNullSafe(F.col("__close")) | (F.col("filled") != F.col("__filled")))
                                            & ~(F.col("filled") & ~F.col("__filled")))
    new = out.join(old, ["instrument", "ts"], "left").where(differs).select("instrument", "ts", "CLOSE", "filled")
    folder = f"{target.rstrip('/')}/load_id={0 if number is None else number + 1}"
    new.write.mode("overwrite").parquet(folder)
    return spark.read.schema(PRICES).parquet(folder)


def _stored_prices(spark: SparkSession, target: str) -> DataFrame:
    return slices.read_declared(spark, target, PRICES + ", load_id BIGINT")


def _newest_prices(stored: DataFrame) -> DataFrame:
    newest = stored.groupBy("instrument", "ts").agg(F.max_by(F.struct("CLOSE", "filled"), "load_id").alias("bar"))
    return newest.select("instrument", "ts", "bar.CLOSE", "bar.filled")


def read_prices(spark: SparkSession, target: str) -> DataFrame:
    """The series that :func:`price_history` stored (empty before the first load)."""
    return _newest_prices(_stored_prices(spark, target))


# ---------------------------------------------------------- L4 file drop
def file_drop_aggregate(spark: SparkSession, root: str, keyword: str, schema=None,
                        suffix: str = ".csv", target: str | None = None,
                        timestamp_format: str | None = PACK_TIME, metrics: dict | None = None) -> DataFrame:
    """Listing -> keyword/suffix selection -> header-drift-tolerant CSV
    union (L4: S3 → S4 → S2 → S7)."""
    chosen = files.select_files(files.file_inventory(spark, root), keyword, suffix)
    df = _observe(files.read_csv_union(spark, chosen, schema, timestamp_format=timestamp_format, metrics=metrics),
                  metrics, "rows")
    if target:
        sinks.append_table(df, target)
    return df


# -------------------------------------------------------- L5 bundle history
def write_json_pages(records: DataFrame, path: str, envelope: str, page_col: str,
                     parts: int = 8, partition_by: str | None = None) -> None:
    """Group records into JSON pages, ``parts`` per ``page_col`` value
    (``{"<envelope>": [...]}``), one page per line."""
    cols = [c for c in records.columns if c not in (page_col, partition_by)]
    keys = [page_col] + ([partition_by] if partition_by else [])
    rec = records.withColumn("__part", shape.part_of(F.struct(*cols), parts))
    pages = (rec.groupBy(*keys, "__part")
                .agg(F.to_json(F.struct(F.collect_list(F.struct(*cols)).alias(envelope))).alias("value")))
    w = pages.select(*([partition_by] if partition_by else []), "value").write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).text(path)


def bundle_history(spark: SparkSession, pages_path: str, start_epoch: int,
                   drop=("tokens", "token_balance_delta"), schema=None) -> DataFrame:
    """Bundle pages -> bundles strictly after ``start_epoch`` with a
    ``DATETIME`` column (L5: S5 → U2 → F5 → P23 → P2)."""
    b = files.read_json_pages(spark, pages_path, envelope="data", multi_line=False, schema=schema)
    b = b.where(X.newer_than("timestamp", F.lit(start_epoch)))
    b = b.withColumn("DATETIME", X.epoch_to_ts("timestamp"))
    return shape.drop_cols(b, list(drop))


def resume_bundles(spark: SparkSession, pages_path: str, target: str, drop=("tokens", "token_balance_delta"),
                   schema=None, seconds: int = 3600, key: str | None = None) -> int:
    """Append the bundles that are not stored yet, whatever slices have been
    loaded and in which order (L5 → S7 over :mod:`sources.slices`): an interrupted
    load goes on, and same-second and late bundles are stored. ``key`` names a
    column that identifies a bundle; without one equal bundles are one. Returns
    the load's number; read back with :func:`read_bundles`."""
    b = bundle_history(spark, pages_path, -(1 << 62), drop, schema)
    return slices.load(b, target, "timestamp", seconds, key)


def read_bundles(spark: SparkSession, target: str, schema) -> DataFrame:
    """The bundles that :func:`resume_bundles` stored; ``schema`` is theirs (DDL or StructType)."""
    return slices.read(spark, target, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


# ---------------------------------------------------- L7 order-book snapshot
def write_array_pages(records_json: DataFrame, path: str, page_col: str = "page") -> None:
    """One bare JSON array per page, each page in its own file
    (``maxRecordsPerFile=1`` with one page per record). ``page_col`` values
    must already bound the page size (e.g. ``id div 500``)."""
    (records_json.groupBy(page_col)
                 .agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
                 .select("value")
                 .write.mode("overwrite").option("maxRecordsPerFile", 1).text(path))


def order_book_snapshot(spark: SparkSession, pages_path: str, order_hash: str | None = None,
                        schema=None) -> DataFrame:
    """Order-book pages (bare arrays, drifting columns) stacked by name,
    optionally looked up by hash (L7: S5 → U2 → F1)."""
    df = files.read_json_pages(spark, pages_path, envelope=None, multi_line=True, schema=schema)
    if order_hash is not None:
        df = df.where(X.id_equals("orderHash", order_hash))
    return df


# ------------------------------------------------------- L8 bridge transfers
def bridge_transfers(spark: SparkSession, pages_path: str, positive_amount_only: bool = False,
                     schema=None) -> DataFrame:
    """Transaction pages -> flat, chain-named transfers with parsed times
    (L8 first part: S5 → P8 → P18×3 → P2). ``schema`` (e.g.
    ``schemas.BRIDGE_PAGE``) skips inference."""
    tx = files.read_json_pages(spark, pages_path, envelope="transactions", multi_line=False, schema=schema)
    tx = shape.expand_structs(tx, ["globalTx", "standardizedProperties"], sep=".", drop=K.BRIDGE_DROP)
    tx = bridge.map_codes(tx, ["emitterChain", "toChain", "tokenChain"])
    if positive_amount_only:
        tx = tx.where(X.is_positive("tokenAmount"))
    return (tx.withColumn("timestamp", X.parse_iso(F.col("timestamp")))
              .withColumn("dest_timestamp", X.parse_iso(F.col("`destinationTx.timestamp`"))))


def bridge_latency_minute(spark: SparkSession, pages_path: str, schema=None) -> DataFrame:
    """Transfers -> mean positive latency per source minute (P22 → F4 → A6)."""
    return bridge.latency_minute(bridge_transfers(spark, pages_path, schema=schema), "timestamp", "dest_timestamp")
