"""A table of stored ids in hash buckets, to ask which ids of a batch are new.

A lookup reads the buckets of the batch's own ids and no others, and ``rebucket`` keeps buckets at a size:
a batch of few ids reads as many bytes of a large table as of a small one (a batch that has ids in very many
buckets reads them all).

Layout: ``ids/v=<k>/part=<p>/file=<f>`` (id, number of the batch that brought it, bucket; sorted by bucket)
and ``layout/v=<k>`` (one row: the number of buckets, the parts of older versions that still hold). Part -1 is what
the rewrite that began the version wrote, part n what batch n appended. A file of a base, which holds all ids,
has one bucket, or, beyond ``FILES`` buckets, several neighbouring ones, whose row groups and pages tell
their buckets; any other part is as few files as its bytes need (``file=-1``). So the files of a batch and
of a rewrite do not grow in number with the table. A reader lists the files of its version only. ``rebucket`` writes
everything as the base of the next version and only then its layout row, which is what readers go by: one
that breaks off leaves the old version as it was and is overwritten by the next one, and old versions stay
for readers that are under way. ``compact`` does so with the newest parts only as long as these hold less than half of
what is older: an id is rewritten some log(table / batch) times, not once for every rewrite, the parts beside
the base stay as few, and buckets grow by half at most between two bases. The one writer of a table calls them between two
appends, so no append can fall between; ``streaming.ingest.stream_backlog_indexed`` does so while it runs.

NULL ids are left out, ids are compared as text, and repeated ids are stored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.orders import not_stored
from .slices import read_declared

IDS = "id STRING, batch_id BIGINT, bucket INT, v INT, part BIGINT, file INT"
LAYOUT = "buckets INT, kept ARRAY<STRUCT<v: INT, part: BIGINT>>, v INT"
BASE = -1
#: Files of the base at most, and the number of the files of any other part.
FILES, APPENDED = 64, -1
#: A lookup that touches more buckets than this reads them all.
TOUCHED = 1000
#: A rewrite takes up the next older part when this holds at most so many times the ids of the newer ones.
OLDER = 2


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _file(bucket: Column, buckets: int) -> Column:
    return F.floor(bucket / F.lit(-(-buckets // FILES))).cast("int")


def _write(ids: DataFrame, path: str, version: int, part: int, buckets: int, base: bool = False) -> None:
    """Rows travel without the numbers that follow from their id."""
    file = _file(_bucket(buckets), buckets)
    dealt = ids.repartition(file) if base else ids.hint("rebalance", F.col("id"))
    rows = dealt.withColumns({"bucket": _bucket(buckets), "file": file if base else F.lit(APPENDED)})
    (rows.sortWithinPartitions("file", "bucket", "id").write.mode("overwrite").partitionBy("file")
         .parquet(f"{path}/ids/v={version}/part={part}"))


def _set_layout(spark: SparkSession, path: str, version: int, buckets: int, kept: list) -> None:
    row = spark.createDataFrame([(buckets, kept)], "buckets int, kept array<struct<v: int, part: bigint>>")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout/v={version}")


def _current(spark: SparkSession, path: str) -> Row:
    last = read_declared(spark, f"{path}/layout", LAYOUT).orderBy(F.desc("v")).first()
    if last is None:
        raise FileNotFoundError(f"no id table at {path}")
    return last


def layout(spark: SparkSession, path: str) -> tuple[int, int]:
    """(version, buckets) of the table."""
    now = _current(spark, path)
    return now["v"], now["buckets"]


def _stored(spark: SparkSession, path: str, now: Row) -> DataFrame:
    folders = [f"v={now['v']}", *(f"v={p['v']}/part={p['part']}" for p in now["kept"] or ())]
    return read_declared(spark, [f"{path}/ids/{f}" for f in folders], IDS, base=f"{path}/ids")


def create(ids: DataFrame, path: str, key: str, rows_per_bucket: int = 1_000_000) -> None:
    """A table of the distinct ids of ``ids`` (their batch is -1)."""
    own = ids.select(F.col(key).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    buckets = max(1, -(-own.count() // rows_per_bucket))
    _write(own.withColumn("batch_id", F.lit(BASE).cast("bigint")), path, 0, BASE, buckets, base=True)
    _set_layout(ids.sparkSession, path, 0, buckets, [])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored ids: ``id``, and the batch that brought it (-1: there from the start)."""
    return _stored(spark, path, _current(spark, path)).select("id", "batch_id")


def same_buckets(ids: DataFrame, path: str, but_part: int | None = None) -> DataFrame:
    """The stored ids in the buckets of ``ids`` (column ``id``), or in all if these are more than ``TOUCHED``;
    without those that batch ``but_part`` appended to this version."""
    return _same_buckets(ids, path, _current(ids.sparkSession, path), but_part)


def _touched(ids: DataFrame, buckets: int) -> list[int] | None:
    """The buckets of ``ids``, or None for all of them. The first rows often tell that it is all."""
    for some in (ids.limit(4 * TOUCHED), ids):
        found = [r[0] for r in some.select(_bucket(buckets)).distinct().collect()]
        if len(found) >= min(buckets, TOUCHED + 1):
            return None
    return found


def _same_buckets(ids: DataFrame, path: str, now: Row, but_part: int | None) -> DataFrame:
    touched, buckets = _touched(ids, now["buckets"]), now["buckets"]
    stored = _stored(ids.sparkSession, path, now)
    if touched is not None:
        files = sorted({b // -(-buckets // FILES) for b in touched})
        stored = stored.where(F.col("file").isin([APPENDED, *files]) & F.col("bucket").isin(touched))
    return stored if but_part is None else stored.where((F.col("v") != now["v"]) | (F.col("part") != F.lit(but_part)))


def append_new(batch: DataFrame, path: str, batch_id: int, key: str) -> None:
    """Store the ids of a batch that are not stored yet. A batch that is replayed is held against
    all ids but its own, and written in the same place."""
    rows = batch.select(F.col(key).cast("string").alias("id")).where("id IS NOT NULL")
    now = _current(batch.sparkSession, path)
    # dealt out first: the file of a batch is often one task, and most of its ids are different
    new = not_stored(rows.repartition("id").distinct(), _same_buckets(rows, path, now, batch_id).select("id"), "id")
    _write(new.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, now["v"], batch_id, now["buckets"])


def rebucket(spark: SparkSession, path: str, rows_per_bucket: int = 1_000_000) -> int:
    """Write the table as one base with buckets of about ``rows_per_bucket`` ids; returns their number.
    To be called by the table's one writer."""
    now = _current(spark, path)
    stored = _stored(spark, path, now)
    buckets = max(1, -(-stored.count() // rows_per_bucket))
    _write(stored.select("id", "batch_id"), path, now["v"] + 1, BASE, buckets, base=True)
    _set_layout(spark, path, now["v"] + 1, buckets, [])
    return buckets


def compact(spark: SparkSession, path: str, rows_per_bucket: int = 1_000_000) -> int:
    """Write the newest parts as one in the next version: always the last one, and the next older one as long as it
    holds at most ``OLDER`` times what is newer. If that takes in the base, it is ``rebucket``. Returns the
    number of buckets. To be called by the table's one writer."""
    now = _current(spark, path)
    stored = _stored(spark, path, now)
    kept = sorted((r["v"], r["part"], r["count"]) for r in stored.groupBy("v", "part").count().collect())
    newer, oldest = 0, None
    while kept and (oldest is None or kept[-1][2] <= OLDER * newer):
        *oldest, rows = kept.pop()
        newer += rows
    if not kept:
        return rebucket(spark, path, rows_per_bucket)
    v, part = oldest
    newest = stored.where((F.col("v") > v) | ((F.col("v") == v) & (F.col("part") >= F.lit(part))))
    _write(newest.select("id", "batch_id"), path, now["v"] + 1, BASE, now["buckets"])
    _set_layout(spark, path, now["v"] + 1, now["buckets"], [k[:2] for k in kept])
    return now["buckets"]
