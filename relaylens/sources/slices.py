"""A history table that is loaded slice by slice, in any order, and resumes after any interruption.

What has been loaded is a persisted set of time slices, kept as merged intervals,
instead of one newest time. Records of a slice that no load has brought yet are
appended as they are; records of a loaded slice (same-second, late and re-delivered
ones) are held against the stored records of just these slices and appended if they
are new. Nothing depends on the order in which slices come.

Layout under the target: ``rows/load_id=<n>/day=<d>`` (records with their slice
number, by epoch day) and ``slices/load_id=<n>`` (intervals). A load commits by writing its intervals, after its
records. Records without committed intervals are not read, and the next load takes
the same number and overwrites them, so a crash at any step neither loses nor repeats
a record.

Defined cases: a record without a time is in no slice and is known by its values like
any other. Records equal in all columns are one; with ``key``, of records with one key
in a slice the one with the smallest checksum of its values is kept, and a stored one
stays. An empty load commits no intervals.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERVALS = "first bigint, last bigint, load_id bigint"
#: Slice number of records without a time (real ones are far from it).
NO_TIME = -(1 << 62)


def read_declared(spark: SparkSession, path: str | list[str], schema, base: str | None = None) -> DataFrame:
    """A table with a declared schema, empty where nothing is stored yet. Several folders of it are given with
    the one that they all lie in (``base``)."""
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def merge_intervals(intervals: DataFrame, first: str = "first", last: str = "last", by=()) -> DataFrame:
    """Gaps and islands: overlapping and adjacent whole-number intervals become one."""
    by = [by] if isinstance(by, str) else list(by)
    order = Window.partitionBy(*by).orderBy(first, last)
    before = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col(first) > before + 1), 1).otherwise(0)
    islands = intervals.withColumn("__starts", starts).withColumn(
        "__island", F.sum("__starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*by, "__island").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("__island")


def loaded_slices(spark: SparkSession, target: str) -> DataFrame:
    """The loaded slices as merged intervals ``first``, ``last`` (slice numbers, both inclusive)."""
    return merge_intervals(read_declared(spark, f"{target}/slices", INTERVALS).filter(F.col("first") != NO_TIME).select("first", "last"))


def missing_slices(spark: SparkSession, target: str, first: int, last: int) -> DataFrame:
    """The intervals of slices from ``first`` to ``last`` that no load has brought."""
    held = loaded_slices(spark, target).filter((F.col("last") >= first) & (F.col("first") <= last))
    edges = held.unionByName(spark.createDataFrame([(first - 1, first - 1), (last + 1, last + 1)], "first bigint, last bigint"))
    order = Window.orderBy("first")                       # a row per island
    gaps = edges.select((F.col("last") + 1).alias("first"), (F.lead("first").over(order) - 1).alias("last"))
    return gaps.filter("first <= last")


def slice_of(ts, seconds: int) -> Column:
    """Number of the slice of ``seconds`` that an epoch time in seconds lies in."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.floor(ts / F.lit(seconds)).cast("bigint"), F.lit(NO_TIME))


def _day(seconds: int) -> Column:
    return F.when(F.col("slice") == NO_TIME, F.lit(-1)).otherwise(F.floor(F.col("slice") * F.lit(seconds) / 86400)).cast("int")


def values_of(df: DataFrame, cols) -> Column:
    """A checksum of a row's values (SHA-256 of its JSON text), to know records without a key by."""
    return F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in cols)), {"ignoreNullFields": "false"}), 256)


def load(records: DataFrame, target: str, ts: str, seconds: int = 3600, key: str | None = None, commit: bool = True) -> int:
    """Append the records that are not stored yet and commit their slices; returns the load's number.
    ``ts`` is the column with the epoch second. ``commit=False`` stops before the commit (a test's crash)."""
    spark, cols = records.sparkSession, records.columns
    committed = read_declared(spark, f"{target}/slices", INTERVALS)
    number = committed.agg(F.max("load_id")).first()[0]
    number = 0 if number is None else number + 1
    own = records.withColumns({"slice": slice_of(ts, seconds), "__values": values_of(records, cols)})
    own = own.withColumn("__known", F.coalesce(F.col(key).cast("string"), F.col("__values")) if key else F.col("__values"))
    if key:
        row = F.struct(*(F.col(f"`{c}`") for c in cols))
        own = own.groupBy("slice", "__known").agg(F.min_by(row, "__values").alias("__row")).select("slice", "__known", "__row.*")
    else:
        own = own.dropDuplicates(["slice", "__values"])
    # a row per loaded slice: of hours, some ten thousand a year
    held = (committed.select(F.explode(F.sequence("first", "last")).alias("slice")).distinct()
            .withColumn("__held", F.lit(True)))
    own = own.join(held, "slice", "left").withColumn("day", _day(seconds))
    # the days of loaded slices that come again: the folders to look into
    days = [r["day"] for r in own.filter("__held").select("day").distinct().collect()]
    stored = read(spark, target, records.schema, with_slice=True).filter(F.col("day").isin(days))
    known = F.coalesce(F.col(key).cast("string"), values_of(stored, cols)) if key else values_of(stored, cols)
    stored = stored.select(F.col("slice").alias("__slice"), known.alias("__stored"))
    new = own.join(stored, F.col("__held") & (F.col("slice") == F.col("__slice")) & (F.col("__known") == F.col("__stored")), "left_anti")
    (new.select(*cols, "slice", "day").hint("rebalance", F.col("day"))
        .write.mode("overwrite").partitionBy("day").parquet(f"{target}/rows/load_id={number}"))
    if commit:
        slices = records.select(slice_of(ts, seconds).alias("first")).distinct().withColumn("last", F.col("first"))
        merge_intervals(slices).write.mode("overwrite").parquet(f"{target}/slices/load_id={number}")
    return number


def read(spark: SparkSession, target: str, schema, with_slice: bool = False) -> DataFrame:
    """The stored records of committed loads; ``schema`` (a StructType) is that of the records."""
    more = (("slice", T.LongType()), ("load_id", T.LongType()), ("day", T.IntegerType()))
    whole = T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in more)])
    rows = read_declared(spark, f"{target}/rows", whole)
    done = read_declared(spark, f"{target}/slices", INTERVALS).select("load_id").distinct()
    out = rows.join(done, "load_id", "left_semi").drop("load_id")
    return out if with_slice else out.drop("slice", "day")
