"""Landed-file sources: header CSV, drifting CSV sets, JSON pages, listings.

Files are read directly by Spark's file sources (splittable where the
format allows); nothing is downloaded to, or parsed on, the driver. The
only driver-side state is file metadata (paths and headers), which Spark's
own readers keep there anyway.
"""

from __future__ import annotations

import csv
import logging
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.nulls import clean_text, normalise_frame
from ..operators.shape import union_by_name

log = logging.getLogger(__name__)


def _schema(schema):
    if schema is None or isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _typed(name: str, kind: T.DataType, null_text, timestamp_format: str | None) -> Column:
    """A text column as its declared type; null texts are NULL first, other text that
    does not parse fails the job (ANSI casts)."""
    text = clean_text(F.col(f"`{name}`"), null_text)
    if isinstance(kind, T.StringType):
        return text
    if timestamp_format and isinstance(kind, T.TimestampNTZType):
        return F.to_timestamp_ntz(text, F.lit(timestamp_format))
    if timestamp_format and isinstance(kind, T.TimestampType):
        return F.to_timestamp(text, timestamp_format)
    return text.cast(kind)


def read_csv(spark: SparkSession, path, schema=None, provenance: bool = False,
             timestamp_format: str | None = None, null_text=K.CSV_MISSING_TEXT, **options) -> DataFrame:
    """Header CSV into a declared schema (S1), columns matched **by name**.

    CSV columns are positional. Reading with a declared schema would assign
    columns by position, so a file whose columns come in another order
    would be mis-read, even by a pruned query that never triggers Spark's
    header check. Instead the header names are read first, the columns are read
    as text in the file's order (``enforceSchema=false`` still validates every
    file's header), and the result is typed and returned in declared order. File
    columns that are not declared stay text; a declared column missing from the
    file raises. Fields that hold a ``null_text`` are NULL in columns of every
    type; any other text that is not of the column's type fails the job. With
    ``provenance`` the source file path is added as ``_source_file``.
    """
    def reader():
        r = spark.read.option("header", True)
        for k, v in options.items():
            r = r.option(k, v)
        return r

    s = _schema(schema)
    if s is None:
        r = reader().option("inferSchema", True)
        if timestamp_format:
            r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
        df = normalise_frame(r.csv(path), null_text)
    else:
        header = reader().csv(path).columns                     # names of the first file's header
        declared = {f.name: f.dataType for f in s.fields}
        missing = [n for n in declared if n not in header]
        if missing:
            raise KeyError(f"declared columns not in the CSV header: {missing}")
        df = (reader().option("enforceSchema", False).option("mode", "FAILFAST")
                      .schema(T.StructType([T.StructField(n, T.StringType()) for n in header])).csv(path))
        names = list(declared) + [n for n in header if n not in declared]
        typed = [_typed(n, declared.get(n, T.StringType()), null_text, timestamp_format).alias(n) for n in names]
        return df.select(*typed, *([F.col("_metadata.file_path").alias("_source_file")] if provenance else []))
    if provenance:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing ``key, size, last_modified`` (S3).

    Uses the ``binaryFile`` source with only metadata columns selected, so file
    contents are never read. That source gives no row for a file without bytes;
    those are added from its own listing, which Spark keeps on the driver.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    found = r.load(root)
    rows = found.select(F.col("path").alias("key"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("last_modified"))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    empty = []
    listed = spark.createDataFrame([(f,) for f in found.inputFiles()], "uri string")
    plain = F.regexp_replace("key", "^([a-z0-9+]+):/+", "$1:/")
    paths = listed.withColumn("key", F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))))
    with_bytes = rows.select(plain.alias("known"))
    for r_ in paths.join(with_bytes, plain == F.col("known"), "left_anti").collect():   # files without bytes only
        path = jvm.org.apache.hadoop.fs.Path(r_["key"])
        status = path.getFileSystem(conf).getFileStatus(path)
        empty.append((status.getPath().toString(), int(status.getLen()), status.getModificationTime()))
    more = spark.createDataFrame(empty, "key string, size bigint, ms bigint")
    return rows.unionByName(more.select("key", "size", F.timestamp_millis("ms").alias("last_modified")))


def select_files(inventory: DataFrame, keyword: str, suffix: str = ".csv", key: str = "key") -> DataFrame:
    """Keep keys ending with ``suffix`` (case-sensitive) and containing
    ``keyword`` (case-insensitive) (S4)."""
    k = F.col(key)
    return inventory.where(k.endswith(suffix) & F.lower(k).contains(keyword.lower()))


def csv_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(header, paths of the files that have it), read by Spark's text source: one
    pass over the text, of which only each file's first line is shuffled."""
    lines = (spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"),
                                           F.col("_metadata.file_block_start").alias("at"))
                  .withColumn("n", F.monotonically_increasing_id()))
    first = lines.where("at = 0").groupBy("path").agg(F.min_by("value", "n").alias("header"))
    first = first.where(F.is_valid_utf8("header"))             # else the first line is not text
    return first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def read_csv_union(spark: SparkSession, files: DataFrame, schema=None, path_col: str = "key",
                   timestamp_format: str | None = None, provenance: bool = False,
                   metrics: dict | None = None) -> DataFrame:
    """Read a set of CSV files whose headers may drift, stacked by column
    name with NULL fill (S2).

    Files are grouped by header; each group is one Spark read (so files with
    the same header are scanned in parallel as one dataset) and the groups
    are combined with ``unionByName(allowMissingColumns=True)``. Files without
    a line, or whose first line is not text, have no columns and add nothing; their number is logged and put into
    ``metrics["files_without_header"]``. A file that cannot be read fails the
    job. ``schema`` may declare types for any superset of the columns;
    undeclared columns are text.
    """
    paths = [r[0] for r in files.select(path_col).collect()]    # Spark's reader takes its paths from the driver
    groups = csv_headers(spark, paths).orderBy("header").collect() if paths else []
    empty = len(paths) - sum(len(g["paths"]) for g in groups)
    if empty:
        log.warning("%d of %d CSV files have no header line", empty, len(paths))
    if metrics is not None:
        metrics["files_without_header"] = empty
    declared = {f.name: f for f in (_schema(schema).fields if schema is not None else [])}
    frames = []
    for g in groups:
        names = next(csv.reader([g["header"]]), [])
        st = T.StructType([declared.get(n, T.StructField(n, T.StringType(), True)) for n in names])
        frames.append(read_csv(spark, [unquote(x) for x in g["paths"]], st, provenance=provenance,
                               timestamp_format=timestamp_format))
    if not frames:
        return spark.createDataFrame([], _schema(schema) or T.StructType([]))
    return union_by_name(frames)


def read_json_pages(spark: SparkSession, path, envelope: str | None = None, schema=None,
                    multi_line: bool = True, record_schema=None) -> DataFrame:
    """Records of JSON pages.

    ``envelope`` names the array field that holds the records (``data``,
    ``transfers``, ``Data`` ...); ``None`` means each page is a bare array.
    ``multi_line=True`` reads one (pretty-printed) document per file;
    ``False`` reads one page per line, which is splittable. Pages with a
    missing or empty envelope yield no rows. Without a schema it is
    inferred over all pages, so drifting pages merge (missing keys -> NULL).
    """
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(_schema(schema))
    elif record_schema is not None and envelope:
        r = r.schema(T.StructType([T.StructField(envelope, T.ArrayType(_schema(record_schema)))]))
    else:
        r = r.option("samplingRatio", 1.0)
    df = r.json(path)
    if envelope is None:
        return df
    if envelope not in df.columns:
        return spark.createDataFrame([], _schema(record_schema) or T.StructType([]))
    # Other top-level fields (e.g. partition columns from the path) are kept.
    keep = [F.col(c) for c in df.columns if c != envelope]
    return df.select(*keep, F.inline(F.col(envelope)))
