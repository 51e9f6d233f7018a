"""A file drop that is loaded file by file and cleaned up afterwards.

Layout under the target: ``rows/load_id=<n>`` (records), ``files/load_id=<n>`` (the journal:
the files of a load) and ``commits/load_id=<n>`` (one row). A load lists the drop, journals
the files that no committed load has, appends their records and commits. Only then may
its files be deleted. A crash

* before the commit leaves records that are not read; the next load takes the same number
  and writes over them;
* after the commit leaves files that are known as loaded; the next load passes over them and
  its clean-up, or ``clean_drop``, deletes them.

So a crash neither loses nor repeats a record. A file is known by its path, size and time of
change: landed files stay as they are, and a new file under an old name is loaded anew and is not
deleted for the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files
from .slices import read_declared

JOURNAL = "key STRING, size BIGINT, last_modified TIMESTAMP, load_id BIGINT"
COMMITS = "files BIGINT, load_id BIGINT"
KNOWN_BY = ["key", "size", "last_modified"]


def loaded_files(spark: SparkSession, target: str) -> DataFrame:
    """The files of committed loads: path, size, time of change and the load's number."""
    commits = read_declared(spark, f"{target}/commits", COMMITS).select("load_id")
    return read_declared(spark, f"{target}/files", JOURNAL).join(commits, "load_id", "left_semi")


def load_drop(spark: SparkSession, root: str, keyword: str, target: str, schema, suffix: str = ".csv",
              timestamp_format: str | None = None, clean: bool = False, stop_after: str | None = None) -> int | None:
    """Append the records of the files that are not loaded yet and commit them; returns the load's
    number, or None where there is no new file. ``schema`` declares the records' columns (columns that a file lacks
    are NULL, undeclared ones are left out). ``clean`` deletes loaded files after the commit. ``stop_after`` "append"
    or "commit" ends there (a test's crash)."""
    number = read_declared(spark, f"{target}/commits", COMMITS).agg(F.max("load_id")).first()[0]
    number = 0 if number is None else number + 1
    found = files.select_files(files.file_inventory(spark, root), keyword, suffix)
    journal = f"{target}/files/load_id={number}"
    done = loaded_files(spark, target).where(F.col("load_id") < number)     # not what a broken load left in this load's place
    found.join(done, KNOWN_BY, "left_anti").select(*KNOWN_BY).write.mode("overwrite").parquet(journal)
    own = spark.read.schema(JOURNAL).parquet(journal)
    count = own.count()
    if count:
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        rows = files.read_csv_union(spark, own, declared, timestamp_format=timestamp_format)
        have = set(rows.columns)
        rows = rows.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                             for f in declared.fields])
        rows.write.mode("overwrite").parquet(f"{target}/rows/load_id={number}")
        if stop_after == "append":
            return number
        spark.createDataFrame([(count,)], "files bigint").write.mode("overwrite").parquet(f"{target}/commits/load_id={number}")
    if clean and stop_after is None:
        clean_drop(spark, root, target)
    return number if count else None


def read_drop(spark: SparkSession, target: str, schema) -> DataFrame:
    """The records of committed loads."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = read_declared(spark, f"{target}/rows", T.StructType([*declared.fields, T.StructField("load_id", T.LongType())]))
    commits = read_declared(spark, f"{target}/commits", COMMITS).select("load_id")
    return rows.join(commits, "load_id", "left_semi").drop("load_id")


def clean_drop(spark: SparkSession, root: str, target: str) -> int:
    """Delete the files under ``root`` that committed loads have; returns their number. A storage call a
    file, of which the driver holds one partition's names at a time; it may be repeated."""
    left = files.file_inventory(spark, root).join(loaded_files(spark, target), KNOWN_BY, "left_semi").select("key")
    jvm, conf, deleted = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for row in left.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(row["key"])
        deleted += bool(path.getFileSystem(conf).delete(path, False))
    return deleted
