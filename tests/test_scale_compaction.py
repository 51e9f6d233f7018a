"""Work of the streaming backlog over an id table: what a batch shuffles and what its rewrites write."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from relaylens.operators import orders
from relaylens.sources import idindex
from relaylens.streaming import ingest as S


def _rows_written(path):
    return sum(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/ids/**/part-*.parquet", recursive=True))


def test_rewrites_do_not_copy_the_whole_table_every_time(spark, tmp_dir):
    path = f"{tmp_dir}/ids"
    idindex.create(spark.range(2_000).select(F.col("id").alias("orderid")), path, "orderid", rows_per_bucket=100)
    for k in range(7):                                # 30 ids a batch, 20 of them new; NULL and repeated ones beside
        ids = [(str(i),) for i in range(1_990 + 20 * k, 2_020 + 20 * k)]
        spark.createDataFrame([*ids, *ids, (None,)], "orderid string").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")

    def run():
        src = spark.readStream.schema("orderid string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
        S.stream_backlog_indexed(src, path, f"{tmp_dir}/ck", rows_per_bucket=100, compact_every=2).awaitTermination()
        return sorted((int(r.id), r.batch_id >= 0) for r in idindex.read(spark, path).collect())

    want = [(i, i >= 2_000) for i in range(2_140)]
    assert run() == want
    assert idindex.layout(spark, path) == (3, 20)     # a rewrite before batches 2, 4 and 6
    assert _rows_written(path) <= 2_000 + 4 * 140     # three whole ones would be over 6,000
    assert len(glob.glob(f"{path}/ids/v=0/part=-1/**/part-*.parquet", recursive=True)) <= idindex.FILES
    for f in ("6", ".6.crc"):
        os.remove(f"{tmp_dir}/ck/commits/{f}")        # the last batch, with its rewrite, comes once more
    assert run() == want
    idindex.rebucket(spark, path, 100)
    assert run() == want and all("/part=-1/" in f for f in idindex.read(spark, path).inputFiles())


def test_a_grown_table_is_rewritten_whole(spark, tmp_dir):
    path = f"{tmp_dir}/ids"
    idindex.create(spark.range(100).select(F.col("id").alias("k")), path, "k", rows_per_bucket=10)
    for n in range(4):
        idindex.append_new(spark.range(100 + 20 * n, 120 + 20 * n).select(F.col("id").alias("k")), path, n, "k")
    idindex.append_new(spark.range(10).select(F.col("id").alias("k")), path, 4, "k")     # nothing new
    assert idindex.compact(spark, path, 10) == 18 and idindex.layout(spark, path) == (1, 18)
    assert all("/v=1/part=-1/" in f for f in idindex.read(spark, path).inputFiles())
    assert sorted(int(r.id) for r in idindex.read(spark, path).collect()) == list(range(180))


def test_a_compaction_that_breaks_off(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/ids"
    idindex.create(spark.range(100).select(F.col("id").alias("k")), path, "k", rows_per_bucket=10)
    idindex.append_new(spark.range(90, 110).select(F.col("id").alias("k")), path, 0, "k")

    def ids():
        return sorted(int(r.id) for r in idindex.read(spark, path).collect())

    with monkeypatch.context() as m:
        m.setattr(idindex, "_set_layout", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        for rewrite in (idindex.rebucket, idindex.compact, idindex.rebucket):
            try:
                rewrite(spark, path, 10)
            except RuntimeError:
                pass
    assert ids() == list(range(110)) and idindex.layout(spark, path) == (0, 10)
    idindex.compact(spark, path, 10)
    assert ids() == list(range(110)) and idindex.layout(spark, path) == (1, 10)


def test_stored_ids_that_a_batch_has_not_are_not_shuffled(spark):
    stored = spark.range(50_000).selectExpr("CAST(id AS string) AS id").union(spark.createDataFrame([(None,), ("é",), ("",)], "id string"))
    ids = spark.createDataFrame([(str(i),) for i in range(49_900, 50_100)] + [("é",), ("",), ("e",)], "id string").distinct()
    left = stored.where(orders._in_filter(orders.id_filter(ids, "id").scalar(), "id"))
    passed = {r.id for r in left.collect()}
    assert {str(i) for i in range(49_900, 50_000)} | {"é", ""} <= passed and len(passed) < 200
    new = orders.not_stored(ids, stored, "id")
    assert sorted(r.id for r in new.collect()) == sorted([str(i) for i in range(50_000, 50_100)] + ["e"])
    assert "Subquery" in new._jdf.queryExecution().executedPlan().toString()


def test_ids_of_two_types_are_compared_by_value(spark):
    stored = spark.range(10).selectExpr("id AS k")
    ids = spark.createDataFrame([("5",), ("12",)], "k string").distinct()
    assert [r.k for r in orders.not_stored(ids, stored, "k").collect()] == ["12"]
