"""Files and shuffles of stored ids when they grow."""

import glob

from pyspark.sql import functions as F

from relaylens.operators import orders
from relaylens.sources import idindex


def test_files_of_the_id_table_do_not_grow_with_its_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/ids"
    idindex.create(spark.range(1_000).select(F.col("id").alias("k")), path, "k", rows_per_bucket=2)
    assert idindex.layout(spark, path) == (0, 500)
    base = glob.glob(f"{path}/ids/v=0/part=-1/**/part-*.parquet", recursive=True)
    assert 1 < len(base) <= idindex.FILES
    batch = spark.range(900, 1_100).select(F.col("id").alias("k"))
    idindex.append_new(batch, path, 0, "k")
    assert len(glob.glob(f"{path}/ids/v=0/part=0/**/part-*.parquet", recursive=True)) <= 8
    idindex.rebucket(spark, path, 2)
    idindex.append_new(batch, path, 1, "k")
    got = idindex.read(spark, path)
    assert sorted((int(r.id), r.batch_id) for r in got.collect()) == [(i, -1 if i < 1_000 else 0) for i in range(1_100)]
    assert all("/v=1/" in f for f in got.inputFiles())                   # old versions are not listed
    one = spark.createDataFrame([("950",)], "id string")
    buckets = {r.bucket for r in idindex.same_buckets(one, path).collect()}
    assert len(buckets) == 1 and "950" in {r.id for r in idindex.same_buckets(one, path).collect()}


def test_stored_ids_are_not_sorted_for_a_batch(spark):
    stored = spark.range(0, 1_000).selectExpr("cast(id % 500 as string) AS orderid")
    ids = spark.createDataFrame([("5",), ("2000",), ("",)], "orderid string").distinct()
    new = orders.not_stored(ids, stored, "orderid")
    assert sorted(r.orderid for r in new.collect()) == ["", "2000"]
    assert "Sort" not in new._jdf.queryExecution().executedPlan().toString()
