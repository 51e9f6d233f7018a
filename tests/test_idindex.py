"""The bucketed table of stored ids."""

import os

import pytest
from pyspark.sql import functions as F

from relaylens.sources import idindex
from relaylens.streaming import ingest as S


def _ids(spark, ids):
    return spark.createDataFrame([(i, "x") for i in ids], "orderid string, id string")


def _read(spark, path):
    return sorted((r.id, r.batch_id) for r in idindex.read(spark, path).collect())


def test_new_ids_replay_and_rebucket(spark, tmp_dir):
    path = f"{tmp_dir}/ids"
    with pytest.raises(FileNotFoundError):
        idindex.read(spark, path)
    idindex.create(_ids(spark, ["a", "a", None, "", "b"]), path, "orderid", rows_per_bucket=1)
    assert idindex.layout(spark, path) == (0, 3)
    for _ in range(2):                                              # the same batch once more
        idindex.append_new(_ids(spark, ["b", "c", "c", None, "d"]), path, 0, "orderid")
    want = [("", -1), ("a", -1), ("b", -1), ("c", 0), ("d", 0)]
    assert _read(spark, path) == want
    assert idindex.rebucket(spark, path, rows_per_bucket=2) == 3 and idindex.layout(spark, path) == (1, 3)
    idindex.append_new(_ids(spark, ["c", "d"]), path, 0, "orderid")   # and after the base took its ids
    idindex.append_new(_ids(spark, []), path, 1, "orderid")
    assert _read(spark, path) == want


def test_rebucket_that_breaks_off(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/ids"
    idindex.create(_ids(spark, [str(i) for i in range(50)]), path, "orderid", rows_per_bucket=10)
    before = _read(spark, path)
    with monkeypatch.context() as m:
        m.setattr(idindex, "_set_layout", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            idindex.rebucket(spark, path, 25)
    assert idindex.layout(spark, path) == (0, 5) and _read(spark, path) == before
    assert idindex.rebucket(spark, path, 25) == 2 and _read(spark, path) == before


def test_empty_table(spark, tmp_dir):
    idindex.create(_ids(spark, []), f"{tmp_dir}/ids", "orderid")
    assert _read(spark, f"{tmp_dir}/ids") == []
    idindex.append_new(_ids(spark, ["a"]), f"{tmp_dir}/ids", 0, "orderid")
    assert _read(spark, f"{tmp_dir}/ids") == [("a", 0)]


def test_bytes_read_do_not_grow_with_the_table(spark, tmp_dir):
    def read(rows):
        path = f"{tmp_dir}/ids{rows}"
        idindex.create(spark.range(rows).select(F.sha2(F.col("id").cast("string"), 256).alias("k")), path, "k", rows_per_bucket=500)
        batch = spark.createDataFrame([("p",)], "id string")     # one bucket, whatever their number
        found = idindex.same_buckets(batch, path).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n"))
        return sum(r.n for r in found.select("f", "n").distinct().collect())

    small, large = read(2_000), read(20_000)
    assert 0 < large <= 1.3 * small, (small, large)


def test_stream_compacts_while_it_runs(spark, tmp_dir):
    path = f"{tmp_dir}/ids"
    idindex.create(_ids(spark, ["0", "1"]), path, "orderid", rows_per_bucket=2)
    for k in range(5):
        _ids(spark, [str(i) for i in range(2 * k, 2 * k + 4)]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")

    def run():
        src = spark.readStream.schema("orderid string, id string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
        S.stream_backlog_indexed(src, path, f"{tmp_dir}/ckpt", rows_per_bucket=2, compact_every=2).awaitTermination()
        return sorted((r.id for r in idindex.read(spark, path).collect()), key=int)

    assert run() == [str(i) for i in range(12)] and idindex.layout(spark, path)[0] == 2
    for f in ("4", ".4.crc"):
        os.remove(f"{tmp_dir}/ckpt/commits/{f}")                    # the last batch, which compacts, comes once more
    assert run() == [str(i) for i in range(12)]
