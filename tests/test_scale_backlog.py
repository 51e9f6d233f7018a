"""The streaming backlog over stored ids."""

from relaylens.streaming import ingest as S


def test_a_backlog_stream_does_not_sort_the_stored_ids(spark, tmp_dir, monkeypatch):
    S.seed_stored(spark.createDataFrame([("a",)], "orderid string"), f"{tmp_dir}/stored")
    spark.createDataFrame([("a",), ("b",), (None,)], "orderid string").coalesce(1).write.parquet(f"{tmp_dir}/in")
    plans = []
    write = S.write_batch
    monkeypatch.setattr(S, "write_batch", lambda df, *a: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a)))
    src = spark.readStream.schema("orderid string").parquet(f"{tmp_dir}/in")
    S.stream_backlog(src, f"{tmp_dir}/stored", f"{tmp_dir}/ck").awaitTermination()
    new = spark.read.parquet(f"{tmp_dir}/stored").where("batch_id >= 0")
    assert [r.orderid for r in new.collect()] == ["b"]
    assert len(plans) == 1 and "strategy=shuffle_hash" in plans[0]
