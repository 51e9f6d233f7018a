"""Earliest events by a hash aggregate, tables stored for lookups, conflicting JSON types."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from relaylens.operators import orders, shape
from relaylens.plans import flows
from relaylens.sources import sinks

CHAINS = ["ETH", "ARB", "BSC"]


def _leg(spark, seed, as_text=False):
    rnd = random.Random(seed)
    times = [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
             dt.datetime(2024, 3, 31, 2, 30, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)]
    rows = [(rnd.choice([None, *"abcdefghij"]), rnd.choice(times), rnd.choice([None, *CHAINS])) for _ in range(300)]
    df = spark.createDataFrame(rows, "orderId string, evt_time timestamp_ntz, chain string")
    return df.withColumn("evt_time", F.date_format("evt_time", flows.PACK_TIME)) if as_text else df


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_packed_minimum_equals_the_general_one(spark, as_text, seed):
    leg = _leg(spark, seed, as_text)
    fmt = flows.PACK_TIME if as_text else None
    fast = orders.earliest_per_id(leg, "orderId", "evt_time", "chain", CHAINS, fmt)
    assert fast.schema == orders.earliest_per_id(leg, "orderId", "evt_time", "chain").schema
    plain = orders.earliest_per_id(leg, "orderId", "evt_time", "chain").collect()
    assert sorted(map(repr, fast.collect())) == sorted(map(repr, plain))
    plan = orders.align_legs(leg, leg, chains=CHAINS, time_format=fmt)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_packed_minimum_refuses_what_it_would_change(spark):
    def run(rows, **more):
        leg = spark.createDataFrame(rows, "orderId string, evt_time string, chain string")
        return orders.earliest_per_id(leg, "orderId", "evt_time", "chain", **more).collect()

    with pytest.raises(Exception, match="unknown chain label: XYZ"):
        run([("a", None, "XYZ")], chains=CHAINS, time_format=flows.PACK_TIME)
    for text in ("2024-01-01 00:00:00.000000000", "2024-01-01 00:00:00", "soon", ""):
        with pytest.raises(Exception, match="format|parsed|PARSE"):
            run([("a", text, "ETH")], chains=CHAINS, time_format=flows.PACK_TIME)
    with pytest.raises(ValueError, match="time_format"):
        run([("a", None, "ETH")], chains=CHAINS)
    with pytest.raises(ValueError, match="at most 35"):
        run([("a", None, "ETH")], chains=[str(i) for i in range(36)], time_format=flows.PACK_TIME)
    assert run([("a", "soon", "XYZ")])[0]["evt_time"] == "soon"      # the general form takes any text


def test_event_log_with_and_without_a_time_format(spark, tmp_dir):
    leg = spark.createDataFrame([(str(i % 40), dt.datetime(2024, 1, 1, i % 24, 0, 0, i), v)
                                 for i, v in enumerate(["ethereum", "base", "linea"] * 40)],
                                "orderid string, evt_block_time timestamp_ntz, chain string")
    flows.write_packed_csv(leg, f"{tmp_dir}/src")
    flows.write_packed_csv(leg.where("orderid < '3'"), f"{tmp_dir}/dest")
    plain = flows.event_log_build(spark, f"{tmp_dir}/src", f"{tmp_dir}/dest")
    fast = flows.event_log_build(spark, f"{tmp_dir}/src", f"{tmp_dir}/dest", time_format=flows.PACK_TIME)
    assert sorted(map(repr, fast.collect())) == sorted(map(repr, plain.collect())) and fast.count() == 40
    assert "SortAggregate" not in fast._jdf.queryExecution().executedPlan().toString()


def _scanned(df):
    """Rows that the file scans of an executed plan gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return sum(leaf.metrics().apply("numOutputRows").value() for leaf in _leaves(plan))


def _leaves(plan):
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_lookup_reads_one_row_group(spark, tmp_dir):
    rows = spark.range(200_000).selectExpr("cast(xxhash64(id) as string) AS ORDERID", "id AS v", "repeat('x', 20) AS t")
    sinks.write_for_lookup(rows, f"{tmp_dir}/t", "ORDERID", partitions=4, row_group_bytes=256 * 1024)
    stored = spark.read.parquet(f"{tmp_dir}/t")
    wanted = rows.where("v = 77777").first()["ORDERID"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = orders.order_lookup(stored, wanted)
        assert [r.v for r in one.collect()] == [77777]
        assert 0 < _scanned(one) <= 25_000                        # of 200,000
        assert _scanned(orders.order_lookup(stored, wanted + "5")) == 0      # absent: the Bloom filter says so
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert stored.count() == 200_000


def test_lookup_layout_splits_a_hot_key(spark, tmp_dir):
    rows = spark.range(20_000, numPartitions=8).selectExpr("if(id % 3 = 0, 'hot', if(id % 3 = 1, NULL, cast(id as string))) AS k",
                                                           "1 AS same", "id % 2 AS __salt")
    sinks.write_for_lookup(rows, f"{tmp_dir}/t", "k", partitions=12)
    stored = spark.read.parquet(f"{tmp_dir}/t")
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()
    sizes = [r["count"] for r in stored.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 9 and max(sizes) < 20_000 / 3
    sinks.write_for_lookup(rows.limit(0), f"{tmp_dir}/empty", "k")
    assert spark.read.parquet(f"{tmp_dir}/empty").count() == 0


DOCS = ['{"k":1,"n":{"a":1,"b":[1,"x"]}}', '{"k":"1","n":{"a":2.5}}', '{"k":{"z":null}}', '{"k":[1,2],"odd \' key":true}',
        '{"k":true}', '{"k":null}', '{"k":123456789012345678901234567890}', '{}', 'no json', None, '[1,2]', '"text"']


def test_shredding_keeps_every_value(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "id int, doc string")
    objects = df.where("doc LIKE '{%'")
    out = shape.shred_json_column(objects, "doc", keep="whole")
    assert out.schema["doc_k"].dataType.simpleString() == "variant"
    got = {r.id: r for r in out.withColumn("k", F.to_json("doc_k")).withColumn("whole", F.to_json("whole")).drop("doc_k").collect()}
    for i, text in enumerate(DOCS[:8]):
        want = json.loads(text)
        assert json.loads(got[i].whole) == want
        assert json.loads(got[i].k or "null") == want.get("k")
    assert [got[i].doc_n_a for i in (0, 1, 2)] == [1, 2.5, None] and json.loads(got[0].doc_n_b) == [1, "x"]
    assert got[3]["doc_odd ' key"] is True
    kinds = {r.id: r for r in shape.variant_kinds(shape.shred_json_column(objects, "doc"), "doc_k").collect()}
    assert kinds[0].doc_k_number == 1.0 and kinds[0].doc_k_text is None
    assert kinds[1].doc_k_text == "1" and kinds[1].doc_k_number is None
    assert json.loads(kinds[2].doc_k_json) == {"z": None} and kinds[3].doc_k_json == "[1,2]"
    assert kinds[4].doc_k_flag is True and kinds[4].doc_k_text is None
    assert [kinds[5][c] for c in ("doc_k_text", "doc_k_number", "doc_k_flag", "doc_k_json")] == [None] * 4
    assert kinds[6].doc_k_number == pytest.approx(1.2345678901234568e29)


def test_shredding_of_other_documents(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "id int, doc string")
    out = shape.shred_json_column(df, "doc", keep="whole")           # lists and objects: only the whole stays
    assert out.count() == len(DOCS)
    whole = {r.id: r.w for r in out.select("id", F.to_json("whole").alias("w")).collect()}
    assert whole[10] == "[1,2]" and whole[11] == '"text"' and whole[8] is None and whole[9] is None
    none = shape.shred_json_column(df.limit(0), "doc", keep="whole")
    assert none.columns == ["id", "whole"] and none.count() == 0
    clash = spark.createDataFrame([(1, '{"a":1}')], "doc_a int, doc string")
    with pytest.raises(ValueError, match="collide"):
        shape.shred_json_column(clash, "doc")
