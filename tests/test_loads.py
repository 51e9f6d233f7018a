"""Loads that resume: interval cursor, price series, keyed appends, and the step of a series."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from relaylens.operators import timeseries
from relaylens.plans import flows
from relaylens.sources import slices
from relaylens.streaming import ingest as S

ROW = "timestamp BIGINT, v STRING"


def _rows(spark, rows):
    return spark.createDataFrame(rows, ROW)


def _stored(spark, path):
    return sorted(((r.timestamp, r.v) for r in slices.read(spark, path, _rows(spark, []).schema).collect()), key=str)


def test_intervals_merge_like_sets(spark):
    rows = [("a", 1, 3), ("a", 4, 4), ("a", 2, 9), ("a", 11, 12), ("b", 5, 5), ("a", 20, 25), ("a", 21, 22)]
    got = slices.merge_intervals(spark.createDataFrame(rows, "k string, first bigint, last bigint"), by="k").collect()
    assert sorted((r.k, r["first"], r["last"]) for r in got) == [("a", 1, 9), ("a", 11, 12), ("a", 20, 25), ("b", 5, 5)]


def test_missing_slices(spark, tmp_dir):
    slices.load(_rows(spark, [(t * 3600, "x") for t in (3, 4, 5, 9)]), tmp_dir, "timestamp")
    got = slices.missing_slices(spark, tmp_dir, 1, 12).collect()
    assert sorted((r["first"], r["last"]) for r in got) == [(1, 2), (6, 8), (10, 12)]
    assert slices.missing_slices(spark, tmp_dir, 3, 5).collect() == []
    assert [(r["first"], r["last"]) for r in slices.missing_slices(spark, f"{tmp_dir}/none", 1, 2).collect()] == [(1, 2)]


def test_loads_in_any_order_lose_and_repeat_nothing(spark, tmp_dir):
    newest = [(7200, "a"), (7201, "b"), (None, "untimed")]
    assert slices.load(_rows(spark, newest), tmp_dir, "timestamp") == 0
    # a load that breaks off before its commit is not read, and the next one takes its place
    assert slices.load(_rows(spark, [(10, "broken"), (11, "off")]), tmp_dir, "timestamp", commit=False) == 1
    assert _stored(spark, tmp_dir) == sorted(newest, key=str)
    again = [*newest, (7200, "same second"), (7199, "older"), (3600, "older"), (3600, "older"), (7200, "a")]
    assert slices.load(_rows(spark, again), tmp_dir, "timestamp") == 1
    want = sorted(set(again), key=str)
    assert _stored(spark, tmp_dir) == want
    assert slices.load(_rows(spark, again), tmp_dir, "timestamp") == 2
    assert slices.load(_rows(spark, []), tmp_dir, "timestamp") == 3
    assert _stored(spark, tmp_dir) == want


def test_load_by_key(spark, tmp_dir):
    slices.load(_rows(spark, [(1, "k1"), (2, "k2")]), tmp_dir, "timestamp", key="v")
    slices.load(_rows(spark, [(3, "k1"), (4, "k3"), (5, "k3"), (6, None), (6, None), (7, None)]), tmp_dir, "timestamp", key="v")
    slices.load(_rows(spark, [(7, None)]), tmp_dir, "timestamp", key="v")
    one = _rows(spark, [(4, "k3"), (5, "k3")])
    kept = one.orderBy(slices.values_of(one, one.columns)).first().timestamp
    assert _stored(spark, tmp_dir) == sorted([(1, "k1"), (2, "k2"), (kept, "k3"), (6, None), (7, None)], key=str)


def _bars(spark, rows):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, base + dt.timedelta(seconds=s), v) for k, s, v in rows], "k string, ts timestamp_ntz, v double")


def test_step_is_the_most_frequent_distance(spark):
    """One bar off the grid, or a microsecond after another, neither refines nor blows up the series."""
    minutes = [("a", 60 * m, float(m)) for m in range(181)]
    off = _bars(spark, [*minutes, ("a", 601, 99.0), ("a", 1200 + 1e-6, 7.0)])
    assert timeseries.infer_step(off, "ts", "k") == "60000000 microseconds"
    out = {r.ts: r.v for r in timeseries.gap_fill(off, "ts", "k", "v").collect()}
    assert len(out) == 181 and out[dt.datetime(2024, 1, 1, 0, 10)] == 99.0 and out[dt.datetime(2024, 1, 1, 0, 20)] == 7.0


def test_endless_filling_is_refused(spark):
    sparse = _bars(spark, [("a", 0, 1.0), ("a", 1, 2.0), ("a", 86_400 * 300, 3.0)])
    with pytest.raises(ValueError, match="coarser step"):
        timeseries.gap_fill(sparse, "ts", "k", "v")
    with pytest.raises(ValueError, match="coarser step"):
        timeseries.gap_fill(sparse, "ts", "k", "v", step="1 minute", max_growth=100)
    assert timeseries.filled_growth(sparse, "ts", "k", "1 day") == (3, 301)
    assert timeseries.gap_fill(sparse, "ts", "k", "v", step="1 day").count() == 301


def test_long_gaps_are_exploded_by_chunks(spark, monkeypatch):
    bars = _bars(spark, [("a", 0, 1.0), ("a", 60 * 25, 2.0), ("a", 60 * 26, 3.0), ("b", 30, 5.0)])
    want = sorted(map(tuple, timeseries.gap_fill(bars, "ts", "k", "v", step="1 minute").collect()))
    for chunk in (1, 4, 5, 26):
        monkeypatch.setattr(timeseries, "CHUNK", chunk)
        assert sorted(map(tuple, timeseries.gap_fill(bars, "ts", "k", "v", step="1 minute").collect())) == want
    assert len(want) == 28


def _price_page(path, bars):
    os.makedirs(f"{path}/instrument=X", exist_ok=True)
    with open(f"{path}/instrument=X/p.json", "w") as f:
        f.write(json.dumps({"Data": [{"TIMESTAMP": 1704067200 + 60 * m, "CLOSE": c} for m, c in bars]}))


def test_price_loads_revise_and_never_undo(spark, tmp_dir):
    schema, at = "Data ARRAY<STRUCT<TIMESTAMP: BIGINT, CLOSE: DOUBLE>>", dt.datetime(2024, 1, 1)
    loads = [[(0, 1.0), (1, 2.0), (3, 4.0)], [(6, 7.0), (7, 8.0)], [(1, 2.0), (2, 2.5)], [(0, 1.0), (3, 4.5)]]
    assert flows.read_prices(spark, f"{tmp_dir}/out").collect() == []
    added = []
    for k, bars in enumerate(loads):
        _price_page(f"{tmp_dir}/{k}", bars)
        added.append(flows.price_history(spark, f"{tmp_dir}/{k}", step="1 minute", target=f"{tmp_dir}/out", schema=schema).count())
        assert flows.price_history(spark, f"{tmp_dir}/{k}", step="1 minute", target=f"{tmp_dir}/out", schema=schema).count() == 0
    got = {(r.ts - at).seconds // 60: (r.CLOSE, r.filled) for r in flows.read_prices(spark, f"{tmp_dir}/out").collect()}
    # the gap between the loads is filled (4, 5), a late real bar replaces the filled one (2), a revision the old bar (3)
    assert got == {0: (1.0, False), 1: (2.0, False), 2: (2.5, False), 3: (4.5, False), 4: (4.0, True), 5: (4.0, True),
                   6: (7.0, False), 7: (8.0, False)}
    assert added == [4, 4, 1, 1]


def _page(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(json.dumps({"transfers": [{"id": i, "status": "DONE", "amount": a, "sending": {"timestamp": t, "chainId": 1}} for i, a, t in rows]}))


def test_records_without_an_id_are_known_by_their_values(spark, tmp_dir):
    t = 1704067200
    batches = [[(None, 1.0, t), (None, 1.0, t), (None, 2.0, t), ("a", 5.0, t), ("a", 4.0, t)],
               [(None, 1.0, t), (None, 3.0, t), ("a", 9.0, t), ("a", 9.0, t + 86400)], [(None, 2.0, t), ("b", 0.0, t)]]
    for k, rows in enumerate(batches):
        _page(f"{tmp_dir}/in/{k}.json", rows)
        S.ingest_transfers(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
        if not k:                                         # which of the two "a" is stored does not depend on the run
            first = next(r.amount for r in S.read_stored(spark, f"{tmp_dir}/out").collect() if r.id == "a")
            df = spark.createDataFrame([("a", "DONE", x, t) for x in (4.0, 5.0)], "id string, status string, amount double, timestamp bigint")
            df = df.withColumn("DATETIME", F.timestamp_seconds("timestamp").cast("timestamp_ntz"))
            assert first == df.orderBy(slices.values_of(df, df.columns)).first().amount
    got = sorted((str(r.id), r.amount) for r in S.read_stored(spark, f"{tmp_dir}/out").collect())
    assert got == sorted([("None", 1.0), ("None", 2.0), ("None", 3.0), ("a", first), ("a", 9.0), ("b", 0.0)])


def test_nothing_stored_reads_as_an_empty_table(spark, tmp_dir):
    empty = S.read_stored(spark, f"{tmp_dir}/never")
    assert empty.collect() == [] and empty.columns == ["id", "status", "amount", "timestamp", "DATETIME"]


def test_declared_documents_keep_both_forms(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/docs")
    with open(f"{tmp_dir}/docs/d.json", "w") as f:
        for k, chain in enumerate([{"stringValue": "1"}, {"bigIntegerValue": 56}, {"stringValue": "7", "bigIntegerValue": 7}, {}]):
            f.write(json.dumps({"orderId": {"stringValue": f"o{k}"}, "giveOfferWithMetadata": {"chainId": chain}}) + "\n")
    from relaylens import schemas
    got = flows.order_detail_load(spark, f"{tmp_dir}/docs", schema=schemas.ORDER_DOC).collect()
    chains = {r.orderid: (r["giveOfferWithMetadata_chainId"], r["giveOfferWithMetadata_chainId_bigIntegerValue"]) for r in got}
    assert chains == {"o0": ("1", None), "o1": (None, "56"), "o2": ("7", None), "o3": (None, None)}
