"""Operators on small hand-made fixtures with hand-computed answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from relaylens.operators import bridge, fills, marks, orders, shape, timeseries
from relaylens.sources.coverage import slice_coverage

FILL_SCHEMA = ("input_time string, output_time string, token_symbol string, output_symbol string, "
               "output_token string, input_amount_usd double, output_amount_usd double, relayer string, "
               "src_chain string")


@pytest.fixture()
def fills_df(spark):
    rows = [
        ("2024-01-01 10:00:00.000000 UTC", "2024-01-01 10:00:10.000000 UTC", "USDC", "USDC", "t", 100.0, 99.0, "r1", "eth"),
        ("2024-01-01 11:00:00.000 UTC", "2024-01-01 11:00:30.000 UTC", "USDC", "USDC", "t", 200.0, 190.0, "r1", "eth"),
        ("2024-01-01 12:00:00.000000 UTC", None, "WETH", "USDC", "t", 50.0, 40.0, "r2", "arb"),
        ("garbage", "2024-01-02 00:00:00.000000 UTC", "WETH", "WETH", "t", 10.0, 9.0, "r2", None),
        ("2024-01-02 09:00:00.000000 UTC", "2024-01-02 09:01:00.000000 UTC", "WETH", None, None, 0.0, 1.0, None, "arb"),
        ("2024-01-02 09:00:00.000000 UTC", "2024-01-02 09:00:05.000000 UTC", None, "WETH", "t", float("nan"), 5.0, "r3", "eth"),
    ]
    return spark.createDataFrame(rows, FILL_SCHEMA)


def _d(s):
    return dt.date.fromisoformat(s)


def test_latency_daily(fills_df):
    got = {r.day: (r.avg_latency_s, r.max_latency_s, r.min_latency_s)
           for r in fills.latency_daily(fills_df).collect()}
    assert got == {_d("2024-01-01"): (20.0, 30.0, 10.0), _d("2024-01-02"): (32.5, 60.0, 5.0)}


def test_fee_daily_same_token_only(fills_df):
    got = {r.day: (r.avg_fee, r.max_fee, r.min_fee) for r in fills.fee_daily(fills_df).collect()}
    # 2024-01-01: fees 1 and 10; the garbage-time row has no day and is dropped
    assert got == {_d("2024-01-01"): (5.5, 10.0, 1.0)}


def test_fee_pct_daily(fills_df):
    got = {r.day: (r.avg_fee_pct, r.max_fee_pct, r.min_fee_pct) for r in fills.fee_pct_daily(fills_df).collect()}
    assert got[_d("2024-01-01")] == pytest.approx((0.03, 0.05, 0.01))


def test_volume_by_drops_null_keys_and_sorts(fills_df):
    got = [(r.token_symbol, r.volume_usd) for r in fills.volume_by(fills_df, "token_symbol").collect()]
    assert got == [("USDC", 300.0), ("WETH", 60.0)]
    chains = [(r.src_chain, r.volume_usd) for r in fills.volume_by(fills_df, "src_chain").collect()]
    assert chains == [("eth", 300.0), ("arb", 50.0)]


def test_relayer_fees_and_yield(fills_df):
    fees = {r.relayer: r.total_fees for r in fills.relayer_fees(fills_df).collect()}
    assert fees == {"r1": 11.0, "r2": 11.0, "r3": 0.0}      # r3: NaN input -> NULL -> 0.0
    y = {r.relayer: r.avg_yield_pct for r in fills.relayer_yield(fills_df).collect()}
    assert y["r1"] == pytest.approx((1.0 + 5.0) / 2)
    assert y["r2"] == pytest.approx((20.0 + 10.0) / 2)
    assert y["r3"] is None


def test_token_share_over_all_rows(fills_df):
    r = fills.token_share(fills_df).collect()[0]
    assert r.same_token_pct == pytest.approx(100 * 3 / 6)
    # different: row 3 (WETH->USDC); row 5 out NULL but output_token NULL; row 6 token NULL
    assert r.diff_token_pct == pytest.approx(100 * 1 / 6)


# ------------------------------------------------------------------ orders
DOC_COLS = ["orderid", "makerSrc", "receiverDst", "giveOfferWithMetadata_finalAmount",
            "giveOfferWithMetadata_metadata_decimals", "giveOfferWithMetadata_metadata_symbol",
            "takeOfferWithMetadata_finalAmount", "takeOfferWithMetadata_metadata_decimals",
            "takeOfferWithMetadata_metadata_symbol", "preswapData_tokenInMetadata_name",
            "preswapData_inAmount", "preswapData_tokenInMetadata_decimals"]


@pytest.fixture()
def docs(spark):
    rows = [
        ("o1", "0xa", "0xb", "1000", "2", "USDC", "5000000", "6", "SOL", "nan", "nan", "nan"),
        ("o2", "0xa", "0xb", "2000", "2", "USDC", "10000000", "6", "SOL", "None", "nan", "nan"),
        ("o3", "Sol1", "0xb", "300", "1", "USDC", "60", "0", "WETH", "DAI", "40", "0"),
        ("o4", "0xa", "0xb", "0", "2", "USDC", "1", "0", "SOL", "nan", "nan", "nan"),       # F2 drops
        ("o5", "0xa", "Sol9", "-5", "2", "USDC", "1", "0", "SOL", "nan", "nan", "nan"),     # F2 drops
        ("o6", "0xa", "0xb", "100", "nan", "S", "7", "0", "BNB", "nan", "nan", "nan"),      # no decimals
        ("o7", None, "0xb", "100", "0", "USDC", "1", "0", "WBNB", "nan", "nan", "nan"),     # no event
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in DOC_COLS))


@pytest.fixture()
def event_log(spark):
    rows = [("o1", dt.datetime(2024, 1, 1), "ETH", dt.datetime(2024, 1, 1, 0, 5), "ARB"),
            ("o2", dt.datetime(2024, 1, 1), "ETH", dt.datetime(2024, 1, 1, 0, 5), "ARB"),
            ("o3", dt.datetime(2024, 1, 1), "BSC", dt.datetime(2024, 1, 1, 0, 5), "OP"),
            ("o6", dt.datetime(2024, 1, 1), "BSC", dt.datetime(2024, 1, 1, 0, 5), "OP")]
    return spark.createDataFrame(rows, "orderid string, src_evt_time timestamp_ntz, src_chain string, "
                                       "dest_evt_time timestamp_ntz, dest_chain string")


def test_pair_analysis(docs, event_log):
    got = {r.pair: r for r in orders.pair_analysis(docs, event_log).collect()}
    assert set(got) == {"USDC-SOL", "DAI-WETH", "S-BNB", "USDC-WBNB"}
    a = got["USDC-SOL"]
    assert (a.tx_count, a.amount_in, a.amount_out, a.volume_usd) == (2, 30.0, 15.0, 150.0 * 15.0)
    assert a.avg_price == pytest.approx(0.5)
    b = got["DAI-WETH"]
    assert (b.amount_in, b.amount_out, b.avg_price, b.volume_usd) == (40.0, 60.0, 1.5, 2400.0 * 60)
    c = got["S-BNB"]
    assert c.amount_in is None and c.avg_price is None and c.volume_usd == 500.0 * 7


def test_chain_analysis_null_route_counts_zero(docs, event_log):
    got = {r.chain: r for r in orders.chain_analysis(docs, event_log).collect()}
    assert got["ETH-ARB"].tx_count == 2
    assert got["SOL-OP"].tx_count == 1            # maker without 0x -> SOL
    assert got["SONIC-OP"].tx_count == 1          # give symbol 'S' -> SONIC
    assert got[None].tx_count == 0                # o7: no event, NULL maker -> NULL route
    assert got[None].amount_in == 100.0


def test_order_details_orderid_from_event_side(docs, event_log):
    extra = {src: F.lit("x") for _, src in orders.ORDER_DETAIL_COLUMNS if src not in docs.columns}
    d = orders.order_details(docs.withColumns(extra), event_log)
    assert len(d.columns) == 30
    rows = {r.SYMBOL_OUT + r.AMOUNT_IN: r for r in d.collect()}
    assert rows["WBNB100"].ORDERID is None and rows["WBNB100"].SRC_CHAIN is None
    assert orders.order_lookup(d, "o3").count() == 1


def test_align_legs_dedupes_each_leg(spark):
    src = spark.createDataFrame([("a", "2024-01-01 00:00:01", "ETH"), ("a", "2024-01-01 00:00:00", "BSC"),
                                 ("b", "2024-01-01 00:00:02", "ETH")], "orderId string, evt_time string, chain string")
    dest = spark.createDataFrame([("a", "2024-01-01 00:01:00", "OP"), ("c", "2024-01-01 00:02:00", "ARB")],
                                 "orderId string, evt_time string, chain string")
    m = {}
    got = {r.orderid: tuple(r)[1:] for r in orders.align_legs(src, dest, with_counts=True, metrics=m).collect()}
    assert m["src_duplicate_ids"].get["src_duplicate_ids"] == 1
    assert m["dest_duplicate_ids"].get["dest_duplicate_ids"] == 0
    assert got == {"a": ("2024-01-01 00:00:00", "BSC", "2024-01-01 00:01:00", "OP", 2, 1),
                   "b": ("2024-01-01 00:00:02", "ETH", None, None, 1, 0),
                   "c": (None, None, "2024-01-01 00:02:00", "ARB", 0, 1)}


def test_backlog_keeps_null_key_and_is_disjoint(spark):
    cand = spark.createDataFrame([("a",), ("b",), (None,), ("c",), ("c",)], "id string")
    done = spark.createDataFrame([("b",), ("b",), ("x",)], "id string")
    got = sorted(orders.backlog(cand, done, "id").collect(), key=lambda r: str(r.id))
    assert [r.id for r in got] == [None, "a", "c", "c"]
    assert orders.backlog(cand, done, "id").join(done, "id").count() == 0


def test_distinct_ids(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert sorted(r.k for r in orders.distinct_ids(df, "k").collect()) == [1, 2]


# ------------------------------------------------------------------ shape
def test_pack_unpack_round_trip(spark):
    rows = [("1", dt.datetime(2025, 2, 1, 0, 0, 7), "ethereum"), ("2", dt.datetime(2025, 2, 1, 0, 30), "ethereum"),
            ("3", dt.datetime(2025, 2, 1, 0, 40), "bnb"), ("4", dt.datetime(2025, 2, 1, 1, 0), "solana"),
            ("5", dt.datetime(2025, 3, 1, 0, 0), "base"),   # end of the half-open range: excluded
            ("6", dt.datetime(2025, 2, 1, 0, 0), "op")]
    ev = spark.createDataFrame(rows, "orderid string, evt_block_time timestamp_ntz, chain string")
    packed = shape.pack_events(ev, start="2025-02-01 00:00:00", end="2025-03-01 00:00:00")
    p = {r.event_hour.hour: r for r in packed.collect()}
    assert p[0].ETH == "1-2025-02-01 00:00:07.000000, 2-2025-02-01 00:30:00.000000"
    assert p[0].BSC == "3-2025-02-01 00:40:00.000000" and p[0].OP == ""
    assert p[1].ETH == "" and p[1].BASE == ""              # an hour with only unknown chains
    un = {tuple(r) for r in shape.unpack_events(packed).collect()}
    assert un == {("1", "2025-02-01 00:00:07.000000", "ETH"), ("2", "2025-02-01 00:30:00.000000", "ETH"),
                  ("3", "2025-02-01 00:40:00.000000", "BSC")}


def test_pack_splits_hot_hours_without_losing_items(spark):
    ev = spark.range(0, 1000).select(F.col("id").cast("string").alias("orderid"),
                                     F.lit(dt.datetime(2025, 2, 1, 5)).cast("timestamp_ntz").alias("evt_block_time"),
                                     F.lit("ethereum").alias("chain"))
    assert shape.pack_events(ev).count() == 1            # the shape does not depend on the hour's size
    packed = shape.pack_events(ev, parts=10)
    assert packed.count() == 10
    assert packed.select(F.max(F.size(F.split("ETH", ", ")))).first()[0] < 200
    assert shape.unpack_events(packed).count() == 1000


def test_unpack_reference_semantics(spark):
    df = spark.createDataFrame([("h", "a-2025-02-01 00:00:00 UTC, b-x-y", None, ""), ("h2", "noDash", "c-t", "")],
                               "event_hour string, ETH string, BSC string, OP string")
    got = sorted(tuple(r) for r in shape.unpack_events(df).collect())
    assert got == [("a", "2025-02-01 00:00:00 UTC", "ETH"), ("b", "x-y", "ETH"), ("c", "t", "BSC")]


def test_flatten_struct_string_value_and_collisions(spark):
    js = ['{"orderId": {"stringValue": "o1", "bytesArrayValue": "0x1"}, "give": {"amount": {"stringValue": "5"},'
          ' "meta": {"decimals": 6, "tags": [1, 2]}}, "maker": "0xa", "n": null}',
          '{"orderId": {"stringValue": "o2"}, "give": null, "maker": null}']
    df = spark.read.json(spark.sparkContext.parallelize(js))
    flat = shape.to_strings(shape.flatten_struct(df))
    rows = {r.orderId: r.asDict() for r in flat.collect()}
    assert set(flat.columns) == {"orderId", "give_amount", "give_meta_decimals", "give_meta_tags", "maker", "n"}
    assert rows["o1"]["give_amount"] == "5" and rows["o1"]["give_meta_decimals"] == "6"
    assert rows["o1"]["give_meta_tags"] == "[1,2]"
    assert rows["o2"]["give_amount"] is None and rows["o2"]["maker"] is None
    bad = spark.read.json(spark.sparkContext.parallelize(['{"a": {"b_c": 1}, "a_b": {"c": 2}}']))
    with pytest.raises(ValueError):
        shape.flatten_struct(bad)


def test_expand_structs_and_drop(spark):
    js = ['{"id": 1, "globalTx": {"originTx": {"txHash": "h", "status": "ok"}, "destinationTx": {"timestamp": "t"}},'
          ' "standardizedProperties": {"toChain": 2, "amount": "5"}}']
    df = spark.read.json(spark.sparkContext.parallelize(js))
    out = shape.expand_structs(df, ["globalTx", "standardizedProperties"])
    assert {"originTx.txHash", "originTx.status", "destinationTx.timestamp", "toChain", "amount"} <= set(out.columns)
    out = shape.drop_cols(out, ["globalTx", "standardizedProperties", "originTx.status"])
    assert "globalTx" not in out.columns and "originTx.status" not in out.columns
    with pytest.raises(KeyError):
        shape.drop_cols(out, ["missing"])


def test_rename_sanitize_union_dedupe(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert shape.rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        shape.rename_positional(df, ["x"])
    d2 = spark.createDataFrame([(1, 2)], "`a.b` long, `a_b` long")
    with pytest.raises(ValueError):
        shape.sanitize_names(d2)
    u = shape.union_by_name([df, spark.createDataFrame([(3,)], "a long")])
    assert sorted(map(tuple, u.collect())) == [(1, 2), (3, None)]
    assert shape.dedupe_rows(shape.union_by_name([df, df])).count() == 1


# --------------------------------------------------------------- bridge etc.
def test_map_codes_literal_and_dimension(spark):
    df = spark.createDataFrame([(1, 30, None), (3, 10002, 2)], "a int, b int, c int")
    got = [tuple(r) for r in bridge.map_codes(df, ["a", "b", "c"]).orderBy("a").collect()]
    assert got == [("Solana", "Base", "Unknown"), ("Unknown", "Sepolia Testnet", "Ethereum")]
    dim = spark.createDataFrame([(1, "one")], "code int, name string")
    got = [tuple(r) for r in bridge.map_codes(df, ["a"], dim=dim).orderBy("b").collect()]
    assert got[0][0] == "one" and got[1][0] == "Unknown"


def test_latency_minute_positive_only(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 10), dt.datetime(2024, 1, 1, 0, 0, 20)),
            (dt.datetime(2024, 1, 1, 0, 0, 50), dt.datetime(2024, 1, 1, 0, 1, 20)),
            (dt.datetime(2024, 1, 1, 0, 0, 55), dt.datetime(2024, 1, 1, 0, 0, 50)),
            (dt.datetime(2024, 1, 1, 0, 1, 0), dt.datetime(2024, 1, 1, 0, 1, 0))]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, dest_timestamp timestamp_ntz")
    got = [(r.minute, r.avg_latency_s, r.transfers) for r in bridge.latency_minute(df).collect()]
    assert got == [(dt.datetime(2024, 1, 1, 0, 0), 20.0, 2)]


def test_marks(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a"), (dt.datetime(2024, 1, 3), "a"),
                                (dt.datetime(2024, 1, 2), "b")], "ts timestamp_ntz, k string")
    r = marks.high_water_mark(df, "ts").collect()[0]
    assert r.high_water_mark == dt.datetime(2024, 1, 3) and r.low_water_mark == dt.datetime(2024, 1, 1)
    assert marks.since(df, "ts", "2024-01-02 00:00:00").count() == 1     # strictly newer
    counted, obs = marks.with_row_count(df)
    counted.collect()
    assert obs.get["rows"] == 3


def test_gap_fill(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0), 1.0, 2), ("a", dt.datetime(2024, 1, 1, 3), 4.0, 1),
            ("b", dt.datetime(2024, 1, 1, 1), 9.0, 1)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double, n long")
    got = [(r.k, r.ts.hour, r.v, r.n, r.filled) for r in
           timeseries.gap_fill(df, "ts", "k", carry="v", zero="n", step="1 hour").orderBy("k", "ts").collect()]
    assert got == [("a", 0, 1.0, 2, False), ("a", 1, 1.0, 0, True), ("a", 2, 1.0, 0, True),
                   ("a", 3, 4.0, 1, False), ("b", 1, 9.0, 1, False)]


def test_slice_coverage(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 1, 0, 4, 59),),
            (dt.datetime(2024, 1, 1, 0, 12),), (dt.datetime(2024, 1, 1, 0, 15),),
            (dt.datetime(2023, 12, 31, 23, 59),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [(r.slice_start.minute, r.rows, r.is_empty) for r in
           slice_coverage(df, "ts", "2024-01-01 00:00:00", "2024-01-01 00:15:00", "5 minutes")
           .orderBy("slice_start").collect()]
    assert got == [(0, 2, False), (5, 0, True), (10, 1, False)]


def test_flatten_json_column_drift(spark):
    df = spark.createDataFrame([(1, '{"k": 1, "a": {"b": "x", "c": null}}'), (2, '{"k": 2, "d": [1,2], "a": {"e": 1.5}}'),
                                (3, '{"z": null}'), (4, None), (5, "not json")], "id long, j string")
    out = shape.flatten_json_column(df, "j")
    assert set(out.columns) == {"id", "j_a_b", "j_a_c", "j_a_e", "j_d", "j_k", "j_z"}
    rows = {r.id: r for r in out.collect()}
    assert rows[1].j_k == 1 and rows[1].j_a_b == "x" and rows[2].j_a_e == 1.5 and rows[2].j_d == "[1,2]"
    assert rows[5].j_k is None and rows[4].j_k is None
    assert dict(out.dtypes)["j_k"] == "bigint"


def test_gap_fill_carries_across_blocks(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0), 1.0, 1), ("a", dt.datetime(2024, 1, 1, 7), 7.0, 1),
            ("a", dt.datetime(2024, 1, 1, 8), None, 1), ("b", dt.datetime(2024, 1, 1, 2), 5.0, 3)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double, n long")
    got = [(r.k, r.ts.hour, r.v, r.n, r.filled) for r in
           timeseries.gap_fill(df, "ts", "k", carry="v", zero="n", block="2 hours").orderBy("k", "ts").collect()]
    want_a = [("a", h, 1.0 if h < 7 else 7.0, 1 if h in (0, 7, 8) else 0, h not in (0, 7, 8)) for h in range(9)]
    assert got == want_a + [("b", 2, 5.0, 3, False)]


def test_pack_keeps_null_hour_group_and_gap_fill_drops_null_keys(spark):
    ev = spark.createDataFrame([("1", dt.datetime(2025, 2, 1, 0, 5), "ethereum"), ("2", None, "ethereum")],
                               "orderid string, evt_block_time timestamp_ntz, chain string")
    packed = {r.event_hour: r.ETH for r in shape.pack_events(ev).collect()}
    assert set(packed) == {None, dt.datetime(2025, 2, 1, 0)}
    assert packed[None] == ""            # the item text itself is NULL (no time), as in SQL concat
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 1, 0), 1.0), ("a", dt.datetime(2024, 1, 1, 1), 2.0)],
                               "k string, ts timestamp_ntz, v double")
    got = [(r.k, r.v) for r in timeseries.gap_fill(df, "ts", "k", carry="v").collect()]
    assert got == [("a", 2.0)]


def test_small_helpers(spark, tmp_dir):
    from relaylens.functions import expr as X
    from relaylens.sources import sinks
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 2)),
                                (2, dt.datetime(2024, 1, 3))], "k long, ts timestamp_ntz")
    inside = df.where(X.in_range("ts", F.lit("2024-01-01").cast("timestamp_ntz"),
                                 F.lit("2024-01-03").cast("timestamp_ntz")))
    assert inside.count() == 2                                   # half-open: the end is excluded
    assert shape.with_literal(df, "chain", "ETH").select("chain").distinct().first().chain == "ETH"
    assert shape.dedupe_rows(df, ["k"]).count() == 2
    dim = bridge.chain_dim(spark)
    assert dim.count() == 36 and dim.where("code = 30").first().name == "Base"
    sinks.append_table(df, f"{tmp_dir}/t", partition_by="k")
    sinks.append_table(df, f"{tmp_dir}/t", partition_by="k")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 6
    sinks.append_table(df, "t_helpers_tbl", table=True)
    try:
        assert spark.table("t_helpers_tbl").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS t_helpers_tbl")


def test_gap_fill_keeps_every_bar_of_its_own_step(spark):
    from relaylens.operators import timeseries
    base = dt.datetime(2025, 1, 1, 23, 50)
    bars = [("a", base + dt.timedelta(minutes=m), float(m)) for m in range(40) if m not in (5, 6, 20)]
    bars += [("a", base + dt.timedelta(days=3), 99.0), ("b", base, None), ("b", base + dt.timedelta(minutes=1), 2.0)]
    bars += [("b", base + dt.timedelta(minutes=1), 3.0), (None, base, 1.0)]          # a revised bar; no key
    df = spark.createDataFrame(bars, "k string, ts timestamp_ntz, v double")
    out = {(r.k, r.ts): (r.v, r.filled) for r in timeseries.gap_fill(df, "ts", "k", "v").collect()}
    assert len(out) == 3 * 1440 + 1 + 2
    for k, ts, v in bars[:37]:
        assert out[(k, ts)] == (v, False)
    assert out[("a", base + dt.timedelta(minutes=6))] == (4.0, True)
    assert out[("a", base + dt.timedelta(days=2))] == (39.0, True)
    assert out[("a", base + dt.timedelta(days=3))] == (99.0, False)
    assert out[("b", base)] == (None, False) and out[("b", base + dt.timedelta(minutes=1))] == (3.0, False)


def test_gap_fill_buckets_bars_off_the_grid(spark):
    from relaylens.operators import timeseries
    base = dt.datetime(1969, 12, 31, 23, 0)
    bars = [("a", base + dt.timedelta(minutes=m), m) for m in (7, 29, 31, 150)]
    df = spark.createDataFrame(bars, "k string, ts timestamp_ntz, v int").withColumn("n", F.lit(1))
    out = timeseries.gap_fill(df, "ts", "k", "v", zero="n", step="30 minutes").orderBy("ts").collect()
    assert [(r.ts, r.v, r.n, r.filled) for r in out] == [
        (base + dt.timedelta(minutes=30 * i), v, n, f) for i, (v, n, f) in
        enumerate([(29, 1, False), (31, 1, False), (31, 0, True), (31, 0, True), (31, 0, True), (150, 1, False)])]


def test_expand_structs_drops_before_names_can_clash(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('id', 2, 'x', 3) AS s")
    with pytest.raises(ValueError):
        shape.expand_structs(df, ["s"], keep=False)
    assert shape.expand_structs(df, ["s"], drop=["id", "s"]).first().asDict() == {"x": 3}


def test_inferred_json_keeps_key_names_and_mixed_values(spark):
    df = spark.createDataFrame([('{"VOID": 1, "OBJECT": {"DECIMAL": 1.5}, "m": 1}',), ('{"m": "t", "n": null}',)], "p string")
    rows = shape.flatten_json_column(df, "p").collect()
    assert (rows[0].p_VOID, rows[0].p_OBJECT_DECIMAL, rows[0].p_m, rows[1].p_m) == (1, 1.5, "1", "t")


def test_token_share_of_nothing(spark):
    from relaylens.operators import fills
    empty = spark.createDataFrame([], "output_symbol string, token_symbol string, output_token string")
    assert fills.token_share(empty).first()[0] is None
