"""Properties from the test strategy: round trips, idempotent reruns,
additivity of volumes."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relaylens.functions import constants as K
from relaylens.operators import fills, orders, shape
from relaylens.plans import bindings as B
from relaylens.plans import flows

from .conftest import SF001

CHAINS = [c for c, _ in K.PACK_CHAINS] + ["solana"]

events_st = st.lists(
    st.tuples(st.integers(0, 10_000), st.integers(0, 3 * 24 * 3600 * 1_000_000), st.sampled_from(CHAINS)),
    min_size=0, max_size=60)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events_st, st.integers(1, 5))
def test_unpack_of_pack_is_identity_on_known_chains(spark, rows, parts):
    base = dt.datetime(2025, 2, 1)
    data = [(str(i), base + dt.timedelta(microseconds=us), c) for i, us, c in rows]
    ev = spark.createDataFrame(data, "orderid string, evt_block_time timestamp_ntz, chain string")
    packed = shape.pack_events(ev, parts=parts)
    got = sorted(tuple(r) for r in shape.unpack_events(packed).collect())
    label = dict(K.PACK_CHAINS)
    want = sorted((i, t.strftime("%Y-%m-%d %H:%M:%S.%f"), label[c]) for i, t, c in data if c in label)
    assert got == want


def test_rerunning_event_log_build_appends_nothing(spark, tmp_dir):
    src = B.source_leg(spark, SF001).select(F.col("orderId").alias("orderid"),
                                            F.col("evt_time").alias("evt_block_time"), "chain")
    dest = B.dest_leg(spark, SF001).select(F.col("orderId").alias("orderid"),
                                           F.col("evt_time").alias("evt_block_time"), "chain")
    flows.write_packed_csv(src, f"{tmp_dir}/src")
    flows.write_packed_csv(dest, f"{tmp_dir}/dest")
    target = f"{tmp_dir}/log"
    spark.createDataFrame([], "orderid string, src_evt_time string, src_chain string, dest_evt_time string, "
                              "dest_chain string").write.parquet(target)
    m1, m2 = {}, {}
    first = flows.event_log_build(spark, f"{tmp_dir}/src", f"{tmp_dir}/dest",
                                  spark.read.parquet(target), target=target, metrics=m1)
    n1 = spark.read.parquet(target).count()
    assert n1 > 0 and first is not None
    assert m1["new_rows"].get["new_rows"] == n1 == m1["aligned_rows"].get["aligned_rows"]
    flows.event_log_build(spark, f"{tmp_dir}/src", f"{tmp_dir}/dest", spark.read.parquet(target),
                          target=target, metrics=m2)
    assert spark.read.parquet(target).count() == n1
    assert m2["new_rows"].get["new_rows"] == 0 and m2["aligned_rows"].get["aligned_rows"] == n1
    assert spark.read.parquet(target).select("orderid").distinct().count() == n1


def test_backlog_partitions_candidates(spark):
    cand = B.table(spark, SF001, "orders").select("o_orderkey")
    done = B.table(spark, SF001, "lineitem")
    new = orders.backlog(cand, done, "o_orderkey", "l_orderkey")
    inter = new.join(done.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    assert inter.count() == 0
    covered = new.select("o_orderkey").union(
        cand.join(done.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"))
    assert covered.distinct().count() == cand.distinct().count()


def test_token_volumes_add_up_to_total(spark):
    f = B.fills_view(spark, SF001)
    per_token = fills.volume_by(f, "token_symbol").agg(F.sum("volume_usd")).first()[0]
    total = f.where(F.col("token_symbol").isNotNull()).agg(F.sum("input_amount_usd")).first()[0]
    assert per_token == total


# ----------------------------------------------- column builders vs a Python model
from relaylens.functions import expr as X  # noqa: E402

SYMS = ["S", "sc", "scUSD", "USDC", "WETH", "wstEth", "SOL", "BNB", "WBNB", "ETH-X", None, ""]
TEXT_NUM = st.one_of(st.integers(-10**6, 10**9).map(str), st.sampled_from(["nan", "None", "", "x1", None]))


def _py_num(t):
    if t is None or t in ("nan", "None", ""):
        return None
    try:
        return float(t)
    except ValueError:
        return None


def _py_price(pair):
    import fnmatch
    if pair is None:
        return 0.0
    parts = pair.split("-")
    leg = parts[1] if len(parts) > 1 else None
    if leg is None:
        return 0.0
    for pat, v in K.USD_PRICE_LADDER:
        if fnmatch.fnmatchcase(leg, pat.replace("%", "*")):
            return v
    return 0.0


def _py_chain(addr, sym, chain):
    if addr is not None and not addr.startswith("0x"):
        return "SOL"
    if sym == "S" or (sym is not None and sym.startswith("sc")):
        return "SONIC"
    return chain


rows_st = st.lists(st.tuples(TEXT_NUM, st.sampled_from(["0", "2", "6", "nan", None]),
                             st.sampled_from(["0xab", "So1", None, ""]), st.sampled_from(SYMS),
                             st.sampled_from(SYMS)), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st)
def test_builders_match_python_model(spark, rows):
    df = spark.createDataFrame(rows, "raw string, dec string, addr string, a string, b string")
    out = df.select(X.scale_amount("raw", "dec").alias("amt"),
                    X.usd_price(X.pair_label("a", "b")).alias("usd"),
                    X.classify_chain("addr", "a", F.lit("EVT")).alias("chain")).collect()
    for (raw, dec, addr, a, b), r in zip(rows, out):
        n, d = _py_num(raw), _py_num(dec)
        want = None if n is None or d is None else n / 10.0 ** d
        assert r.amt == want
        pair = None if a is None or b is None else f"{a}-{b}"
        assert r.usd == _py_price(pair)
        assert r.chain == _py_chain(addr, a, "EVT")


def test_loaded_documents_feed_the_same_pair_summary(spark, tmp_dir):
    """L2 -> A1: documents landed with drifting keys, loaded as text with
    'nan' for missing values, summarise exactly like the source documents."""
    docs = B.order_docs_view(spark, SF001)
    flows.nest_order_docs(docs).write.text(f"{tmp_dir}/docs")
    loaded = flows.order_detail_load(spark, f"{tmp_dir}/docs", null_text="nan")
    ev = B.event_log_view(spark, SF001)
    # avg_price is a mean of non-integral prices: its last bits depend on the
    # summation order of the plan, so it is compared at 6 digits; all other
    # columns exactly.
    a = orders.pair_analysis(loaded, ev).withColumn("avg_price", F.round("avg_price", 6))
    b = orders.pair_analysis(docs, ev).withColumn("avg_price", F.round("avg_price", 6))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    from relaylens.operators import bridge
    from relaylens.streaming import ingest as S
    pairs = B.bridge_pairs(spark, SF001)
    pairs.write.parquet(f"{tmp_dir}/in")
    src = spark.readStream.schema(pairs.schema).parquet(f"{tmp_dir}/in")
    q = (S.stream_latency_minute(src).writeStream.format("parquet").option("path", f"{tmp_dir}/out")
          .option("checkpointLocation", f"{tmp_dir}/ck").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    q.stop()
    streamed = spark.read.parquet(f"{tmp_dir}/out")
    batch = bridge.latency_minute(pairs)
    last_emitted = streamed.agg(F.max("minute")).first()[0]
    closed = batch.where(F.col("minute") <= F.lit(last_emitted))
    assert streamed.count() == closed.count() > 0
    assert streamed.exceptAll(closed).count() == 0
    assert batch.count() - closed.count() <= 11        # only windows younger than the 10-minute watermark wait


def test_rerunning_order_detail_load_appends_nothing(spark, tmp_dir):
    flows.nest_order_docs(B.order_docs_view(spark, SF001)).write.text(f"{tmp_dir}/docs")
    target = f"{tmp_dir}/orders"
    flows.order_detail_load(spark, f"{tmp_dir}/docs", None, target=target, null_text="nan")
    n = spark.read.parquet(target).count()
    m = {}
    flows.order_detail_load(spark, f"{tmp_dir}/docs", spark.read.parquet(target).select("orderid"),
                            target=target, null_text="nan", metrics=m)
    assert n > 0 and spark.read.parquet(target).count() == n
    assert m["new_rows"].get["new_rows"] == 0 and m["documents"].get["documents"] == n


# ------------------------------------------- flattening drifting documents
import json  # noqa: E402

# Document -> the flat values that it must give (columns that are not named are NULL).
FLAT_CASES = [
    ({"id": 1, "a": "x"}, {"a": "x"}),
    ({"id": 2, "a": None, "b": {"c": {"d": "deep"}}}, {"b_c_d": "deep"}),
    ({"id": 3, "fee": {"stringValue": "7", "bytes": "0x07"}}, {"fee": "7"}),
    ({"id": 4, "fee": {"amount": 5}}, {"fee_amount": 5}),
    ({"id": 5, "fee": {"amount": 6, "unit": {"stringValue": "wei"}}}, {"fee_amount": 6, "fee_unit": "wei"}),
    ({"id": 6, "fee": {"amount": 7, "unit": {"code": "w"}}}, {"fee_amount": 7, "fee_unit_code": "w"}),
    ({"id": 7, "b": {"c": {"stringValue": "s"}}}, {"b_c": "s"}),
    ({"id": 8, "tags": [1, 2]}, {"tags": "[1,2]"}),
    ({"id": 9, "fee": None, "b": {}}, {}),
]


def test_flatten_document_by_document(spark):
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(d) for d, _ in FLAT_CASES]))
    flat = shape.flatten_struct(df)
    assert set(flat.columns) == {"id", "a", "b_c", "b_c_d", "fee", "fee_amount", "fee_unit", "fee_unit_code", "tags"}
    got = {r["id"]: {k: v for k, v in r.asDict().items() if v is not None and k != "id"} for r in flat.collect()}
    assert got == {d["id"]: want for d, want in FLAT_CASES}


def test_flatten_without_mixed_objects_has_no_sibling_columns(spark):
    df = spark.read.json(spark.sparkContext.parallelize(['{"a": {"stringValue": "1", "raw": "x"}}', '{"a": {"stringValue": "2"}}', "{}"]))
    assert shape.flatten_struct(df).columns == ["a"]
    assert shape.flatten_struct(df, mixed=["a_raw"]).columns == ["a", "a_raw"]


ITEM = st.one_of(
    st.builds(lambda i, t: f"{i}-{t}", st.integers(0, 999), st.sampled_from(["2025-02-01 00:00:00", "t", "x-y-z", ""])),
    st.sampled_from(["nodash", "-lead", ""]))
CELL = st.one_of(st.none(), st.lists(ITEM, max_size=4).map(", ".join))


def _py_unpack(rows, cols):
    out = []
    for r in rows:
        for c, cell in zip(cols, r[1:]):
            for item in (cell.split(", ") if cell is not None else []):
                parts = item.split("-", 1)
                if len(parts) == 2:          # no '-' -> time missing -> dropped
                    out.append((parts[0], parts[1], c))
    return sorted(out)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(CELL, CELL), min_size=1, max_size=6))
def test_unpack_matches_python_model(spark, cells):
    rows = [(f"h{i}", a, b) for i, (a, b) in enumerate(cells)]
    df = spark.createDataFrame(rows, "event_hour string, ETH string, BSC string")
    got = sorted(tuple(r) for r in shape.unpack_events(df).collect())
    assert got == _py_unpack(rows, ["ETH", "BSC"])


# ------------------------------------------------ fills against a pandas model
import math  # noqa: E402

import pandas as pd  # noqa: E402

FILL_SYMS = st.sampled_from(["USDC", "WETH", None])
FILL_ROW = st.tuples(
    st.one_of(st.integers(0, 72).map(lambda h: f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00.000000 UTC"),
              st.just("garbage")),
    st.one_of(st.none(), st.integers(0, 10_000).map(lambda s: f"2024-01-05 00:00:{s % 60:02d}.{s:06d} UTC")),
    FILL_SYMS, FILL_SYMS, st.sampled_from(["t", None]),
    st.one_of(st.integers(0, 500).map(float), st.just(float("nan"))),
    st.one_of(st.integers(0, 500).map(float), st.just(float("nan"))),
    st.sampled_from(["r1", "r2", None]))


def _pd_expected(rows):
    df = pd.DataFrame(rows, columns=["input_time", "output_time", "token_symbol", "output_symbol",
                                     "output_token", "input_amount_usd", "output_amount_usd", "relayer"])
    fmt = "%Y-%m-%d %H:%M:%S.%f %Z"
    t_in = pd.to_datetime(df["input_time"], format=fmt, errors="coerce", utc=True)
    t_out = pd.to_datetime(df["output_time"], format=fmt, errors="coerce", utc=True)
    date = t_in.dt.date
    filled = df["output_time"].notnull()
    lat = ((t_out - t_in).dt.total_seconds())[filled]
    lat_g = lat.groupby(date[filled]).agg(["mean", "max", "min"])
    same = df["output_symbol"] == df["token_symbol"]          # None == None is False in pandas
    fee = (df["input_amount_usd"] - df["output_amount_usd"])[same]
    fee_g = fee.groupby(date[same]).agg(["mean", "max", "min"])
    rel = (df["input_amount_usd"] - df["output_amount_usd"]).groupby(df["relayer"]).sum()
    return lat_g, fee_g, rel


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FILL_ROW, min_size=1, max_size=30))
def test_fill_statistics_match_pandas(spark, rows):
    from tests.test_operators import FILL_SCHEMA
    df = spark.createDataFrame([r + (None,) for r in rows], FILL_SCHEMA)
    lat_g, fee_g, rel = _pd_expected(rows)
    got_lat = {r.day: (r.avg_latency_s, r.max_latency_s, r.min_latency_s) for r in fills.latency_daily(df).collect()}
    lat_g = lat_g.dropna(how="all")
    assert set(got_lat) == set(lat_g.index)
    for d, (mean, mx, mn) in lat_g.iterrows():
        assert all(_close(x, y) for x, y in zip(got_lat[d], (mean, mx, mn)))
    got_fee = {r.day: (r.avg_fee, r.max_fee, r.min_fee) for r in fills.fee_daily(df).collect()}
    assert set(got_fee) == set(fee_g.index)
    for d, (mean, mx, mn) in fee_g.iterrows():
        assert all(_close(x, y) for x, y in zip(got_fee[d], (mean, mx, mn)))
    got_rel = {r.relayer: r.total_fees for r in fills.relayer_fees(df).collect()}
    assert got_rel.keys() == rel.to_dict().keys()
    assert all(_close(got_rel[k], v) for k, v in rel.items())


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FILL_ROW, min_size=1, max_size=30))
def test_token_share_and_volume_match_pandas(spark, rows):
    from tests.test_operators import FILL_SCHEMA
    df = spark.createDataFrame([r + (None,) for r in rows], FILL_SCHEMA)
    p = pd.DataFrame(rows, columns=["input_time", "output_time", "token_symbol", "output_symbol",
                                    "output_token", "input_amount_usd", "output_amount_usd", "relayer"])
    same = len(p.loc[p["output_symbol"] == p["token_symbol"]]) * 100 / len(p)
    diff = len(p.loc[(p["output_symbol"] != p["token_symbol"]) & p["token_symbol"].notnull()
                     & p["output_token"].notnull()]) * 100 / len(p)
    r = fills.token_share(df).collect()[0]
    assert _close(r.same_token_pct, same) and _close(r.diff_token_pct, diff)
    vol = p.groupby("token_symbol")["input_amount_usd"].sum()
    got = {x.token_symbol: x.volume_usd for x in fills.volume_by(df, "token_symbol").collect()}
    assert got.keys() == vol.to_dict().keys() and all(_close(got[k], v) for k, v in vol.items())
