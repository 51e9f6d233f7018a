"""Column builders and null normalisation on hand-made rows (§1.4 traps)."""

import math

from pyspark.sql import functions as F

from relaylens.functions import expr as X
from relaylens.functions import nulls as N


def test_to_double_sentinels_and_nan(spark):
    df = spark.createDataFrame([("1.5",), ("nan",), ("None",), ("",), ("abc",), (None,), ("NaN",)], "s string")
    got = [r[0] for r in df.select(N.to_double("s")).collect()]
    assert got == [1.5, None, None, None, None, None, None]


def test_nan_to_null_and_normalise_frame(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (2.0, "x")], "d double, s string")
    rows = N.normalise_frame(df).collect()
    assert rows[0]["d"] is None and rows[0]["s"] is None
    assert rows[1]["d"] == 2.0 and rows[1]["s"] == "x"


def test_classify_chain(spark):
    rows = [("0xabc", "USDC", "ETH"), ("So1", "USDC", "ETH"), ("0xabc", "S", "ETH"),
            ("0xabc", "scUSD", "ETH"), (None, "USDC", "ETH"), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, s string, c string")
    got = [r[0] for r in df.select(X.classify_chain("a", "s", "c")).collect()]
    assert got == ["ETH", "SOL", "SONIC", "SONIC", "ETH", None]


def test_effective_token_and_amount(spark):
    rows = [("nan", "1000", "2", "50", "1", "GIVE"), ("None", "1000", "2", "50", "1", "GIVE"),
            (None, "1000", "2", "50", "1", "GIVE"), ("PRE", "1000", "2", "50", "1", "GIVE"),
            ("PRE", "1000", "2", "50", "nan", "GIVE")]
    df = spark.createDataFrame(rows, "pre string, ga string, gd string, pa string, pd string, gs string")
    out = df.select(X.effective_token("pre", "gs").alias("t"),
                    X.effective_amount("pre", "pa", "pd", "ga", "gd").alias("a"),
                    X.effective_token("pre", "gs", sentinel_mode=True).alias("tp")).collect()
    assert [r.t for r in out] == ["GIVE", "GIVE", "GIVE", "PRE", "PRE"]
    assert [r.a for r in out] == [10.0, 10.0, 10.0, 5.0, None]
    # literal parity mode: only the exact text 'nan' means "absent"
    assert [r.tp for r in out] == ["GIVE", "None", None, "PRE", "PRE"]


def test_usd_price_ladder_first_match(spark):
    pairs = ["A-SOL", "A-WETH", "A-wstEth", "A-BNB", "A-WBNB", "A-USDC", "A-scUSD", "A-XYZ",
             "USD-Coin-SOL", None, "A-ETHSOL"]
    df = spark.createDataFrame([(p,) for p in pairs], "p string")
    got = [r[0] for r in df.select(X.usd_price("p")).collect()]
    assert got == [150.0, 2400.0, 2400.0, 500.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0, 150.0]


def test_pair_label_null_propagates(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B")], "a string, b string")
    assert [r[0] for r in df.select(X.pair_label("a", "b")).collect()] == ["A-B", None]


def test_fee_fraction_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(100.0, 90.0), (0.0, 1.0)], "i double, o double")
    got = df.select(X.fee_fraction("i", "o").alias("f"), X.yield_pct("i", "o").alias("y")).collect()
    assert math.isclose(got[0].f, 0.1) and math.isclose(got[0].y, 10.0)
    assert got[1].f is None and got[1].y is None


def test_parse_ts_and_latency(spark):
    df = spark.createDataFrame([("2024-11-02 10:31:07.123456 UTC", "2024-11-02 10:31:09.623456 UTC"),
                                ("2024-11-02 10:31:07.123 UTC", "2024-11-02 10:31:08.123 UTC"),
                                ("garbage", "2024-11-02 10:31:08.123 UTC")], "a string, b string")
    out = df.select(X.latency_seconds(X.parse_ts("a"), X.parse_ts("b")).alias("l")).collect()
    assert [r.l for r in out] == [2.5, 1.0, None]


def test_epoch_roundtrip_and_buckets(spark):
    df = spark.createDataFrame([(1704067432,)], "e long")
    r = df.select(X.epoch_to_ts("e").alias("t")).select(
        "t", X.ts_to_epoch("t").alias("e2"), X.floor_to("minute", "t").alias("m"),
        X.floor_to("hour", "t").alias("h")).collect()[0]
    assert r.e2 == 1704067432
    assert str(r.m) == "2024-01-01 00:03:00" and str(r.h) == "2024-01-01 00:00:00"
    assert dict(df.select(X.epoch_to_ts("e").alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_predicates(spark):
    df = spark.createDataFrame([("A", "A", "x"), ("A", "B", "x"), ("A", None, "x"), (None, "A", "x"),
                                ("A", "B", None), (None, None, "x")], "tok string, out string, otok string")
    same = [r[0] for r in df.select(X.same_token("out", "tok")).collect()]
    diff = [r[0] for r in df.select(X.different_token("out", "tok", "otok")).collect()]
    assert same == [True, False, None, None, False, None]
    assert diff == [False, True, True, False, False, False]


def test_matches_and_ranges(spark):
    df = spark.createDataFrame([("bundles/2024-11/a.csv",), ("BUNDLES/2024-11/b.CSV",),
                                ("private/2024-11/c.csv",)], "k string")
    got = [r[0] for r in df.select(X.matches("k", contains="BUNDLEs/2024-11", suffix=".csv",
                                             ignore_case=False)).collect()]
    assert got == [False, False, False]
    got = [r[0] for r in df.select(F.lower("k").contains("bundles") & F.col("k").endswith(".csv")).collect()]
    assert got == [True, False, False]


def test_declared_schemas_parse(spark):
    from relaylens import schemas
    for name, ddl in schemas.ALL.items():
        st = schemas.parse(ddl)
        assert len(st.fields) > 0, name
