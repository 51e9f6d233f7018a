"""Every registered query against its DuckDB oracle at sf0.01 (exact match),
plus the driver's smoke entry at sf0.001."""

import os

import pytest

import __spark_entry__ as E
from relaylens.plans import catalog
from tools.oracle_check import compare

from .conftest import SF01

pytestmark = pytest.mark.skipif(not os.path.isdir(SF01), reason="test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["pair", "tx_count", "avg_price", "amount_in", "amount_out", "volume_usd"]


def test_registry_covers_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_all_queries_match_oracle(spark):
    report = compare(spark, SF01, sorted(catalog.QUERIES), verbose=False)
    bad = {k: v for k, v in report.items() if v.get("ok") is False}
    assert not bad, bad
    assert report.pop("stream_empty")["rows"] == 0        # a feed without a finished transfer
    assert all(v["rows"] > 0 for v in report.values()), report
