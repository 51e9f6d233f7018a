"""Bounded packed cells, page-edge de-duplication and batch accounts."""

import datetime as dt

import pytest

from relaylens.operators import cells, shape
from relaylens.streaming import ingest as S

NAMES = (("a", "A"), ("b", "B"))
HOUR = dt.datetime(2024, 1, 1, 5)


def _packed(spark, rows, max_bytes, ranges=None):
    df = spark.createDataFrame(rows, "orderid string, evt_block_time timestamp_ntz, chain string, more string")
    return cells.pack_bounded(df, max_bytes, categories=NAMES, time_format="HH:mm", ranges=ranges)


def test_cells_keep_size_order_and_every_copy(spark):
    rows = [(f"{i:04d}", HOUR, "a" if i % 3 else "b", "x") for i in range(400)]
    rows += [("0007", HOUR, "a", "y")] * 250                       # one event again and again
    rows += [(None, HOUR, "a", "x"), ("1", None, "a", "x"), ("1", HOUR, "c", "x"), ("1", HOUR, None, "x")]
    rows += [("z", HOUR + dt.timedelta(hours=1), "b", "x")]
    got = _packed(spark, rows, 64, ranges=7).collect()
    assert all(len(r[c]) <= 64 for r in got for c in "AB")
    for c, v in (("A", "a"), ("B", "b")):
        first_hour = [r for r in got if r.event_hour == HOUR]
        assert [r.part for r in first_hour] == sorted(r.part for r in first_hour)
        items = [i for r in first_hour if r[c] for i in r[c].split(", ")]
        assert items == sorted(f"{i}-05:00" for i, t, k, _ in rows if i and t == HOUR and k == v)
    assert [(r.part, r.A, r.B) for r in got if r.event_hour != HOUR] == [(0, "", "z-06:00")]


def test_cells_empty_table_and_too_small(spark):
    assert _packed(spark, [], 64).collect() == []
    with pytest.raises(ValueError):
        _packed(spark, [("a" * 40, HOUR, "a", "x")], 64)


def _pages(spark, pages):
    schema = "series string, Data array<struct<t: bigint, v: double>>"
    return spark.createDataFrame(pages, schema)


@pytest.mark.parametrize("overlap", [False, True])
def test_page_edges_equal_full_dedupe(spark, overlap):
    pages = [("a", [(1, 1.0), (5, 2.0), (9, 3.0)]), ("a", [(9, 3.0), (9, 4.0), (12, 5.0), (12, 5.0)]), ("a", [(12, 5.0)]),
             ("b", [(9, 3.0), (None, 1.0)]), ("b", [(None, 1.0), (20, 1.0)]), ("b", []), ("b", None), (None, [(3, None)])]
    if overlap:
        pages.append(("a", [(5, 2.0), (9, 3.0), (10, 7.0)]))
    df = _pages(spark, pages)
    for block in (3, 86400):
        got = sorted(map(str, shape.dedupe_page_edges(df, "Data", "t", by="series", block=block).collect()))
        want = sorted(map(str, df.selectExpr("series", "inline(Data)").dropDuplicates().collect()))
        assert got == want
    assert shape._pages_overlap(df.selectExpr("series", "array_min(Data.t) __first", "array_max(Data.t) __last"), ["series"], 4) == overlap


def test_few_rows_of_large_pages_are_exchanged(spark, tmp_dir):
    """500 pages of 400 records: the exchange takes two records of each (0.5 %)."""
    rows = spark.range(500).selectExpr("'s' series", "transform(sequence(0, 400), i -> struct(id * 400 + i AS t, 1.0D v)) Data")
    rows.write.parquet(f"{tmp_dir}/pages")
    out = shape.dedupe_page_edges(spark.read.parquet(f"{tmp_dir}/pages"), "Data", "t", by="series")
    assert out.count() == 500 * 400 + 1
    inner, edges = out._jdf.queryExecution().analyzed().children().mkString("@@@").split("@@@")
    assert "Deduplicate" in edges and "Deduplicate" not in inner


def test_accounts_add_up_and_replay_rewrites(spark, tmp_dir):
    def land(name, rows):
        page = ", ".join(f'{{"id": {i}, "status": "DONE", "amount": 1.0, "sending": {{"timestamp": {t}}}}}' for i, t in rows)
        spark.createDataFrame([(f'{{"transfers": [{page}]}}',)], "value string").write.text(f"{tmp_dir}/in/{name}")

    def run():
        S.ingest_transfers(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", accounts=f"{tmp_dir}/acc").awaitTermination()
        return [(r.landed, r.on_time, r.late, r.repeated) for r in S.read_accounts(spark, f"{tmp_dir}/acc").orderBy("batch_id").collect()]

    assert S.read_accounts(spark, f"{tmp_dir}/acc").count() == 0
    land("a", [('"1"', 100000), ('"2"', 100900), ('"2"', 100900), ("null", 100000), ("null", 100000)])
    assert run() == [(5, 3, 0, 2)]
    land("b", [('"1"', 100000), ('"3"', 100300), ('"4"', 100301), ('"5"', 99000), ("null", 100000)])
    assert run() == [(5, 3, 0, 2), (5, 1, 2, 2)]
    import os
    for f in ("1", ".1.crc"):                                       # the last batch comes once more
        os.remove(f"{tmp_dir}/ckpt/commits/{f}")
    assert run() == [(5, 3, 0, 2), (5, 1, 2, 2)]
