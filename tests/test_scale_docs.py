"""What moves and how much is landed when order documents grow."""

import glob
import gzip
import json
import os

from relaylens import schemas
from relaylens.plans import flows
from relaylens.sources import sinks


def test_order_docs_land_compressed(spark, tmp_dir):
    docs = [json.dumps({"orderId": {"stringValue": str(i), "bytesArrayValue": f"0x{i}"}, "makerSrc": None if i % 3 else f"0x{i}",
                        "orderMetadata": {"origin": "web", "rawMetadataHex": "00"}}) for i in range(300)]
    flows.write_order_docs(spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1), f"{tmp_dir}/docs")
    files = glob.glob(f"{tmp_dir}/docs/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert sorted(line for f in files for line in gzip.open(f, "rt").read().splitlines()) == sorted(docs)
    assert sum(map(os.path.getsize, files)) * 4 < sum(map(len, docs))
    stored = spark.createDataFrame([(str(i),) for i in range(0, 300, 2)], "orderid string")
    flows.order_detail_load(spark, f"{tmp_dir}/docs", stored, target=f"{tmp_dir}/t", null_text="nan", schema=schemas.ORDER_DOC)
    got = {r.orderid: r for r in spark.read.parquet(f"{tmp_dir}/t").collect()}
    assert sorted(got, key=int) == [str(i) for i in range(1, 300, 2)]
    assert got["3"].makerSrc == "0x3" and got["5"].makerSrc == "nan" and "orderMetadata_rawMetadataHex" not in got["3"]


def test_order_docs_join_moves_flat_columns(spark, tmp_dir):
    flows.write_order_docs(spark.createDataFrame([('{"orderId":{"stringValue":"1"}}',)], "value string"), f"{tmp_dir}/docs")
    new = flows.order_detail_load(spark, f"{tmp_dir}/docs", spark.createDataFrame([("2",)], "orderid string"),
                                  null_text="nan", schema=schemas.ORDER_DOC)
    plan = new._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    types = [f["type"] for f in json.loads(plan.left().schema().json())["fields"]]
    assert "string" in types and not any(isinstance(t, dict) for t in types)


def test_batches_after_a_join_are_written_as_they_are(spark, tmp_dir):
    rows = spark.range(100).repartition(5)
    sinks.append_batched(rows, f"{tmp_dir}/t", even=False)
    assert len(glob.glob(f"{tmp_dir}/t/part-*")) == 5 and spark.read.parquet(f"{tmp_dir}/t").count() == 100
