"""How often order details are dealt out."""

from relaylens.operators import orders
from relaylens.plans import bindings as B


def test_order_details_deal_the_documents_once_by_id(spark, tmp_dir):
    spark.sql("""SELECT id % 3 AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 1D AS l_quantity, 5D AS l_extendedprice,
                 0.1D AS l_discount, 'R' AS l_returnflag FROM range(9)""").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.sql("SELECT id AS p_partkey, 'Brand#1' AS p_brand, 'PROMO' AS p_type, 1 AS p_size FROM range(9)").write.parquet(f"{tmp_dir}/part.parquet")
    spark.sql("""SELECT nullif(id, 2) AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 'x' AS o_orderpriority,
                 timestamp_ntz'2024-01-01' AS o_orderdate FROM range(3)""").write.parquet(f"{tmp_dir}/orders.parquet")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = orders.order_details(B.order_docs_view(spark, tmp_dir), B.event_log_view(spark, tmp_dir))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 5              # lineitem and part, both by order, events
        assert sorted(r.ORDERID for r in out.collect()) == ["0"] * 3 + ["1"] * 3
        assert B.order_docs_view(spark, tmp_dir, 1).count() == 3
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
