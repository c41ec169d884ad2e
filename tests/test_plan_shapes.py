"""Plan invariants that matter at scale, checked on the physical plans."""

import os

import pytest

import __spark_entry__ as E
from parcelworks.operators import analysis as A
from parcelworks.operators import marts as M
from parcelworks.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def assert_no_cross_join(df) -> None:
    text = plan(df)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


def test_no_cross_join_in_queries_without_oracle(spark):
    """Queries with an oracle are plan-checked in test_oracle."""
    for name in set(QUERIES) - set(E.oracle_sql()):
        assert_no_cross_join(E.queries()[name](spark, SF))


def test_item_rollup_combines_map_side_and_spreads_hot_orders(spark, built):
    text = plan(M.order_seller_items(built.stg["order_items"]))
    assert "partial_count" in text and "partial_sum" in text
    assert "hashpartitioning(order_id" in text and ", seller_id" in text.split("hashpartitioning(order_id", 1)[1].split(")")[0]


def test_states_pre_aggregate_before_join(spark, built):
    text = plan(A.states(built.fct_orders, built.stg["customers"]))
    head, _, _ = text.partition("(1)")
    # the per-customer partial aggregate sits under the join
    assert head.index("Join") < head.rindex("HashAggregate")


def test_hot_order_and_hot_seller(spark, clean_dir):
    """One order holding a third of all items, one seller a third of all
    orders: results equal the row-level SQL."""
    import duckdb

    from parcelworks.operators.staging import stage_all
    from parcelworks.sources.csv import read_raw_tables

    raw = read_raw_tables(spark, clean_dir)
    hot_items = [("a1", str(i), "pr1", "v1" if i % 2 else "v2", None, "1.25", "0.5") for i in range(3, 603)]
    more_orders = [(f"h{i}", "k1", "delivered", "2019-03-01 08:00:00", None, None,
                    "2019-03-05 08:00:00", "2019-03-04 08:00:00") for i in range(300)]
    more_items = [(f"h{i}", "1", "pr1", "v1", None, "2.0", None) for i in range(300)]
    raw["order_items"] = raw["order_items"].unionByName(
        spark.createDataFrame(hot_items + more_items, raw["order_items"].schema))
    raw["orders"] = raw["orders"].unionByName(spark.createDataFrame(more_orders, raw["orders"].schema))
    stg = stage_all(raw)
    pairs = M.order_seller_items(stg["order_items"])
    fct = M.fct_orders(stg["orders"], M.order_rollup(pairs, stg["reviews"]))
    perf = {r.seller_id: r for r in M.fct_seller_performance(M.order_seller_facts(pairs, fct)).collect()}

    con = duckdb.connect()
    for name, df in (("items", stg["order_items"]), ("orders", stg["orders"])):
        con.register(name, df.toPandas())
    n_items, value = con.execute(
        "SELECT count(*), sum(coalesce(price, 0) + coalesce(freight_value, 0)) FROM items WHERE order_id = 'a1'"
    ).fetchone()
    a1 = fct.where("order_id = 'a1'").first()
    assert (a1.item_count, a1.seller_count) == (n_items, 2)
    assert a1.order_value == pytest.approx(value)
    assert perf["v1"].order_count == 302  # a1, a2 and the 300 new orders
    assert perf["v1"].late_delivery_rate == pytest.approx(301 / 302)


def test_hot_and_missing_order_ids_are_split(spark, tmp_path):
    """Over a stored rollup, AQE splits an order id that half of the orders carry, and orders without an
    id go around the join."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = F.col("id")
        order = F.when(n % 2 == 0, F.lit("hot")).when(n % 7 == 0, F.lit(None)).otherwise(n.cast("string"))
        stamp = F.timestamp_seconds(n)
        orders = spark.range(200_000).select(
            order.alias("order_id"), F.md5(n.cast("string")).alias("customer_id"), F.lit("shipped").alias("order_status"),
            *[stamp.alias(c) for c in M.FCT_ORDER_COLUMNS[3:8]],
        )
        orders.write.parquet(str(tmp_path / "orders"))
        orders = spark.read.parquet(str(tmp_path / "orders"))
        pairs = spark.range(20_000).select(
            F.when(n == 0, F.lit("hot")).otherwise(n.cast("string")).alias("order_id"), F.lit("s").alias("seller_id"),
            F.lit(1).cast("long").alias("pair_items"), F.lit(2.0).alias("pair_value"),
        )
        reviews = pairs.select("order_id", F.lit(4).alias("review_score"))
        M.order_rollup(pairs, reviews).write.parquet(str(tmp_path / "rollup"))
        fct = M.fct_orders(orders, spark.read.parquet(str(tmp_path / "rollup")))
        found = fct.groupBy(F.col("order_id") == "hot").agg(F.count("*").alias("n"), F.sum("item_count").alias("items"))
        counts = {r[0]: (r.n, r["items"]) for r in found.collect()}
        missing = sum(1 for i in range(1, 200_000, 2) if i % 7 == 0)
        known = sum(1 for i in range(1, 20_000, 2) if i % 7)
        assert counts == {True: (100_000, 100_000), None: (missing, 0), False: (100_000 - missing, known)}
        fct.collect()
        assert "skew=true" in fct._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lazy_marts_spread_a_hot_order(spark):
    """Half of all orders under one id: no task of the registered plan's join holds a large share of the facts."""
    from pyspark.sql import functions as F

    from parcelworks.operators.staging import stage_all
    from parcelworks.sources.starschema import raw_tables_from_frames, read_star_tables

    star = read_star_tables(spark, SF)
    n = star["orders"].count()
    key = F.col("o_orderkey")
    star["orders"] = star["orders"].withColumn("o_orderkey", F.when(key % 2 == 0, F.lit(4).cast("long")).otherwise(key))
    stg = stage_all(raw_tables_from_frames(star))
    settings = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        marts = M.build_marts(stg)
        assert [r.order_id for r in M.hot_keys(stg["orders"], "order_id").collect()] == ["4"]
        pairs = M.order_seller_items(stg["order_items"])
        plain = M.fct_orders(stg["orders"], M.order_rollup(pairs, stg["reviews"]))
        for name, straight in (("fct_orders", plain), ("order_seller_facts", M.order_seller_facts(pairs, plain))):
            largest = []
            for df in (straight, marts[name]):
                parts = df.groupBy(F.spark_partition_id()).count().collect()
                largest.append(max(r["count"] for r in parts) / sum(r["count"] for r in parts))
            assert largest[0] > 0.4 and largest[1] < 0.25, (name, largest)
            assert sorted(map(str, straight.collect())) == sorted(map(str, marts[name].select(straight.columns).collect()))
        assert marts["fct_orders"].count() == n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
