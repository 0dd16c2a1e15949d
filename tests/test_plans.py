"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from marlstone.operators import joins
from marlstone.operators.dedup import dedup_by_key
from marlstone.plans import marts
from marlstone.workload.queries import QUERIES
from marlstone.workload.standins import Shop

SF = "/root/testdata/sf0.001"
BATCH = ["slv_orders", "slv_customers", "dedup_lineitem", "fct_sales", "dim_customer", "point_in_time_join",
         "mv_revenue_daily", "mv_sales_by_category", "mv_sales_by_state", "mv_order_funnel", "mv_review_summary",
         "dq_metrics_order_items", "kpi_pareto", "mask_email_analyst", "top_k_products"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_products(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "MapPartitions"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(orders.where(F.col("o_orderkey") > 10).select("o_orderkey", "o_custkey"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "GreaterThan(o_orderkey,10)" in plan
    sold = plan_of(dedup_by_key(spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey"), ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in sold


def test_copies_collapse_before_the_shuffle(spark):
    plan = plan_of(dedup_by_key(spark.read.parquet(f"{SF}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")  # printed below = runs before
    assert "Window" not in plan


def test_category_mart_does_not_expand_lines(spark):
    shop = Shop(spark, SF)
    fact = shop.written_fact()
    assert "Expand" not in plan_of(marts.mv_sales_by_category(fact, shop.products()))
    assert "Expand" not in plan_of(marts.mv_sales_by_state(fact, shop.current_customers()))


def test_funnel_shuffles_lines_once(spark):
    """Orders meet one row per order; the distinct count reuses that partitioning."""
    fact = spark.range(100).select(F.col("id").cast("string").alias("order_id"), F.col("id").cast("double").alias("revenue"))
    orders = fact.select("order_id", F.left("order_id", F.lit(1)).alias("order_status"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(marts.mv_order_funnel(orders, fact))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning(order_id") == 2
    assert plan.count("Exchange hashpartitioning(order_status") == 1
    assert plan.count("Exchange") == 3


def test_adaptive_planner_splits_a_hot_order(spark):
    """A third of all lines in one order: the join splits that partition at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("order_id"), F.sha2(F.col("id").cast("string"), 256).alias("p"))
        orders = spark.range(60_000).select(F.col("id").alias("order_id"), F.lit("paid").alias("s"))
        joined = joins.inner_equi_join(items, orders, "order_id")
        joined.collect()
        assert "skew=true" in plan_of(joined)
        left = joins.left_equi_join(items, orders, "order_id")
        left.collect()
        assert "skew=true" in plan_of(left)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
