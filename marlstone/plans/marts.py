"""Business marts over the star schema.

Each mart aggregates before it joins wherever the join only adds attributes, so
what meets the dimension is one row per key and not one row per order line.  Marts
are stored unsorted; ``in_report_order`` sorts on read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.numbers import safe_ratio
from marlstone.operators.joins import join_with_unknown_member
from marlstone.operators.shares import share_of_total


def _cents(amount: Column) -> Column:
    return F.round(amount, 2)


def _revenue() -> Column:
    """Line revenue as an exact decimal.

    It is already rounded to the cent, and a sum of decimals does not depend on
    the order of the rows, so a re-run or a re-tried task gives the same mart.
    """
    return F.col("revenue").cast("decimal(18,2)")


def mv_revenue_daily(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, lines, units and revenue per calendar day.

    Grouped by the day key; the six calendar attributes follow from it.
    """
    per_day = fact.where(F.col("date_sk").isNotNull()).groupBy("date_sk").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("quantity").alias("units_sold"),
        _cents(F.sum(_revenue())).alias("total_revenue"),
        _cents(F.avg(_revenue())).alias("avg_line_revenue"),
    )
    days = dates.select("date_sk", "full_date", "year", "quarter", "month", "month_name", "is_weekend")
    return per_day.join(days, "date_sk").select(
        "full_date", "year", "quarter", "month", "month_name", "is_weekend",
        "order_count", "line_item_count", "units_sold", "total_revenue", "avg_line_revenue",
    )


def mv_sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, products, units and revenue per product category.

    Two distinct counts in one aggregate would make Catalyst copy every line three
    times.  The products sold are few, so they are counted on their own from one
    column of the fact.
    """
    category = products.select("product_sk", "product_category")
    lines = fact.select("order_id", "item_seq", "product_sk", "quantity", "unit_price", "revenue")
    sales = (
        join_with_unknown_member(lines, category, "product_sk", ["order_id", "item_seq"])
        .groupBy("product_category")
        .agg(
            F.countDistinct("order_id").alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            _cents(F.sum(_revenue())).alias("total_revenue"),
            _cents(F.avg("unit_price")).alias("avg_unit_price"),
        )
    )
    sold = (
        fact.select("product_sk").distinct().join(category, "product_sk")
        .groupBy(F.col("product_category").alias("_category"))
        .agg(F.count(F.lit(1)).alias("distinct_products"))
    )
    return sales.join(sold, F.col("product_category").eqNullSafe(F.col("_category"))).select(
        "product_category", "order_count", "distinct_products",
        "units_sold", "total_revenue", "avg_unit_price",
    )


def mv_sales_by_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, orders, units and revenue per customer state.

    Lines collapse to orders and orders to customers before the state is known, so
    no distinct count is left: an order belongs to one customer in the fact.
    """
    per_order = (
        fact.where(F.col("customer_sk").isNotNull()).groupBy("customer_sk", "order_id")
        .agg(F.sum("quantity").alias("units"), F.sum(_revenue()).alias("revenue"))
    )
    per_version = per_order.groupBy("customer_sk").agg(
        F.count("order_id").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
    )
    per_customer = (
        per_version.join(customers.select("customer_sk", "customer_id", "state"), "customer_sk")
        .groupBy("state", "customer_id")
        .agg(*[F.sum(c).alias(c) for c in ("orders", "units", "revenue")])
    )
    totals = per_customer.groupBy("state").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("orders").alias("order_count"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
    )
    return totals.select(
        "state", "customer_count", "order_count", "units_sold",
        _cents(F.col("revenue")).alias("total_revenue"),
        _cents(safe_ratio(F.col("revenue"), F.col("order_count"))).alias("avg_order_value"),
    )


def mv_order_funnel(orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Orders and revenue per status, orders without lines included.

    Lines collapse to one row per order before the join, so a hot order is one row
    on either side and no line is moved for the join.
    """
    per_order = fact.groupBy("order_id").agg(
        F.sum(_revenue()).alias("revenue"), F.count("revenue").alias("lines")
    )
    return (
        orders.select("order_id", "order_status").join(per_order, "order_id", "left")
        .groupBy("order_status")
        .agg(
            F.countDistinct("order_id").alias("order_count"),
            _cents(F.sum("revenue")).alias("total_revenue"),
            _cents(safe_ratio(F.sum("revenue"), F.sum("lines"))).alias("avg_line_revenue"),
        )
    )


def mv_review_summary(reviews: DataFrame) -> DataFrame:
    """Distribution of review scores with verification and engagement."""
    per_score = reviews.groupBy("score").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.sum(F.when(F.col("verified"), 1).otherwise(0)).alias("verified_count"),
        F.round(F.avg("helpful_votes"), 1).alias("avg_helpful_votes"),
        F.count("comment").alias("reviews_with_comment"),
    )
    return per_score.select(
        "score", "review_count",
        F.round(share_of_total(F.col("review_count")), 1).alias("pct_of_reviews"),
        "verified_count", "avg_helpful_votes", "reviews_with_comment",
    )


# The column each report is sorted by, largest first.
REPORT_ORDER = {
    "mv_sales_by_category": "total_revenue",
    "mv_sales_by_state": "total_revenue",
    "mv_order_funnel": "order_count",
    "mv_review_summary": "score",
}


def in_report_order(mart: DataFrame, name: str) -> DataFrame:
    return mart.orderBy(F.col(REPORT_ORDER[name]).desc()) if name in REPORT_ORDER else mart
