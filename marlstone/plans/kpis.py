"""Headline numbers, computed from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.numbers import safe_ratio
from marlstone.operators.shares import cumulative_share, share_of_total, top_k, with_average


def totals(daily: DataFrame) -> DataFrame:
    """Revenue and orders overall.

    Daily order counts add up because an order has one date.
    """
    return daily.agg(
        F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
    )


def revenue_by_month(daily: DataFrame) -> DataFrame:
    """Revenue per month beside the mean month."""
    months = daily.groupBy("year", "month", "month_name").agg(
        F.round(F.sum("total_revenue"), 2).alias("month_revenue")
    )
    return with_average(months, "month_revenue", "avg_month_revenue")


def daily_trend(daily: DataFrame) -> DataFrame:
    """Revenue per day beside the mean day."""
    return with_average(daily.select("full_date", "total_revenue"), "total_revenue", "avg_day_revenue")


def category_pareto(by_category: DataFrame) -> DataFrame:
    """Categories by revenue with their share, the running share and units."""
    shared = by_category.select(
        "product_category", "units_sold", "total_revenue",
        share_of_total(F.col("total_revenue")).alias("revenue_pct"),
    )
    return cumulative_share(shared, "total_revenue", "product_category")


def state_shares(by_state: DataFrame) -> DataFrame:
    """Revenue share and customers per state."""
    return by_state.select(
        "state", "customer_count", "total_revenue",
        share_of_total(F.col("total_revenue")).alias("revenue_pct"),
    )


def top_states_share(by_state: DataFrame, k: int = 2) -> DataFrame:
    """Share of revenue of the ``k`` strongest states, as one row."""
    leaders = top_k(state_shares(by_state), "total_revenue", k, ["state"])
    return leaders.agg(
        F.count(F.lit(1)).alias("states"), F.sum("revenue_pct").alias("revenue_pct")
    )


def top_categories_share(by_category: DataFrame, k: int = 3) -> DataFrame:
    """Share of revenue of the ``k`` strongest categories, as one row."""
    leaders = top_k(category_pareto(by_category), "total_revenue", k, ["product_category"])
    return leaders.agg(
        F.count(F.lit(1)).alias("categories"), F.sum("revenue_pct").alias("revenue_pct")
    )


def review_quality(review_summary: DataFrame) -> DataFrame:
    """Positive (4 and up) and negative (2 and down) share, mean rating."""
    reviews = F.col("review_count")
    everyone = F.sum(reviews)
    return review_summary.agg(
        safe_ratio(F.sum(F.when(F.col("score") >= 4, reviews).otherwise(0)) * 100, everyone)
        .alias("positive_pct"),
        safe_ratio(F.sum(F.when(F.col("score") <= 2, reviews).otherwise(0)) * 100, everyone)
        .alias("negative_pct"),
        safe_ratio(F.sum(F.col("score") * reviews), everyone).alias("avg_rating"),
    )


def status_rates(funnel: DataFrame) -> DataFrame:
    """Delivered, canceled and returned orders as a share of all orders."""
    orders = F.col("order_count")

    def rate(status: str):
        hits = F.sum(F.when(F.col("order_status") == status, orders).otherwise(0))
        return safe_ratio(hits * 100, F.sum(orders))

    return funnel.agg(
        F.sum(orders).alias("order_count"),
        rate("delivered").alias("delivery_pct"),
        rate("canceled").alias("cancellation_pct"),
        rate("returned").alias("return_pct"),
    )
