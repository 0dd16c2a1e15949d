"""The sales fact: one row per order line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.keys import date_key
from marlstone.functions.numbers import line_revenue, positive_price
from marlstone.operators.history import point_in_time_join
from marlstone.operators.joins import (
    inner_equi_join, left_equi_join, left_join_current_version, left_join_on_expression,
    unknown_member_join,
)


def fct_sales(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame,
    sellers: DataFrame, dates: DataFrame, customer_as_of: str = "current",
) -> DataFrame:
    """Order lines of known orders with the keys of their dimensions.

    A missing product points at the unknown member; a missing customer, seller or
    day leaves its key NULL.  ``customer_as_of`` is ``current`` (today's version) or
    ``event`` (the version valid when the order was placed).

    Customer and calendar keys depend on the order alone, so they are attached to
    the orders before the lines come in: those joins move orders, not lines.
    """
    order_columns = orders.select("order_id", "customer_id", "order_status", "order_ts")
    if customer_as_of == "event":
        keyed = point_in_time_join(order_columns, customers, "customer_id", "order_ts", ["customer_sk"])
    elif customer_as_of == "current":
        keyed = left_join_current_version(order_columns, customers, "customer_id", ["customer_sk"])
    else:
        raise ValueError("customer_as_of is 'current' or 'event'")
    dated = left_join_on_expression(
        keyed.withColumn("_day", date_key("order_ts")), dates, F.col("_day"), "date_sk", ["date_sk"]
    )
    lines = inner_equi_join(items, dated, "order_id")
    lines = unknown_member_join(lines, products, "product_id", "product_sk")
    lines = left_equi_join(lines, sellers.select("seller_id", "seller_sk"), "seller_id")
    return lines.select(
        "order_id",
        "item_seq",
        "customer_sk",
        "product_sk",
        "seller_sk",
        "date_sk",
        "quantity",
        positive_price("unit_price").alias("unit_price"),
        line_revenue("quantity", "unit_price").alias("revenue"),
        "order_status",
    )
