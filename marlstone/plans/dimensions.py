"""Dimensions: calendar, product, seller, customer history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.keys import UNKNOWN_SK, date_key, surrogate_key
from marlstone.operators.history import END, START, scd2_versions
from marlstone.operators.unions import with_sentinel
from marlstone.sources.calendar import FIRST_DAY, LAST_DAY, calendar_days

# The catch-all product row.
UNKNOWN_PRODUCT = {
    "product_sk": UNKNOWN_SK,
    "product_id": "UNKNOWN",
    "product_category": "unknown",
    "product_name": "Unknown Product",
}


def describe_days(days: DataFrame) -> DataFrame:
    """Time attributes of each ``full_date``."""
    day = F.col("full_date")
    day_of_week = F.dayofweek(day)  # Sunday is 1, Saturday is 7
    return days.select(
        date_key(day).alias("date_sk"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        day_of_week.alias("day_of_week"),
        day_of_week.isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return describe_days(calendar_days(spark, first, last))


def dim_product(products: DataFrame) -> DataFrame:
    """Current products with a hashed key, and the unknown member."""
    keyed = products.select(
        surrogate_key("product_id").alias("product_sk"),
        "product_id", "product_category", "product_name", "base_price", "weight_grams",
    )
    return with_sentinel(keyed, UNKNOWN_PRODUCT)


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        surrogate_key("seller_id").alias("seller_sk"),
        "seller_id", "seller_name", "seller_city", "seller_state",
    )


def dim_customer(customers: DataFrame, sequence: str = "signup_ts", **options) -> DataFrame:
    """Full history of customers; options go to ``scd2_versions``."""
    return scd2_versions(customers, ["customer_id"], sequence, **options)


def dim_customer_keyed(versions: DataFrame) -> DataFrame:
    """Per-version surrogate key and readable validity columns."""
    return versions.select(
        surrogate_key("customer_id", START).alias("customer_sk"),
        "customer_id", "customer_name", "email", "city", "state", "signup_ts",
        F.col(START).alias("valid_from"),
        F.col(END).alias("valid_to"),
        F.col(END).isNull().alias("is_current"),
    )
