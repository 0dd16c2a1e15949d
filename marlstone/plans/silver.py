"""Cleansing of the seven entities.

Each function takes raw rows, from a batch or from a stream, and returns the
fixed column list of the silver table; columns added by newer files stay in
bronze.  Quality rules run on the result (``cleansed``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation

from marlstone.functions import code_lower, code_upper, parse_messy_timestamp, tidy, title_case
from marlstone.operators.dedup import dedup_by_key
from marlstone.operators.nested import explode_struct_array, flatten_struct
from marlstone.operators.quality import RULES, apply_rules


def customers(raw: DataFrame) -> DataFrame:
    """One row per customer and signup time: the change log of the dimension."""
    cleaned = raw.select(
        "customer_id",
        "customer_name",
        tidy("email").alias("email"),
        title_case("city").alias("city"),
        code_upper("state").alias("state"),
        "signup_date",
        parse_messy_timestamp("signup_date").alias("signup_ts"),
    )
    return dedup_by_key(cleaned, ["customer_id", "signup_ts"])


def products(raw: DataFrame) -> DataFrame:
    unique = dedup_by_key(
        raw.select("product_id", "product_category", "product_name", "base_price", "weight_grams"),
        ["product_id"],
    )
    return unique.withColumns({
        "product_category": code_lower("product_category"),
        "product_name": tidy("product_name"),
    })


def sellers(raw: DataFrame) -> DataFrame:
    unique = dedup_by_key(
        raw.select("seller_id", "seller_name", "seller_city", "seller_state"), ["seller_id"]
    )
    return unique.withColumns({
        "seller_name": tidy("seller_name"),
        "seller_city": title_case("seller_city"),
        "seller_state": code_upper("seller_state"),
    })


def orders(raw: DataFrame) -> DataFrame:
    unique = dedup_by_key(
        raw.select("order_id", "customer_id", "order_status", "order_date", "order_total"),
        ["order_id"],
    )
    return unique.select(
        "order_id",
        "customer_id",
        code_lower("order_status").alias("order_status"),
        "order_date",
        parse_messy_timestamp("order_date").alias("order_ts"),
        "order_total",
    )


def order_items(raw: DataFrame) -> DataFrame:
    return dedup_by_key(
        raw.select("order_id", "item_seq", "product_id", "seller_id", "quantity", "unit_price"),
        ["order_id", "item_seq"],
    )


def payments(raw: DataFrame) -> DataFrame:
    """One row per installment; payments are taken as delivered, copies included."""
    return explode_struct_array(
        raw, "installments", ["order_id", "payment_type"], ["installment_no", "amount", "paid"]
    )


def reviews(raw: DataFrame) -> DataFrame:
    """Reviews are taken as delivered, copies included."""
    flat = flatten_struct(
        raw.select("review_id", "order_id", "score", "comment", "review_date", "meta"),
        "meta", {"verified": "verified", "helpful_votes": "helpful_votes"},
    )
    return flat.select(
        "review_id",
        "order_id",
        "score",
        tidy("comment").alias("comment"),
        "review_date",
        parse_messy_timestamp("review_date").alias("review_ts"),
        "verified",
        "helpful_votes",
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": customers,
    "products": products,
    "sellers": sellers,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "reviews": reviews,
}


# What identifies a row of the entities that are deduplicated.
DEDUP_KEYS = {
    "customers": ["customer_id", "signup_ts"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "item_seq"],
}


def cleansed(entity: str, raw: DataFrame, observe_as: Observation | str | None = None) -> DataFrame:
    """The silver table of an entity: cleaned, deduplicated, rules applied."""
    return apply_rules(CLEANERS[entity](raw), RULES[entity], observe_as)
