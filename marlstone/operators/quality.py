"""Named data-quality rules: warn or drop, and the counts behind them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP = "warn", "drop"


@dataclass(frozen=True)
class Rule:
    """A predicate rows should meet; NULL counts as a violation."""

    name: str
    action: str
    predicate: str

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


def _rules(*entries: tuple[str, str, str]) -> tuple[Rule, ...]:
    return tuple(Rule(*entry) for entry in entries)


# Rule names, what a violation does, and the predicate.
RULES: dict[str, tuple[Rule, ...]] = {
    "customers": _rules(
        ("valid_customer_id", DROP, "customer_id IS NOT NULL"),
        ("valid_email_format", WARN, "email IS NULL OR email RLIKE '^[^@]+@[^@]+[.][^@]+$'"),
        ("parseable_signup_date", WARN, "signup_date IS NULL OR signup_ts IS NOT NULL"),
    ),
    "products": _rules(
        ("valid_product_id", DROP, "product_id IS NOT NULL"),
        ("positive_price", DROP, "base_price > 0"),
        ("weight_present", WARN, "weight_grams IS NOT NULL"),
    ),
    "sellers": _rules(
        ("valid_seller_id", DROP, "seller_id IS NOT NULL"),
        ("seller_name_present", WARN, "seller_name IS NOT NULL"),
    ),
    "orders": _rules(
        ("valid_order_id", DROP, "order_id IS NOT NULL"),
        ("has_customer", DROP, "customer_id IS NOT NULL"),
        ("known_status", WARN,
         "order_status IN ('placed', 'paid', 'shipped', 'delivered', 'canceled', 'returned')"),
        ("non_negative_total", WARN, "order_total IS NULL OR order_total >= 0"),
        ("parseable_order_date", WARN, "order_date IS NULL OR order_ts IS NOT NULL"),
    ),
    "order_items": _rules(
        ("valid_order_ref", DROP, "order_id IS NOT NULL"),
        ("valid_item_seq", DROP, "item_seq IS NOT NULL"),
        ("has_product", DROP, "product_id IS NOT NULL"),
        ("has_seller", DROP, "seller_id IS NOT NULL"),
        ("positive_quantity", DROP, "quantity > 0"),
        ("unit_price_present", WARN, "unit_price IS NOT NULL"),
    ),
    "payments": _rules(
        ("valid_order_ref", DROP, "order_id IS NOT NULL"),
        ("non_negative_amount", WARN, "amount IS NULL OR amount >= 0"),
        ("known_payment_type", WARN,
         "payment_type IN ('credit_card', 'debit_card', 'voucher', 'boleto')"),
    ),
    "reviews": _rules(
        ("valid_review_id", DROP, "review_id IS NOT NULL"),
        ("valid_order_ref", DROP, "order_id IS NOT NULL"),
        ("valid_score", DROP, "score BETWEEN 1 AND 5"),
        ("parseable_review_date", WARN, "review_date IS NULL OR review_ts IS NOT NULL"),
    ),
}


def _metric_columns(rules: Sequence[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows_checked")] + [
        F.count_if(rule.violated()).alias(rule.name) for rule in rules
    ]


def violates_drop_rule(rules: Sequence[Rule]) -> Column:
    """True for rows that some drop rule keeps out; never NULL."""
    broken = [rule.violated() for rule in rules if rule.action == DROP]
    return F.coalesce(reduce(lambda a, b: a | b, broken), F.lit(False)) if broken else F.lit(False)


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every drop rule; warn rules do not filter."""
    predicates = [F.expr(rule.predicate) for rule in rules if rule.action == DROP]
    return df.where(reduce(lambda a, b: a & b, predicates)) if predicates else df


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], observe_as: Observation | str | None = None
) -> DataFrame:
    """Check every rule and drop what must go, in the pass that reads the rows.

    ``observe_as`` names the counts: an ``Observation`` for a batch write, a string
    for a stream (they then appear in the progress of the streaming query).  Such
    counts ride on task updates and may count a re-run task twice after a lost
    executor; ``dq_metrics`` is the exact form.
    """
    if observe_as is not None:
        df = df.observe(observe_as, *_metric_columns(rules))
    return keep_valid(df, rules)


def dq_metrics(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule: rows checked, passed, failed and dropped, exact."""
    counts = df.agg(*_metric_columns(rules))
    per_rule = F.explode(F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col(rule.name).alias("rows_failed"),
        )
        for rule in rules
    ]))
    return counts.select("rows_checked", per_rule.alias("r")).select(
        F.lit(table).alias("table_name"),
        "r.rule",
        "r.action",
        "rows_checked",
        (F.col("rows_checked") - F.col("r.rows_failed")).alias("rows_passed"),
        "r.rows_failed",
        F.when(F.col("r.action") == DROP, F.col("r.rows_failed")).otherwise(0).alias("rows_dropped"),
    )


def key_resolution(fact: DataFrame, keys: Sequence[str], unknown: int = -1) -> DataFrame:
    """Per dimension key: fact rows in total, resolved, and on NULL or the unknown member."""
    unresolved = {k: F.col(k).isNull() | (F.col(k) == unknown) for k in keys}
    counts = fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(unresolved[k]).alias(k) for k in keys],
    )
    per_key = F.explode(F.array(*[
        F.struct(F.lit(k).alias("dimension_key"), F.col(k).alias("unresolved_rows")) for k in keys
    ]))
    return counts.select("total_rows", per_key.alias("r")).select(
        "r.dimension_key",
        "total_rows",
        (F.col("total_rows") - F.col("r.unresolved_rows")).alias("resolved_rows"),
        "r.unresolved_rows",
    )


def unresolved_references(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Reference values missing from the dimension, with the rows that carry them.

    Rows are counted per value first, so the anti join moves one row per value.
    """
    used = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(dimension.select(key), key, "left_anti")


def key_collisions(dimension: DataFrame, business_key: Sequence[str], surrogate: str) -> DataFrame:
    """Counts that prove a hashed key unique: rows, business keys, surrogate keys."""
    per_key = dimension.groupBy(*business_key, surrogate).agg(F.count(F.lit(1)).alias("n"))
    per_sk = per_key.groupBy(surrogate).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("business_keys")
    )
    return per_sk.agg(
        F.sum("n").alias("row_count"),
        F.sum("business_keys").alias("business_keys"),
        F.count(F.lit(1)).alias("surrogate_keys"),
    )
