from datetime import datetime

import pytest
from pyspark.sql import Observation

from marlstone.operators.dedup import dedup_by_key, latest_by_key
from marlstone.operators.quality import (
    DROP, RULES, apply_rules, dq_metrics, key_collisions, key_resolution, unresolved_references,
)

TS = datetime(2024, 1, 1)
SCHEMAS = {
    "customers": "customer_id string, email string, signup_date string, signup_ts timestamp",
    "products": "product_id string, base_price double, weight_grams int",
    "sellers": "seller_id string, seller_name string",
    "orders": "order_id string, customer_id string, order_status string, order_total double, "
              "order_date string, order_ts timestamp",
    "order_items": "order_id string, item_seq int, product_id string, seller_id string, "
                   "quantity int, unit_price double",
    "payments": "order_id string, amount double, payment_type string",
    "reviews": "review_id string, order_id string, score bigint, review_date string, review_ts timestamp",
}
GOOD = {
    "customers": ("c1", "a@b.example", "2024-01-01", TS),
    "products": ("p1", 1.0, 10),
    "sellers": ("s1", "name"),
    "orders": ("o1", "c1", "paid", 1.0, "2024-01-01", TS),
    "order_items": ("o1", 1, "p1", "s1", 1, 1.0),
    "payments": ("o1", 1.0, "boleto"),
    "reviews": ("r1", "o1", 5, "2024-01-01", TS),
}
# (entity, rule, column, value, violated)
CASES = [
    ("customers", "valid_customer_id", "customer_id", None, True),
    ("customers", "valid_email_format", "email", "no-at.example", True),
    ("customers", "valid_email_format", "email", "a@bxc", True),
    ("customers", "valid_email_format", "email", None, False),
    ("customers", "parseable_signup_date", "signup_ts", None, True),
    ("customers", "parseable_signup_date", "signup_date", None, False),
    ("products", "valid_product_id", "product_id", None, True),
    ("products", "positive_price", "base_price", 0.0, True),
    ("products", "positive_price", "base_price", -1.0, True),
    ("products", "positive_price", "base_price", None, True),
    ("products", "weight_present", "weight_grams", None, True),
    ("sellers", "valid_seller_id", "seller_id", None, True),
    ("sellers", "seller_name_present", "seller_name", None, True),
    ("orders", "valid_order_id", "order_id", None, True),
    ("orders", "has_customer", "customer_id", None, True),
    ("orders", "known_status", "order_status", "on hold", True),
    ("orders", "known_status", "order_status", None, True),
    ("orders", "non_negative_total", "order_total", -0.01, True),
    ("orders", "non_negative_total", "order_total", None, False),
    ("orders", "parseable_order_date", "order_ts", None, True),
    ("orders", "parseable_order_date", "order_date", None, False),
    ("order_items", "valid_order_ref", "order_id", None, True),
    ("order_items", "valid_item_seq", "item_seq", None, True),
    ("order_items", "has_product", "product_id", None, True),
    ("order_items", "has_seller", "seller_id", None, True),
    ("order_items", "positive_quantity", "quantity", 0, True),
    ("order_items", "positive_quantity", "quantity", None, True),
    ("order_items", "unit_price_present", "unit_price", None, True),
    ("payments", "valid_order_ref", "order_id", None, True),
    ("payments", "non_negative_amount", "amount", -1.0, True),
    ("payments", "non_negative_amount", "amount", None, False),
    ("payments", "known_payment_type", "payment_type", "cash", True),
    ("payments", "known_payment_type", "payment_type", None, True),
    ("reviews", "valid_review_id", "review_id", None, True),
    ("reviews", "valid_order_ref", "order_id", None, True),
    ("reviews", "valid_score", "score", 0, True),
    ("reviews", "valid_score", "score", 6, True),
    ("reviews", "valid_score", "score", None, True),
    ("reviews", "parseable_review_date", "review_ts", None, True),
    ("reviews", "parseable_review_date", "review_date", None, False),
]


def test_every_rule_has_a_violating_case():
    rules = {(entity, rule.name) for entity, rules in RULES.items() for rule in rules}
    assert len(rules) == 26
    assert {(e, r) for e, r, *_, violated in CASES if violated} == rules


@pytest.mark.parametrize("entity", list(RULES))
def test_rules(spark, entity):
    columns = [c.split()[0] for c in SCHEMAS[entity].split(", ")]
    cases = [c for c in CASES if c[0] == entity]
    rows = [GOOD[entity]] + [
        tuple(value if name == column else good for name, good in zip(columns, GOOD[entity]))
        for _, _, column, value, _ in cases
    ]
    df = spark.createDataFrame(rows, SCHEMAS[entity])
    expected = {rule.name: sum(c[4] for c in cases if c[1] == rule.name) for rule in RULES[entity]}
    metrics = {r.rule: r for r in dq_metrics(df, RULES[entity], entity).collect()}
    assert {name: m.rows_failed for name, m in metrics.items()} == expected
    for rule in RULES[entity]:
        metric = metrics[rule.name]
        assert metric.rows_checked == len(rows)
        assert metric.rows_passed == len(rows) - expected[rule.name]
        assert metric.rows_dropped == (expected[rule.name] if rule.action == DROP else 0)

    observation = Observation()
    kept = apply_rules(df, RULES[entity], observation).count()
    dropping = {rule.name for rule in RULES[entity] if rule.action == DROP}
    assert kept == len(rows) - sum(c[4] for c in cases if c[1] in dropping)
    assert {k: v for k, v in observation.get.items() if k != "rows_checked"} == expected


def test_key_resolution_and_anti_join(spark):
    fact = spark.createDataFrame([(1, 5), (-1, 6), (-1, None)], "product_sk long, seller_sk long")
    rows = {r.dimension_key: (r.total_rows, r.resolved_rows, r.unresolved_rows)
            for r in key_resolution(fact, ["product_sk", "seller_sk"]).collect()}
    assert rows == {"product_sk": (3, 1, 2), "seller_sk": (3, 2, 1)}
    dimension = spark.createDataFrame([(5,)], "seller_sk long")
    assert [tuple(r) for r in unresolved_references(fact, dimension, "seller_sk").collect()] == [(6, 1)]


def test_key_collisions(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, sk long")
    assert tuple(key_collisions(rows, ["k"], "sk").first()) == (3, 3, 2)


def test_dedup_keeps_the_smallest_row_and_one_null_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, None, "m"), ("b", 3, None)],
        "k string, n int, s string")
    rows = {r.k: (r.n, r.s) for r in dedup_by_key(df, ["k"]).collect()}
    assert rows == {"a": (1, "y"), None: (None, "m"), "b": (3, None)}
    ordered = {r.k: r.s for r in dedup_by_key(df, ["k"], order_by=["s"]).collect()}
    assert ordered == {"a": "x", None: "m", "b": None}
    latest = {r.k: (r.n, r.s) for r in latest_by_key(df, ["k"], "n").collect()}
    assert latest == {"a": (2, "x"), None: (5, "n"), "b": (3, None)}
    assert dedup_by_key(df.select("k"), ["k"]).count() == 3
