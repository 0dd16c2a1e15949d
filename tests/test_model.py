import random
from collections import defaultdict
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marlstone.functions.keys import UNKNOWN_SK
from marlstone.operators import shares
from marlstone.operators.joins import join_with_unknown_member
from marlstone.operators.unions import literal_row, union_all
from marlstone.plans import dimensions, kpis, marts
from marlstone.plans.facts import fct_sales


def plain(row):
    """A row with decimals as floats."""
    return tuple(float(v) if isinstance(v, Decimal) else v for v in row)


def test_default_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 1461 and days.select("date_sk").distinct().count() == 1461
    row = days.where(F.col("full_date") == date(2024, 2, 29)).first()
    assert tuple(row) == (20240229, date(2024, 2, 29), 2024, 1, 2, "February", 29, "Thursday", 5, False)
    weekend = days.where(F.col("is_weekend")).select("day_name").distinct().collect()
    assert {r.day_name for r in weekend} == {"Saturday", "Sunday"}


def test_unknown_member_and_unions(spark):
    products = spark.createDataFrame([("p1", "c", "n", 1.0, 2)],
                                     "product_id string, product_category string, product_name string, "
                                     "base_price double, weight_grams int")
    dim = dimensions.dim_product(products)
    unknown = dim.where(F.col("product_sk") == UNKNOWN_SK).first()
    assert tuple(unknown) == (-1, "UNKNOWN", "unknown", "Unknown Product", None, None)
    assert dim.dtypes == literal_row(dim, {}).dtypes
    assert union_all(products, products.drop("weight_grams"), products).count() == 3


@pytest.fixture(scope="module")
def star(spark):
    """A random star: a hot product that is unknown, a hot order, orphans of every kind."""
    rng = random.Random(1)
    orders = [(f"o{i}", rng.choice(["c0", "c1", "c2", "c9"]), rng.choice(["paid", "placed", "shipped"]),
               datetime(2024, rng.randint(1, 12), rng.randint(1, 28), 5) if rng.random() < 0.9 else None)
              for i in range(60)]
    items = [("o1" if rng.random() < 0.3 else f"o{rng.randrange(50)}", i,
              "gone" if rng.random() < 0.4 else f"p{rng.randrange(5)}", f"s{rng.randrange(4)}",
              rng.randint(1, 5), rng.choice([None, -1.0, 0.0, 2.25, 10.5])) for i in range(500)]
    items += [("lost", 9000, "p1", "s1", 1, 1.0)]
    customers = [(100 + i, f"c{i}", f"TX{i % 2}", datetime(2024, m, 1), m == 7)
                 for i in range(3) for m in (3, 7)]
    customers = [(sk + m.month * 1000, c, st, m, cur) for sk, c, st, m, cur in customers]
    return {
        "orders": orders, "items": items, "customers": customers,
        "fact": lambda **kw: fct_sales(
            spark.createDataFrame(items, "order_id string, item_seq int, product_id string, seller_id string, "
                                         "quantity int, unit_price double"),
            spark.createDataFrame(orders, "order_id string, customer_id string, order_status string, order_ts timestamp"),
            spark.createDataFrame(customers, "customer_sk long, customer_id string, state string, "
                                             "valid_from timestamp, is_current boolean"),
            spark.createDataFrame([(i, f"p{i}") for i in range(5)] + [(-1, "UNKNOWN")], "product_sk long, product_id string"),
            spark.createDataFrame([(i, f"s{i}") for i in range(3)], "seller_sk long, seller_id string"),
            dimensions.dim_date(spark, "2024-01-01", "2024-11-30"), **kw),
    }


def expected_fact(star, as_of="current"):
    orders = {o: (c, s, t) for o, c, s, t in star["orders"]}
    out = {}
    for order, seq, product, seller, quantity, price in star["items"]:
        if order not in orders:
            continue
        customer, status, moment = orders[order]
        versions = [(start, sk) for sk, c, _, start, current in star["customers"] if c == customer
                    and (current if as_of == "current" else moment is not None and start <= moment)]
        valid = price if price is not None and price > 0 else None
        in_calendar = moment is not None and moment < datetime(2024, 12, 1)
        out[(order, seq)] = (
            max(versions)[1] if versions else None,
            int(product[1:]) if product != "gone" else -1,
            int(seller[1:]) if seller != "s3" else None,
            int(moment.strftime("%Y%m%d")) if in_calendar else None,
            quantity, valid, round(quantity * valid, 2) if valid else None, status)
    return out


@pytest.mark.parametrize("as_of", ["current", "event"])
def test_fact(star, as_of):
    got = {(r[0], r[1]): tuple(r)[2:] for r in star["fact"](customer_as_of=as_of).collect()}
    assert got == expected_fact(star, as_of)


def test_fact_rejects_other_lookups(star):
    with pytest.raises(ValueError):
        star["fact"](customer_as_of="yesterday")


def test_marts_against_plain_python(spark, star):
    fact = star["fact"]()
    rows = [(k[0], *v) for k, v in expected_fact(star).items()]
    products = spark.createDataFrame(
        [(i, "odd" if i % 2 else "even") for i in range(5)] + [(-1, "unknown")], "product_sk long, product_category string")
    names = {i: ("odd" if i % 2 else "even") for i in range(5)} | {-1: "unknown"}
    groups = defaultdict(list)
    for r in rows:
        groups[names[r[2]]].append(r)
    expected = {}
    for name, rs in groups.items():
        prices = [r[6] for r in rs if r[6] is not None]
        expected[name] = (len({r[0] for r in rs}), len({r[2] for r in rs}), sum(r[5] for r in rs),
                          round(sum(r[7] for r in rs if r[7] is not None), 2), round(sum(prices) / len(prices) + 1e-9, 2))
    got = {r[0]: plain(r)[1:] for r in marts.mv_sales_by_category(fact, products).collect()}
    assert got == expected

    customers = spark.createDataFrame(star["customers"], "customer_sk long, customer_id string, state string, "
                                                         "valid_from timestamp, is_current boolean")
    by_sk = {sk: (c, st) for sk, c, st, *_ in star["customers"]}
    groups = defaultdict(list)
    for r in rows:
        if r[1] is not None:
            groups[by_sk[r[1]][1]].append(r)
    expected = {
        st: (len({by_sk[r[1]][0] for r in rs}), len({r[0] for r in rs}), sum(r[5] for r in rs),
             round(sum(r[7] or 0 for r in rs), 2)) for st, rs in groups.items()}
    got = {r[0]: plain(r)[1:5] for r in marts.mv_sales_by_state(fact, customers).collect()}
    assert got == expected

    orders = spark.createDataFrame(star["orders"], "order_id string, customer_id string, order_status string, order_ts timestamp")
    expected = {}
    for status in {o[2] for o in star["orders"]}:
        revenue = [r[7] for r in rows if r[8] == status and r[7] is not None]
        expected[status] = (sum(o[2] == status for o in star["orders"]), round(sum(revenue), 2))
    got = {r[0]: plain(r)[1:3] for r in marts.mv_order_funnel(orders, fact).collect()}
    assert got == expected

    days = dimensions.dim_date(spark, "2024-01-01", "2024-11-30")
    daily = marts.mv_revenue_daily(fact, days).collect()
    assert sum(r.line_item_count for r in daily) == sum(r[4] is not None for r in rows)
    assert sum(r.order_count for r in daily) == len({r[0] for r in rows if r[4] is not None})
    assert [r.order_status for r in marts.in_report_order(marts.mv_order_funnel(orders, fact), "mv_order_funnel").collect()] \
        == sorted((r for r in got), key=lambda s: -got[s][0])


def test_review_summary_and_quality(spark):
    rows = [(5, True, 10, "a")] * 2 + [(4, None, None, None)] + [(1, False, 3, "b")]
    summary = marts.mv_review_summary(spark.createDataFrame(rows, "score long, verified boolean, helpful_votes long, comment string"))
    got = {r.score: tuple(r)[1:] for r in summary.collect()}
    assert {k: (v[0], float(v[1]), *v[2:]) for k, v in got.items()} == {
        5: (2, 50.0, 2, 10.0, 2), 4: (1, 25.0, 0, None, 0), 1: (1, 25.0, 0, 3.0, 1)}
    assert sum(v[1] for v in got.values()) == 100
    quality = kpis.review_quality(summary).first()
    assert (quality.positive_pct, quality.negative_pct, quality.avg_rating) == (75.0, 25.0, 3.75)


def test_shares(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 20.0)], "k string, v double")
    running = {r.k: r.cumulative_pct for r in shares.cumulative_share(df, "v", "k").collect()}
    assert running == {"a": 50.0, "b": 80.0, "c": 100.0}
    assert [(r.k, r.share_pct) for r in shares.top_k_share(df, "v", 2, "k").collect()] == [("a", 50.0), ("b", 30.0)]
    assert shares.with_average(df, "v", "m").select("m").distinct().first().m == pytest.approx(100 / 3)


def test_hot_unknown_member_is_spread(spark):
    fact = spark.range(2000).select(
        F.when(F.col("id") < 1500, F.lit(-1)).otherwise(F.col("id") % 3).cast("long").alias("sk"), "id")
    dim = spark.createDataFrame([(-1, "u"), (0, "a"), (1, "b"), (2, "c")], "sk long, name string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_with_unknown_member(fact, dim, "sk", ["id"])
        assert joined.groupBy("name").count().where("name = 'u'").first()["count"] == 1500
        assert joined.count() == 2000 and joined.columns == ["sk", "id", "name"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
