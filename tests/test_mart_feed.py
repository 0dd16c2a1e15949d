"""Marts merged from partial aggregates of runs."""

import random
from decimal import Decimal

import pytest

from marlstone.plans import dimensions
from marlstone.sources.tables import TableStore
from marlstone.streaming.marts import MartFeed, order_bitmaps, orders_in

ORDERS = "order_id string, customer_id string, order_status string, order_date string, order_ts timestamp, order_total double"
ITEMS = "order_id string, item_seq int, product_id string, seller_id string, quantity int, unit_price double"
PRODUCTS = "product_id string, product_category string, product_name string, base_price double, weight_grams int"
REVIEWS = ("review_id string, order_id string, score bigint, comment string, review_date string, review_ts timestamp, "
           "verified boolean, helpful_votes bigint")
SCHEMAS = {"slv_orders": ORDERS, "slv_order_items": ITEMS, "slv_products": PRODUCTS, "slv_reviews": REVIEWS}


@pytest.fixture()
def store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for table, schema in SCHEMAS.items():
        store.open_stream_version("silver", table)
        store.store_schema("silver", table, spark.createDataFrame([], schema).schema)
    return store


def deliver(store, table, batch_id, rows):
    store.append(store.spark.createDataFrame(rows, SCHEMAS[table]), "silver", table, batch_id)


def order(i, customer="c1", status="paid", day="2024-01-05 00:00:00"):
    from datetime import datetime

    return (f"o{i}", customer, status, day, datetime.fromisoformat(day), 1.0)


def line(i, seq, product="p1", quantity=2, price=10.0):
    return (f"o{i}", seq, product, "s1", quantity, price)


def by_category(feed):
    return {r["product_category"]: tuple(float(v) if isinstance(v, Decimal) else v for v in r)[1:]
            for r in feed.sales_by_category().collect()}


def test_lines_wait_for_their_order_and_their_product(spark, store):
    feed = MartFeed(store)
    deliver(store, "slv_order_items", 0, [line(1, 1), line(1, 2, "p2"), line(2, 1, "p9")])
    deliver(store, "slv_orders", 0, [order(1)])
    assert feed.run()
    assert by_category(feed) == {"unknown": (1, 1, 4, 40.0, 10.0)}
    assert store.read("gold", "waiting_lines").count() == 1
    deliver(store, "slv_products", 0, [("p1", "toys", "a", 1.0, 1)])
    deliver(store, "slv_orders", 1, [order(2)])
    assert feed.run()
    assert by_category(feed) == {"toys": (1, 1, 2, 20.0, 10.0), "unknown": (2, 1, 4, 40.0, 10.0)}
    deliver(store, "slv_products", 1, [("p2", "toys", "b", 1.0, 1), ("p9", None, "c", 1.0, 1)])
    assert feed.run()
    # One order with two lines of toys, taken in by two runs, is one order.
    assert by_category(feed) == {"toys": (1, 2, 4, 40.0, 10.0), None: (1, 1, 2, 20.0, 10.0)}
    assert feed.unresolved().count() == 0 and store.read("gold", "waiting_lines").count() == 0
    assert not feed.run(), "nothing new"


def test_an_order_spread_over_runs_is_counted_once(spark, store):
    feed = MartFeed(store)
    deliver(store, "slv_orders", 0, [order(1), order(2, status="placed")])
    for n in range(3):
        deliver(store, "slv_order_items", n, [line(1, n, price=None if n == 0 else 5.0), line(2, n, quantity=1, price=0.5)])
        feed.run()
    (row,) = feed.revenue_daily(dimensions.dim_date(spark, "2024-01-01", "2024-01-31")).collect()
    assert (row.order_count, row.line_item_count, row.units_sold, float(row.total_revenue), float(row.avg_line_revenue)) == (
        2, 6, 9, 21.5, 4.3)
    funnel = {r.order_status: (r.order_count, float(r.total_revenue)) for r in feed.order_funnel().collect()}
    assert funnel == {"paid": (1, 20.0), "placed": (1, 1.5)}
    customers = spark.createDataFrame([("c1", "TX", True), ("c1", "CA", False)], "customer_id string, state string, is_current boolean")
    (state,) = feed.sales_by_state(customers).collect()
    assert (state.state, state.customer_count, state.order_count, state.units_sold, float(state.avg_order_value)) == (
        "TX", 1, 2, 9, 10.75)


@pytest.mark.parametrize("stop_at", ["order_numbers", "waiting_lines", "unresolved_lines", "part_category", "part_reviews"])
def test_a_stopped_run_is_finished_with_the_input_it_began_with(spark, store, monkeypatch, stop_at):
    feed = MartFeed(store)
    deliver(store, "slv_orders", 0, [order(1), order(2)])
    deliver(store, "slv_order_items", 0, [line(1, 1), line(3, 1)])
    deliver(store, "slv_products", 0, [("p1", "toys", "a", 1.0, 1)])
    feed.run()
    deliver(store, "slv_orders", 1, [order(3)])
    deliver(store, "slv_order_items", 1, [line(2, 1)])
    commit = TableStore.commit

    def stop(self, layer, table, *args, **parts):
        if table == stop_at:
            raise RuntimeError
        return commit(self, layer, table, *args, **parts)

    monkeypatch.setattr(TableStore, "commit", stop)
    with pytest.raises(RuntimeError):
        feed.run()
    monkeypatch.setattr(TableStore, "commit", commit)
    # More comes in before the run is repeated: it belongs to the next one.
    deliver(store, "slv_order_items", 2, [line(1, 2)])
    assert feed.run() and feed.run() and not feed.run()
    assert by_category(feed) == {"toys": (3, 1, 8, 80.0, 10.0)}
    numbers = [r.order_no for r in store.read("gold", "order_numbers").collect()]
    assert sorted(numbers) == [1, 2, 3], "numbers are dense and given once"


def test_a_source_built_anew_starts_the_marts_anew(spark, store):
    feed = MartFeed(store)
    deliver(store, "slv_orders", 0, [order(1)])
    deliver(store, "slv_order_items", 0, [line(1, 1)])
    feed.run()
    store.open_stream_version("silver", "slv_orders")
    store.store_schema("silver", "slv_orders", spark.createDataFrame([], ORDERS).schema)
    deliver(store, "slv_orders", 0, [order(1, status="returned")])
    assert feed.run()
    assert [(r.order_status, r.order_count) for r in feed.order_funnel().collect()] == [("returned", 1)]


def test_bitmaps_count_exactly(spark):
    draw = random.Random(1)
    runs = [[(draw.choice("xy"), draw.randint(1, 100_000)) for _ in range(5_000)] for _ in range(3)]
    merged = None
    for run in runs:
        bitmaps = order_bitmaps(spark.createDataFrame(run, "g string, order_no long"), "g")
        merged = bitmaps if merged is None else merged.unionByName(bitmaps)
    everything = sum(runs, [])
    expected = {g: len({n for h, n in everything if h == g}) for g in "xy"}
    assert {r.g: r.order_count for r in orders_in(merged, "g").collect()} == expected
    # Numbers collapse to bitmaps before any shuffle.
    plan = order_bitmaps(spark.createDataFrame(runs[0], "g string, order_no long"), "g")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange") == 1


def test_empty_runs_and_null_days(spark, store):
    feed = MartFeed(store)
    assert feed.run() and not feed.run()
    assert feed.sales_by_category().count() == 0 and feed.order_funnel().count() == 0
    deliver(store, "slv_orders", 0, [("o1", "c1", None, "soon", None, None)])
    deliver(store, "slv_order_items", 0, [line(1, 1)])
    feed.run()
    assert feed.revenue_daily(dimensions.dim_date(spark, "2024-01-01", "2024-01-31")).count() == 0
    assert [(r.order_status, r.order_count, float(r.total_revenue)) for r in feed.order_funnel().collect()] == [(None, 1, 20.0)]
