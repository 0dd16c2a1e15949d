"""One run from landing files to marts, and the reset of a table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession

from marlstone.operators.history import unsequenced
from marlstone.operators.slices import slice_of, slices_for
from marlstone.plans import dimensions, marts
from marlstone.plans.facts import fct_sales
from marlstone.plans.silver import DEDUP_KEYS
from marlstone.schemas import ENTITIES
from marlstone.session import configure, freeing_shuffles, side_by_side
from marlstone.sources.calendar import calendar_days, calendar_span
from marlstone.sources.tables import TableStore
from marlstone.streaming.balance import balance
from marlstone.streaming.bronze import refresh_bronze
from marlstone.streaming.history import refresh_history
from marlstone.streaming.silver import refresh_silver

# With more stored bytes of silver, views are made one after the other: each fills the cores, and only its shuffles are there.
LARGE_SILVER = 1 << 30


def refresh_gold(store: TableStore, first: str | None = None, last: str | None = None) -> list[str]:
    """Bring every gold table up to date with the silver tables; returns the ones that were written.

    The customer history takes in new changes only.  A view whose inputs are as they were when it was
    made is left alone.  The calendar spans the orders, so no sale falls outside it, unless bounds are given.
    Changes of customers without a date have no place in the history; they are kept in
    ``dim_customer_quarantine``.
    """
    def silver(name):
        return store.read("silver", f"slv_{name}")

    def gold(name):
        return store.read("gold", name)

    def of(*names):
        return [("silver", f"slv_{n}") if n in ENTITIES else ("gold", n) for n in names]

    def days():
        return calendar_days(store.spark, first, last) if first and last else calendar_span(silver("orders"), "order_ts")

    def history():
        before = store.state_of("gold", "dim_customer")
        refresh_history(store, ("silver", "slv_customers"), ("gold", "dim_customer"), ["customer_id"], "signup_ts",
                        tags={"email": {"sensitivity": "pii"}})
        return store.state_of("gold", "dim_customer") != before

    def fact():
        slices = slices_for(store.stored_bytes("silver", "slv_order_items"))
        lines, orders = silver("order_items"), silver("orders")
        dimensions_of = [gold(name) for name in ("dim_customer_keyed", "dim_product", "dim_seller", "dim_date")]
        return [fct_sales(slice_of(lines, ["order_id"], n, slices), slice_of(orders, ["order_id"], n, slices), *dimensions_of)
                for n in range(slices)]

    views = [
        ("dim_date", of("orders"), lambda: dimensions.describe_days(days())),
        ("dim_customer_quarantine", of("customers"), lambda: unsequenced(silver("customers"), "signup_ts")),
        ("dim_product", of("products"), lambda: dimensions.dim_product(silver("products"))),
        ("dim_seller", of("sellers"), lambda: dimensions.dim_seller(silver("sellers"))),
        ("dim_customer_keyed", of("dim_customer"), lambda: dimensions.dim_customer_keyed(gold("dim_customer"))),
        ("fct_sales", of("order_items", "orders", "dim_customer_keyed", "dim_product", "dim_seller", "dim_date"), fact),
        ("mv_revenue_daily", of("fct_sales", "dim_date"),
         lambda: marts.mv_revenue_daily(gold("fct_sales"), gold("dim_date"))),
        ("mv_sales_by_category", of("fct_sales", "dim_product"),
         lambda: marts.mv_sales_by_category(gold("fct_sales"), gold("dim_product"))),
        ("mv_sales_by_state", of("fct_sales", "dim_customer_keyed"),
         lambda: marts.mv_sales_by_state(gold("fct_sales"), gold("dim_customer_keyed"))),
        ("mv_order_funnel", of("orders", "fct_sales"),
         lambda: marts.mv_order_funnel(silver("orders"), gold("fct_sales"))),
        ("mv_review_summary", of("reviews"), lambda: marts.mv_review_summary(silver("reviews"))),
    ]
    bounds = f"{first} {last}"
    views.append(("run_balance", [
        *[("bronze", e.bronze) for e in ENTITIES.values()], *of(*ENTITIES, "fct_sales")], lambda: balance(store)))
    steps = {"dim_customer": (set(), history)} | {
        name: ({n for layer, n in inputs if layer == "gold"}, partial(
            store.refresh_view, "gold", name, inputs, build, bounds if name == "dim_date" else ""))
        for name, inputs, build in views}
    large = sum(store.stored_bytes("silver", e.silver) for e in ENTITIES.values()) > LARGE_SILVER
    done: dict[str, bool] = {}
    while len(done) < len(steps):
        # Views whose inputs are up to date need nothing of each other.
        ready = [n for n, (needs, _) in steps.items() if n not in done and needs <= done.keys()]
        done |= zip(ready, side_by_side(store.spark, [steps[n][1] for n in ready], 1 if large else 8))
    return [name for name in steps if done[name]]


def run_medallion(
    spark: SparkSession, landing_root: str, table_root: str,
    first: str | None = None, last: str | None = None, evolve: bool = True,
) -> dict[str, dict[str, int]]:
    """Ingest what is new, cleanse it, bring gold up to date.

    Returns the rule counts per entity, and the rows kept out of the customer history.
    """
    store = TableStore(configure(spark), table_root)

    def layers(entity):
        refresh_bronze(store, entity, landing_root, evolve)
        return refresh_silver(store, entity)

    with freeing_shuffles(store.spark):
        counts = dict(zip(ENTITIES, side_by_side(store.spark, [partial(layers, entity) for entity in ENTITIES])))
        refresh_gold(store, first, last)
    return counts | {"dim_customer_quarantine": {"rows": store.read("gold", "dim_customer_quarantine").count()}}


def full_refresh(
    store: TableStore, entity: str, landing_root: str, layer: str = "bronze", evolve: bool = True
) -> None:
    """Rebuild one streaming table, and all tables built from it, from the start.

    Old versions stay on storage for running readers.  Gold is rebuilt where all silver
    tables exist.
    """
    tables = ENTITIES[entity]
    if layer == "bronze":
        store.open_stream_version("bronze", tables.bronze)
        refresh_bronze(store, entity, landing_root, evolve)
    if entity in DEDUP_KEYS:
        store.open_stream_version("silver", f"{tables.silver}_arrivals")
    store.open_stream_version("silver", tables.silver)
    refresh_silver(store, entity)
    if all(store.stream_version("silver", e.silver) for e in ENTITIES.values()):
        refresh_gold(store)
