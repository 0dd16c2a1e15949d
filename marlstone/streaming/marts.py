"""Marts from partial aggregates: every run aggregates new rows only, readers merge.

A run takes the silver batches committed since the last one and appends, per mart, sums and counts that
add up, and bitmaps of order numbers that are or-ed, so that an order whose lines come in
different runs is counted once.  Orders get dense numbers as they arrive; 32,768 of them make one bitmap.

Lines wait until their order is there (``waiting_lines``), and lines of a product nobody knows yet stay in
an index of their own (``unresolved_lines``, the unknown member) until it arrives.  Both are read
again at every run; what is neither waiting nor unresolved is never touched twice.

A run is planned first (which batches it takes) and each of its tables is committed under its number, so a run that
was stopped is finished by the next one with the same input.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.keys import date_key
from marlstone.functions.numbers import line_revenue, positive_price, safe_ratio
from marlstone.operators.shares import share_of_total
from marlstone.session import side_by_side
from marlstone.sources import files
from marlstone.sources.tables import TableStore

SOURCES = ("slv_orders", "slv_order_items", "slv_products", "slv_reviews")
PLANS = "mart_runs"
_MONEY = "decimal(38,2)"
_PRICE = "decimal(38,4)"

# The partial tables and what identifies a group in each.
PARTS = (
    "order_numbers", "mart_lines", "waiting_lines", "resolved_lines", "unresolved_lines", "part_daily",
    "part_daily_orders", "part_category", "part_category_orders", "part_category_products", "part_customer",
    "part_status", "part_status_orders", "part_reviews",
)


def order_bitmaps(lines: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of order numbers per group and bucket; partial bitmaps meet, order numbers do not."""
    return lines.groupBy(*by, F.bitmap_bucket_number("order_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("order_no")).alias("orders"))


def orders_in(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Exact distinct orders per group from the bitmaps of any number of runs."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("orders")).alias("order_count"))


def _sum(column: str, kind: str) -> Column:
    return F.sum(F.col(column).cast(kind)).cast(kind).alias(column)


class MartFeed:
    """The incremental marts of a store, fed by its silver tables."""

    def __init__(self, store: TableStore):
        self.store = store

    # -- runs ----------------------------------------------------------------

    def _note(self, name: str, content: dict | None = None) -> dict | None:
        text = self.store.note("gold", PLANS, name, None if content is None else json.dumps(content))
        return json.loads(text) if text else None

    def _state(self) -> dict[str, list[int]]:
        return {t: [self.store.stream_version("silver", t), self.store.commit_log("silver", t).last()] for t in SOURCES}

    def _runs_done(self) -> int:
        folder = f"{self.store.version_path('gold', PLANS, self.store.stream_version('gold', PLANS))}/done"
        return len(files.child_names(self.store.spark, folder))

    def _next(self) -> tuple[int, dict, dict] | None:
        """Number of the run, where its input begins and where it ends; none without new input."""
        store = self.store
        if not store.stream_version("gold", PLANS):
            self._open()
        done = self._runs_done()
        begin = self._note(f"plan-{done - 1}") if done else {t: [0, -1] for t in SOURCES}
        if done and any(begin[t][0] != store.stream_version("silver", t) for t in SOURCES):
            # A source was built anew: so are the marts.
            self._open()
            return self._next()
        end = self._note(f"plan-{done}")
        if end is None:
            end = self._state()
            if done and end == begin:
                return None
            self._note(f"plan-{done}", end)
        return done, begin, end

    def _open(self) -> None:
        for table in (PLANS, *PARTS):
            self.store.open_stream_version("gold", table)

    def _new(self, table: str, begin: dict, end: dict) -> DataFrame:
        return self.store.read_batches("silver", table, begin[table][1], end[table][1])

    def _append(self, df: DataFrame, table: str, run: int) -> None:
        if not self.store.is_committed("gold", table, run):
            self.store.store_schema("gold", table, df.schema)
            self.store.append(df, "gold", table, run)

    def _split(self, df: DataFrame, flag: Column, ready: str, held: str, run: int) -> None:
        """Write rows once: those that are ready are appended to one table, the others are what another one holds now."""
        store = self.store
        if store.is_committed("gold", held, run):
            return
        part = store.new_part("gold", ready)
        df.withColumn("_ready", flag).write.partitionBy("_ready").parquet(part)
        for folder in (f"{part}/_ready=true", f"{part}/_ready=false"):
            files.make_folder(store.spark, folder)
        store.store_schema("gold", ready, df.schema)
        store.store_schema("gold", held, df.schema)
        if not store.is_committed("gold", ready, run):
            store.commit("gold", ready, run, data=f"{part}/_ready=true")
        store.commit("gold", held, run, **{"data/0": f"{part}/_ready=false"})

    def _held(self, table: str, like: DataFrame) -> DataFrame:
        """What a table holds now, with the columns of ``like``."""
        if self.store.stored_schema("gold", table) is None:
            return like.limit(0)
        return self.store.read("gold", table).select(*like.columns)

    def run(self) -> bool:
        """Take in what is new; says whether there was anything."""
        planned = self._next()
        if planned is None:
            return False
        run, begin, end = planned
        orders = self._new("slv_orders", begin, end)
        self._number_orders(orders, run)
        self._match_lines(self._new("slv_order_items", begin, end), run)
        self._resolve_products(end, run)
        self._aggregate(orders, self._new("slv_reviews", begin, end), run)
        self.store.note("gold", PLANS, f"done/{run:09d}", "")
        return True

    # -- steps ---------------------------------------------------------------

    def _number_orders(self, orders: DataFrame, run: int) -> None:
        """Dense numbers from 1 on, in the order of arrival: known ones keep theirs."""
        store = self.store
        if store.is_committed("gold", "order_numbers", run):
            return
        scratch = store.new_part("gold", "order_numbers")
        orders.select(
            "order_id", "customer_id", "order_status", date_key("order_ts").alias("date_sk"),
            F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"),
        ).write.parquet(scratch)
        placed = store.spark.read.parquet(scratch)
        known = 0 if store.stored_schema("gold", "order_numbers") is None else store.read("gold", "order_numbers").count()
        # One narrow row per task that wrote orders.
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        base = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
            "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + known + 1).alias("_base"))
        in_part = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
        numbered = placed.join(base, "_part").select(
            (F.col("_base") + in_part).alias("order_no"), "order_id", "customer_id", "order_status", "date_sk")
        self._append(numbered, "order_numbers", run)

    def _match_lines(self, items: DataFrame, run: int) -> None:
        lines = items.select(
            "order_id", "item_seq", "product_id", "quantity", positive_price("unit_price").alias("unit_price"),
            line_revenue("quantity", "unit_price").alias("revenue"))
        if self.store.is_committed("gold", "waiting_lines", run):
            return
        waiting = self._held("waiting_lines", lines)
        numbers = self.store.read("gold", "order_numbers")
        matched = lines.unionByName(waiting).join(numbers, "order_id", "left")
        self._split(matched, F.col("order_no").isNotNull(), "mart_lines", "waiting_lines", run)

    def _resolve_products(self, end: dict, run: int) -> None:
        if self.store.is_committed("gold", "unresolved_lines", run):
            return
        lines = self.store.read_batches("gold", "mart_lines", run - 1, run).select(
            "order_no", "order_id", "item_seq", "product_id", "quantity", "unit_price", "revenue")
        known = self.store.read_batches("silver", "slv_products", -1, end["slv_products"][1]).select(
            "product_id", "product_category")
        unresolved = self._held("unresolved_lines", lines)
        found = lines.unionByName(unresolved).join(
            known.withColumn("resolved", F.lit(True)), "product_id", "left")
        self._split(found, F.col("resolved").isNotNull(), "resolved_lines", "unresolved_lines", run)

    def _aggregate(self, orders: DataFrame, reviews: DataFrame, run: int) -> None:
        lines = self.store.read_batches("gold", "mart_lines", run - 1, run)
        resolved = self.store.read_batches("gold", "resolved_lines", run - 1, run)
        dated = lines.where(F.col("date_sk").isNotNull())
        money = F.col("revenue").cast("decimal(18,2)")
        sums = F.sum("quantity").alias("units"), F.sum(money).cast(_MONEY).alias("revenue")
        priced = F.count("revenue").alias("priced")
        parts = {
            "part_daily": dated.groupBy("date_sk").agg(F.count(F.lit(1)).alias("lines"), *sums, priced),
            "part_daily_orders": order_bitmaps(dated, "date_sk"),
            "part_category": resolved.groupBy("product_category").agg(*sums, *_price_state()),
            "part_category_orders": order_bitmaps(resolved, "product_category"),
            "part_category_products": resolved.select("product_category", "product_id").distinct(),
            "part_customer": lines.groupBy("customer_id", "order_no").agg(*sums),
            "part_status": lines.groupBy("order_status").agg(F.sum(money).cast(_MONEY).alias("revenue"), priced),
            "part_status_orders": orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count")),
            "part_reviews": reviews.groupBy("score").agg(
                F.count(F.lit(1)).alias("review_count"), F.sum(F.when(F.col("verified"), 1).otherwise(0)).alias("verified_count"),
                F.sum("helpful_votes").alias("votes"), F.count("helpful_votes").alias("voted"),
                F.count("comment").alias("reviews_with_comment")),
        }
        side_by_side(self.store.spark, [partial(self._append, df, table, run) for table, df in parts.items()])

    # -- merged reads --------------------------------------------------------

    def _read(self, table: str) -> DataFrame:
        return self.store.read("gold", table)

    def unresolved(self) -> DataFrame:
        """The lines whose product is not known so far."""
        return self._read("unresolved_lines").drop("product_category", "resolved")

    def revenue_daily(self, dates: DataFrame) -> DataFrame:
        sums = self._read("part_daily").groupBy("date_sk").agg(
            *[F.sum(c).alias(c) for c in ("lines", "units", "priced")], _sum("revenue", _MONEY))
        counted = sums.join(orders_in(self._read("part_daily_orders"), "date_sk"), "date_sk")
        days = dates.select("date_sk", "full_date", "year", "quarter", "month", "month_name", "is_weekend")
        return counted.join(days, "date_sk").select(
            "full_date", "year", "quarter", "month", "month_name", "is_weekend", "order_count",
            F.col("lines").alias("line_item_count"), F.col("units").alias("units_sold"),
            _cents(F.col("revenue")).alias("total_revenue"),
            _cents(safe_ratio(F.col("revenue"), F.col("priced"))).alias("avg_line_revenue"))

    def sales_by_category(self) -> DataFrame:
        """Known products from the partial aggregates; the unknown member from its index."""
        unknown = self.unresolved().withColumn("product_category", F.lit("unknown"))
        none_known = unknown.groupBy("product_category").agg(
            F.sum("quantity").alias("units"), F.sum(F.col("revenue").cast("decimal(18,2)")).cast(_MONEY).alias("revenue"),
            *_price_state())
        sums = self._read("part_category").unionByName(none_known).groupBy("product_category").agg(
            F.sum("units").alias("units"), _sum("revenue", _MONEY), _sum("price", _PRICE), F.sum("prices").alias("prices"))
        orders = orders_in(self._read("part_category_orders").unionByName(order_bitmaps(unknown, "product_category")),
                           "product_category")
        sold = self._read("part_category_products").distinct().unionByName(
            unknown.select("product_category", F.lit("").alias("product_id")).distinct())
        products = sold.groupBy("product_category").agg(F.count(F.lit(1)).alias("distinct_products"))
        return _on_category(_on_category(sums, orders), products).select(
            "product_category", "order_count", "distinct_products", F.col("units").alias("units_sold"),
            _cents(F.col("revenue")).alias("total_revenue"),
            _cents(safe_ratio(F.col("price"), F.col("prices"))).alias("avg_unit_price"))

    def sales_by_state(self, customers: DataFrame) -> DataFrame:
        """By the state customers live in now: partial sums are kept per customer."""
        now = customers.where("is_current").select("customer_id", "state")
        per_customer = self._read("part_customer").groupBy("customer_id").agg(
            F.sum("units").alias("units"), _sum("revenue", _MONEY)).join(now, "customer_id")
        totals = per_customer.groupBy("state").agg(
            F.count(F.lit(1)).alias("customer_count"), F.sum("units").alias("units"), _sum("revenue", _MONEY))
        orders = orders_in(order_bitmaps(self._read("part_customer").join(now, "customer_id"), "state"), "state")
        same = F.col("state").eqNullSafe(F.col("_state"))
        return totals.join(orders.withColumnRenamed("state", "_state"), same).select(
            "state", "customer_count", "order_count", F.col("units").alias("units_sold"),
            _cents(F.col("revenue")).alias("total_revenue"),
            _cents(safe_ratio(F.col("revenue"), F.col("order_count"))).alias("avg_order_value"))

    def order_funnel(self) -> DataFrame:
        orders = self._read("part_status_orders").groupBy("order_status").agg(F.sum("order_count").alias("order_count"))
        sums = self._read("part_status").groupBy(F.col("order_status").alias("_status")).agg(
            _sum("revenue", _MONEY), F.sum("priced").alias("priced"))
        return orders.join(sums, F.col("order_status").eqNullSafe(F.col("_status")), "left").select(
            "order_status", "order_count", _cents(F.col("revenue")).alias("total_revenue"),
            _cents(safe_ratio(F.col("revenue"), F.col("priced"))).alias("avg_line_revenue"))

    def review_summary(self) -> DataFrame:
        names = ("review_count", "verified_count", "votes", "voted", "reviews_with_comment")
        sums = self._read("part_reviews").groupBy("score").agg(*[F.sum(c).alias(c) for c in names])
        return sums.select(
            "score", "review_count", F.round(share_of_total(F.col("review_count")), 1).alias("pct_of_reviews"),
            "verified_count", F.round(safe_ratio(F.col("votes"), F.col("voted")), 1).alias("avg_helpful_votes"),
            "reviews_with_comment")


def _cents(amount: Column) -> Column:
    return F.round(amount, 2)


def _price_state() -> tuple[Column, Column]:
    """What an average of prices is merged from."""
    price = F.col("unit_price").cast("decimal(18,4)")
    return F.sum(price).cast(_PRICE).alias("price"), F.count("unit_price").alias("prices")


def _on_category(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on the category; a product without one has a category of its own."""
    right = right.withColumnRenamed("product_category", "_category")
    return left.join(right, F.col("product_category").eqNullSafe(F.col("_category"))).drop("_category")
