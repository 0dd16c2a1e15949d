"""One query per operator and data product, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import (
    date_key, mask_email, parse_messy_timestamp, positive_price, region_visible,
    safe_ratio, surrogate_key, tidy, title_case,
)
from marlstone.functions.masks import ANALYSTS, BI_READER, ENGINEERS
from marlstone.operators import governance, history, joins, quality, shares, unions
from marlstone.operators.dedup import dedup_by_key, latest_by_key
from marlstone.operators.quality import RULES
from marlstone.operators.slices import planned_bytes, slice_of, slices_for
from marlstone.plans import dimensions, facts, kpis, marts, silver
from marlstone.schemas import ENTITIES
from marlstone.session import freeing_shuffles, scratch_path, side_by_side
from marlstone.sources import landing
from marlstone.sources.calendar import calendar_span
from marlstone.sources.tables import SourceRewritten, TableStore
from marlstone.streaming import bronze, refresh
from marlstone.streaming.balance import unplaced
from marlstone.streaming import silver as silver_streams
from marlstone.streaming.history import refresh_history
from marlstone.streaming.marts import MartFeed
from marlstone.workload.standins import RAW, Shop, messy_date

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Shop], DataFrame], name: str | None = None):
    """Register a query over a ``Shop``; exact decimals leave as doubles."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _as_doubles(build(Shop(spark, sf_dir)))

    QUERIES[name or build.__name__] = run
    return build


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
        for f in df.schema.fields
    ])


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n).cast("double") for c, n in digits.items()})


# --- sources, sinks, scans -----------------------------------------------------

ORDER_COLUMNS = ["order_id", "customer_id", "order_status", "order_date", "order_total"]


# Packed files cannot be split by readers, so they end after so many rows.
PACKED_ROWS = 4_000_000


def _packed(compression: str) -> dict[str, str]:
    return {} if compression == "none" else {"compression": compression, "maxRecordsPerFile": str(PACKED_ROWS)}


def _write_csv(df: DataFrame, folder: str, mode: str = "append", compression: str = "none") -> None:
    (df.write.mode(mode).option("header", True).options(**_packed(compression))
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder))


def _land(
    shop: Shop, entity: str, landing_root: str, rows: DataFrame | None = None, compression: str = "none",
) -> None:
    rows = shop.raw(entity) if rows is None else rows
    folder = f"{landing_root}/{entity}"
    if ENTITIES[entity].format == "csv":
        _write_csv(rows, folder, compression=compression)
    else:
        rows.write.mode("append").options(**_packed(compression)).json(folder)


def _order_drops(shop: Shop) -> list[DataFrame]:
    """The orders as three deliveries by order date."""
    orders = shop.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").alias("order_total"),
        F.col("o_orderpriority").alias("priority"),
    )
    day = F.col("order_date")
    return [
        orders.where(day < "1997-01-01"),
        orders.where((day >= "1997-01-01") & (day < "1999-06-01")),
        orders.where((day >= "1999-06-01") | day.isNull()),
    ]


def _fresh(shop: Shop, label: str) -> tuple[str, TableStore]:
    base = scratch_path(shop.spark, label)
    return f"{base}/landing", TableStore(shop.spark, f"{base}/tables")


@query
def ingest_csv(shop):
    landing_root, store = _fresh(shop, "ingest-csv")
    _land(shop, "order_items", landing_root)
    bronze.refresh_bronze(store, "order_items", landing_root)
    rows = store.read("bronze", "br_order_items")
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


@query
def ingest_json(shop):
    landing_root, store = _fresh(shop, "ingest-json")
    _land(shop, "payments", landing_root)
    bronze.refresh_bronze(store, "payments", landing_root)
    return store.read("bronze", "br_payments").select(
        "order_id", "payment_type",
        F.array_join(F.transform("installments", lambda x: F.concat_ws(
            ":", x["installment_no"].cast("string"), x["paid"].cast("string"))), ",").alias("numbers_and_states"),
        F.round(F.aggregate("installments", F.lit(0.0), lambda a, x: a + x["amount"]), 2).alias("amount_sum"),
        F.coalesce(F.size("installments"), F.lit(-1)).alias("installment_count"),
        F.get("installments", F.lit(0)).getField("amount").alias("first_amount"),
        F.get("installments", F.lit(0)).getField("paid").alias("first_paid"),
    )


def _register_bronze(entity: str) -> None:
    def ingested(shop):
        landing_root, store = _fresh(shop, f"br-{entity}")
        _land(shop, entity, landing_root)
        bronze.refresh_bronze(store, entity, landing_root)
        rows = store.read("bronze", f"br_{entity}")
        if entity == "reviews":
            rows = rows.withColumns({
                "verified": F.col("meta.verified"), "helpful_votes": F.col("meta.helpful_votes")})
        if entity == "payments":
            rows = rows.withColumn("installment_count", F.coalesce(F.size("installments"), F.lit(-1)))
        return rows.select(*[
            c for c in rows.columns if not c.startswith("_") and c not in ("meta", "installments")])

    query(ingested, f"br_{entity}")


for _name in RAW:
    _register_bronze(_name)


@query
def ingest_fixed_schema(shop):
    landing_root, store = _fresh(shop, "ingest-fixed")
    _land(shop, "reviews", landing_root)
    bronze.refresh_bronze(store, "reviews", landing_root, evolve=False)
    return store.read("bronze", "br_reviews").select(
        "review_id", "order_id", "score", "comment", "review_date",
        F.col("meta.verified").alias("verified"), F.col("meta.helpful_votes").alias("helpful_votes"),
    )


@query
def ingest_rescued(shop):
    """Prices that are no numbers and lines with a field too many: nothing of them is lost."""
    landing_root, store = _fresh(shop, "rescued")
    lines = F.concat_ws(
        ",", F.col("p_partkey").cast("string"), "p_type", "p_name",
        F.when(F.col("p_partkey") % 10 == 0, "12.50 USD").otherwise(F.col("p_size").cast("string")),
        F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 15 == 0, "EXTRA"),
    ).alias(",".join(ENTITIES["products"].schema.names))
    # Whole lines as one column under the header line; with another separator, commas stay as they are.
    shop.table("part").select(lines).write.option("header", True).option("sep", "\x01").csv(f"{landing_root}/products")
    bronze.refresh_bronze(store, "products", landing_root)
    return store.read("bronze", "br_products").select("product_id", "base_price", "weight_grams", "_rescued_data")


@query
def with_ingest_metadata(shop):
    base = scratch_path(shop.spark, "metadata")
    _write_csv(shop.table("customer"), base)
    rows = landing.with_ingest_metadata(shop.spark.read.option("header", True).csv(base))
    return rows.select(
        F.col("c_custkey").cast("long").alias("c_custkey"),
        F.col("_source_file").endswith(".csv").alias("has_file"),
        (F.col("_source_file_ts") > F.lit("2000-01-01").cast("timestamp")).alias("has_file_time"),
        (F.col("_ingested_at") >= F.col("_source_file_ts")).alias("ingested_after_file"),
    )


@query
def infer_landing_schema(shop):
    base = scratch_path(shop.spark, "infer")
    _write_csv(shop.table("orders"), base)
    schema = landing.infer_landing_schema(shop.spark, base, "csv")
    found = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
        for f in schema.fields
    ])
    return shop.spark.range(1).select(F.inline(found))


@query
def evolve_schema_add_columns(shop):
    landing_root, store = _fresh(shop, "evolve")
    first, second, third = _order_drops(shop)
    drops = [
        first.select(*ORDER_COLUMNS),
        second.select(*ORDER_COLUMNS, "priority"),
        third.select("priority", "order_total", "order_status", "customer_id", "order_id", "order_date"),
    ]
    for drop in drops:
        _land(shop, "orders", landing_root, drop)
        bronze.refresh_bronze(store, "orders", landing_root)
    return store.read("bronze", "br_orders").select(*ORDER_COLUMNS, "priority")


@query
def incremental_refresh(shop):
    landing_root, store = _fresh(shop, "incremental")
    for drop in _order_drops(shop):
        _land(shop, "orders", landing_root, drop.select(*ORDER_COLUMNS))
        bronze.refresh_bronze(store, "orders", landing_root)
    bronze.refresh_bronze(store, "orders", landing_root)
    return store.read("bronze", "br_orders").select(*ORDER_COLUMNS)


@query
def full_refresh(shop):
    landing_root, store = _fresh(shop, "full-refresh")
    for drop in _order_drops(shop):
        _land(shop, "orders", landing_root, drop.select(*ORDER_COLUMNS))
    bronze.refresh_bronze(store, "orders", landing_root)
    silver_streams.refresh_silver(store, "orders")
    refresh.full_refresh(store, "orders", landing_root)
    return store.read("silver", "slv_orders")


@query
def append_only_guard(shop):
    landing_root, store = _fresh(shop, "guard")
    _land(shop, "sellers", landing_root)
    bronze.refresh_bronze(store, "sellers", landing_root)
    silver_streams.refresh_silver(store, "sellers")
    store.open_stream_version("bronze", "br_sellers")
    bronze.refresh_bronze(store, "sellers", landing_root)
    try:
        silver_streams.refresh_silver(store, "sellers")
        refused = False
    except SourceRewritten:
        refused = True
    return store.read("silver", "slv_sellers").groupBy().agg(
        F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("row_count")
    )


@query
def guard_rewritten_file(shop):
    """Landing files replaced after they were ingested: the next run refuses and changes nothing."""
    landing_root, store = _fresh(shop, "rewritten")
    _land(shop, "sellers", landing_root)
    bronze.refresh_bronze(store, "sellers", landing_root)
    silver_streams.refresh_silver(store, "sellers")
    _write_csv(shop.raw("sellers"), f"{landing_root}/sellers", "overwrite")
    try:
        bronze.refresh_bronze(store, "sellers", landing_root)
        refused = False
    except SourceRewritten:
        refused = True
    silver_streams.refresh_silver(store, "sellers")
    return store.read("silver", "slv_sellers").groupBy().agg(
        F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("row_count")
    )


def _open_silver(store: TableStore, table: str, df: DataFrame) -> None:
    store.open_stream_version("silver", table)
    store.store_schema("silver", table, df.schema)


def _stream_to_table(shop: Shop, df: DataFrame, label: str) -> DataFrame:
    store = TableStore(shop.spark, scratch_path(shop.spark, label))
    store.open_stream_version("silver", label)
    silver_streams.append_stream(store, df, "silver", label)
    return store.read("silver", label)


def _table_stream(shop: Shop, name: str) -> DataFrame:
    # A stream takes a folder or a pattern; this pattern also fits a table of one file.
    path = f"{shop.sf_dir}/[{name[0]}]{name[1:]}.parquet"
    return shop.spark.readStream.schema(shop.table(name).schema).parquet(path)


@query
def stream_table_scan(shop):
    return _stream_to_table(shop, _table_stream(shop, "events"), "scan")


@query
def batch_table_scan(shop):
    return shop.table("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query
def literal_row_union(shop):
    """All categories sold and one literal row."""
    categories = shop.silver("products").groupBy("product_category").agg(
        F.count(F.lit(1)).alias("product_count")
    )
    return unions.with_sentinel(categories, {"product_category": "unknown"})


@query
def calendar_generator(shop):
    return calendar_span(shop.table("orders"), "o_orderdate")


@query
def streaming_table_sink(shop):
    return _stream_to_table(shop, silver.reviews(_json_reviews(shop)), "sink")


def _json_reviews(shop: Shop) -> DataFrame:
    landing_root, _ = _fresh(shop, "sink-landing")
    _land(shop, "reviews", landing_root)
    return bronze.stream_landing(shop.spark, f"{landing_root}/reviews", ENTITIES["reviews"])


@query
def materialized_view_sink(shop):
    """Two refreshes; readers see the second."""
    store = TableStore(shop.spark, scratch_path(shop.spark, "view"))
    store.publish(shop.table("part").select("p_partkey", "p_retailprice"), "gold", "prices")
    store.publish(
        store.read("gold", "prices").withColumn("p_retailprice", F.col("p_retailprice") * 2), "gold", "prices"
    )
    return store.read("gold", "prices")


@query
def environment_config(shop):
    """The same code in two environments that share nothing but the code."""
    base = scratch_path(shop.spark, "environments")
    counts = []
    for name in ("dev", "prod"):
        store = TableStore(shop.spark, f"{base}/{name}")
        store.publish(shop.silver("sellers"), "silver", "slv_sellers")
        counts.append(store.read("silver", "slv_sellers").agg(
            F.lit(name).alias("environment"), F.count(F.lit(1)).alias("row_count")
        ))
    return counts[0].unionByName(counts[1])


@query
def preview_limit(shop):
    return shop.customers().select("customer_id", "email", "valid_from").orderBy(
        "customer_id", "valid_from"
    ).limit(5).drop("valid_from")


# --- expressions ------------------------------------------------------------------

@query
def text_functions(shop):
    return shop.raw("customers").select(
        "customer_name", tidy("email").alias("email"), title_case("city").alias("city"),
        F.upper(tidy("state")).alias("state"), F.lower("customer_name").alias("lower_name"),
        F.concat(F.left("customer_name", F.lit(2)), F.lit("..")).alias("initials"),
        F.coalesce(F.col("email").rlike("^[^@]+@[^@]+[.][^@]+$"), F.lit(False)).alias("email_ok"),
    )


@query
def messy_dates(shop):
    return shop.table("orders").withColumn("raw_date", messy_date("o_orderdate", "o_orderkey")).select(
        "o_orderkey", "raw_date", parse_messy_timestamp("raw_date").alias("parsed"),
        date_key(parse_messy_timestamp("raw_date")).alias("day_key"),
    )


@query
def row_predicates(shop):
    """Comparisons, NULL tests, IN, BETWEEN, AND/OR over every line."""
    return shop.raw("order_items").where(
        F.col("item_seq").isNotNull()
        & ((F.col("quantity") > 0) | F.col("unit_price").isNull())
        & F.col("quantity").between(0, 40)
        & F.col("item_seq").isin(1, 2, 3, 4, 5)
    ).select("order_id", "item_seq", "quantity", "unit_price")


@query
def case_cast_coalesce(shop):
    return shop.raw("products").select(
        "product_id",
        F.coalesce("weight_grams", F.lit(-1)).alias("weight"),
        F.when(F.col("base_price") > 0, "priced").alias("priced"),
        F.when(F.col("base_price").isNull(), True).otherwise(False).alias("no_price"),
        positive_price("base_price").alias("valid_price"),
        safe_ratio(F.col("base_price"), F.col("weight_grams").cast("double")).alias("price_per_gram"),
        F.col("product_id").try_cast("int").alias("product_number"),
    )


@query
def price_guard(shop):
    """Lines without a valid price carry neither price nor revenue."""
    return shop.silver("order_items").select(
        "order_id", "item_seq", positive_price("unit_price").alias("unit_price"),
        F.round(F.col("quantity") * positive_price("unit_price"), 2).alias("revenue"),
    )


# --- quality rules ----------------------------------------------------------------

def _register_entity(entity: str) -> None:
    query(lambda shop: shop.silver(entity), f"slv_{entity}")
    query(
        lambda shop: quality.dq_metrics(shop.cleaned(entity), RULES[entity], f"slv_{entity}"),
        f"dq_metrics_{entity}",
    )


for _entity in RAW:
    _register_entity(_entity)


@query
def key_resolution_check(shop):
    return quality.key_resolution(shop.fact(), ["customer_sk", "product_sk", "seller_sk", "date_sk"])


@query
def unresolved_products(shop):
    return quality.unresolved_references(shop.silver("order_items"), shop.silver("products"), "product_id")


@query
def surrogate_key_unique(shop):
    versions = shop.customers().select("customer_id", "valid_from", "customer_sk")
    return quality.key_collisions(versions, ["customer_id", "valid_from"], "customer_sk")


# --- joins ------------------------------------------------------------------------

@query
def inner_equi_join(shop):
    return joins.inner_equi_join(
        shop.silver("order_items"), shop.silver("orders").select("order_id", "order_status"), "order_id"
    ).select("order_id", "item_seq", "order_status", "quantity")


@query
def left_equi_join(shop):
    lines = shop.silver("order_items").groupBy("order_id").agg(F.count(F.lit(1)).alias("line_count"))
    return joins.left_equi_join(
        shop.silver("orders").select("order_id", "order_status"), lines, "order_id"
    )


@query
def left_join_current_version(shop):
    return joins.left_join_current_version(
        shop.silver("orders").select("order_id", "customer_id"), shop.customers(), "customer_id",
        ["city", "valid_from"],
    )


@query
def left_join_on_expression(shop):
    return joins.left_join_on_expression(
        shop.silver("orders").select("order_id", "order_ts"), shop.dates(),
        F.date_format("order_ts", "yyyyMMdd").cast("int"), "date_sk", ["full_date", "day_name"],
    )


@query
def unknown_member_join(shop):
    products = shop.products()
    rows = joins.unknown_member_join(
        shop.silver("order_items").select("order_id", "item_seq", "product_id"), products,
        "product_id", "product_sk",
    ).select("order_id", "item_seq", "product_sk")
    names = products.select("product_sk", "product_category", "product_name")
    return joins.join_with_unknown_member(rows, names, "product_sk", ["order_id", "item_seq"]).drop("product_sk")


@query
def point_in_time_join(shop):
    return history.point_in_time_join(
        shop.silver("orders").select("order_id", "customer_id", "order_ts"), shop.customers(),
        "customer_id", "order_ts", ["city", "state", "valid_from"],
    )


# --- nested data, dedup, history, streams -----------------------------------------

@query
def explode_installments(shop):
    return silver.payments(shop.raw("payments"))


@query
def struct_flatten_reviews(shop):
    return silver.reviews(shop.raw("reviews")).select("review_id", "score", "verified", "helpful_votes")


@query
def dedup_lineitem(shop):
    return dedup_by_key(shop.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dedup_distinct_keys(shop):
    return dedup_by_key(shop.table("lineitem").select("l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"])


@query
def stream_dedup(shop):
    """Lines collapsed batch by batch, then the first arrival of every key; all columns of it."""
    keys = ["l_orderkey", "l_linenumber"]
    store = TableStore(shop.spark, scratch_path(shop.spark, "dedup"))
    lines = _table_stream(shop, "lineitem")
    for table in ("arrivals", "kept"):
        _open_silver(store, table, lines)
    query = lines.writeStream.foreachBatch(
        lambda batch, n: store.append(dedup_by_key(batch, keys), "silver", "arrivals", n)).option(
        "checkpointLocation", store.checkpoint_path("silver", "arrivals")).trigger(availableNow=True).start()
    query.awaitTermination()
    silver_streams.append_stream(store, dedup_by_key(store.read_stream("silver", "arrivals"), keys), "silver", "kept")
    return store.read("silver", "kept")


def _priority_changes(shop: Shop) -> DataFrame:
    return shop.table("orders").select(
        "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
        "o_orderkey", "o_orderpriority",
    )


@query
def scd2_customer(shop):
    return history.scd2_versions(_priority_changes(shop), ["o_custkey"], "o_orderdate").withColumnsRenamed(
        {history.START: "start_at", history.END: "end_at"}
    )


@query
def scd2_hot_keys(shop):
    """The same history with every busy customer treated as a hot key."""
    return history.scd2_versions(
        _priority_changes(shop), ["o_custkey"], "o_orderdate", hot_rows=5
    ).withColumnsRenamed({history.START: "start_at", history.END: "end_at"})


@query
def scd2_tracked_columns(shop):
    """Versions only where the priority changed."""
    return history.scd2_versions(
        _priority_changes(shop), ["o_custkey"], "o_orderdate", track=["o_orderpriority"]
    ).select(
        "o_custkey", "o_orderpriority",
        F.col(history.START).alias("start_at"), F.col(history.END).alias("end_at"),
    )


@query
def scd2_out_of_order(shop):
    """Changes delivered newest first, in three streamed files, give the same history."""
    landing_root, store = _fresh(shop, "late")
    store.open_stream_version("silver", "changes")
    day = F.col("o_orderdate")
    log = _priority_changes(shop)
    for drop in (
        log.where((day >= "1999-06-01") | day.isNull()),
        log.where((day >= "1997-01-01") & (day < "1999-06-01")),
        log.where(day < "1997-01-01"),
    ):
        drop.write.mode("append").parquet(landing_root)
        changes = shop.spark.readStream.schema(log.schema).parquet(landing_root)
        silver_streams.append_stream(store, changes, "silver", "changes")
    return history.scd2_versions(
        store.read("silver", "changes"), ["o_custkey"], "o_orderdate"
    ).withColumnsRenamed({history.START: "start_at", history.END: "end_at"})


@query
def scd2_incremental(shop):
    """Three deliveries, newest first: each one remakes the buckets of its own customers only."""
    _, store = _fresh(shop, "scd2-incremental")
    log = _priority_changes(shop)
    _open_silver(store, "changes", log)
    day = F.col("o_orderdate")
    drops = [log.where((day >= "1999-06-01") | day.isNull()), log.where((day >= "1997-01-01") & (day < "1999-06-01")),
             log.where(day < "1997-01-01")]
    for n, drop in enumerate(drops):
        store.append(drop, "silver", "changes", n)
        refresh_history(store, ("silver", "changes"), ("gold", "history"), ["o_custkey"], "o_orderdate", buckets=16)
    return store.read("gold", "history").withColumnsRenamed({history.START: "start_at", history.END: "end_at"})


@query
def scd2_incremental_tracked(shop):
    """The same with versions only where the priority changed; late deliveries part what was merged."""
    _, store = _fresh(shop, "scd2-tracked")
    log = _priority_changes(shop)
    _open_silver(store, "changes", log)
    for n in range(3):
        store.append(log.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == n), "silver", "changes", n)
        refresh_history(store, ("silver", "changes"), ("gold", "history"), ["o_custkey"], "o_orderdate",
                        ["o_orderpriority"], buckets=16)
    return store.read("gold", "history").select(
        "o_custkey", "o_orderpriority",
        F.col(history.START).alias("start_at"), F.col(history.END).alias("end_at"))


@query
def scd2_current(shop):
    return history.current_versions(_priority_changes(shop), ["o_custkey"], "o_orderdate")


@query
def unsequenced_changes(shop):
    return history.unsequenced(shop.cleaned("customers"), "signup_ts").select(
        "customer_id", "customer_name", "signup_date"
    )


@query
def scd1_dimension(shop):
    latest = latest_by_key(_priority_changes(shop), ["o_custkey"], "o_orderdate")
    return latest.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")


@query
def stream_static_equivalence(shop):
    """Bronze and silver by streams, the mart by a batch job over their output."""
    landing_root, store = _fresh(shop, "equivalence")
    _land(shop, "reviews", landing_root)
    bronze.refresh_bronze(store, "reviews", landing_root)
    silver_streams.refresh_silver(store, "reviews")
    return marts.mv_review_summary(store.read("silver", "slv_reviews"))


# --- dimensions, fact, marts ------------------------------------------------------

@query
def dim_date(shop):
    """The calendar from the first to the last order."""
    return dimensions.describe_days(calendar_span(shop.table("orders"), "o_orderdate"))


@query
def dim_product(shop):
    return shop.products().withColumn(
        "is_unknown_member", F.col("product_sk") == -1
    ).drop("product_sk")


@query
def dim_seller(shop):
    return shop.sellers().drop("seller_sk")


@query
def dim_customer(shop):
    return shop.customer_history().withColumnsRenamed(
        {history.START: "start_at", history.END: "end_at"}
    )


@query
def dim_customer_keyed(shop):
    return shop.customers().withColumn(
        "customer_sk", F.col("customer_sk") == surrogate_key("customer_id", "valid_from")
    )


def _with_natural_keys(shop: Shop, fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Replace hashed keys by the business keys they stand for."""
    versions = customers.select("customer_sk", "customer_id", "valid_from")
    named = fact.join(versions, "customer_sk", "left")
    named = named.join(shop.products().select("product_sk", "product_id"), "product_sk", "left")
    named = named.join(shop.sellers().select("seller_sk", "seller_id"), "seller_sk", "left")
    return named.select(
        "order_id", "item_seq", "customer_id", "valid_from", "product_id", "seller_id",
        "date_sk", "quantity", "unit_price", "revenue", "order_status",
    )


@query
def fct_sales(shop):
    return _with_natural_keys(shop, shop.fact(), shop.current_customers())


@query
def fct_sales_as_of_event(shop):
    customers = shop.written("dim_customer_keyed", shop.customers())
    fact = facts.fct_sales(
        shop.silver("order_items"), shop.silver("orders"), customers, shop.products(),
        shop.sellers(), shop.dates(), customer_as_of="event",
    )
    return _with_natural_keys(shop, fact, customers)


def _daily(shop: Shop) -> DataFrame:
    return marts.mv_revenue_daily(shop.fact(), shop.dates())


def _by_category(shop: Shop) -> DataFrame:
    return marts.mv_sales_by_category(shop.written_fact(), shop.products())


def _by_state(shop: Shop) -> DataFrame:
    return marts.mv_sales_by_state(shop.fact(), shop.current_customers())


def _funnel(shop: Shop) -> DataFrame:
    return marts.mv_order_funnel(shop.silver("orders"), shop.fact())


def _review_summary(shop: Shop) -> DataFrame:
    return marts.mv_review_summary(shop.silver("reviews"))


query(_daily, "mv_revenue_daily")
query(lambda shop: marts.in_report_order(_by_category(shop), "mv_sales_by_category"), "mv_sales_by_category")
query(lambda shop: marts.in_report_order(_by_state(shop), "mv_sales_by_state"), "mv_sales_by_state")
query(lambda shop: marts.in_report_order(_funnel(shop), "mv_order_funnel"), "mv_order_funnel")
query(lambda shop: marts.in_report_order(_review_summary(shop), "mv_review_summary"), "mv_review_summary")


_RUNS: dict[tuple, TableStore] = {}


def _medallion(shop: Shop) -> TableStore:
    """Landing files of all entities, copies included, to marts in one run; once per session and input."""
    key = shop.spark.sparkContext.applicationId, shop.sf_dir
    if key not in _RUNS:
        base = scratch_path(shop.spark, "medallion")
        with freeing_shuffles(shop.spark):
            side_by_side(shop.spark, [
                partial(_land, shop, entity, f"{base}/landing", compression="gzip") for entity in ENTITIES])
        refresh.run_medallion(shop.spark, f"{base}/landing", f"{base}/tables")
        _RUNS[key] = TableStore(shop.spark, f"{base}/tables")
    return _RUNS[key]


def _register_run(name: str, table: str) -> None:
    query(lambda shop: _medallion(shop).read("gold", table), name)


_register_run("medallion_run", "mv_revenue_daily")
for _mart in ("mv_sales_by_category", "mv_sales_by_state", "mv_order_funnel", "mv_review_summary", "dim_date"):
    _register_run(f"medallion_{_mart}", _mart)
query(lambda shop: _medallion(shop).read("gold", "dim_product").withColumn(
    "is_unknown_member", F.col("product_sk") == -1).drop("product_sk"), "medallion_dim_product")
query(lambda shop: _medallion(shop).read("gold", "dim_seller").drop("seller_sk"), "medallion_dim_seller")
query(lambda shop: _medallion(shop).read("gold", "dim_customer").withColumnsRenamed(
    {history.START: "start_at", history.END: "end_at"}), "medallion_dim_customer")
query(lambda shop: _medallion(shop).read("gold", "dim_customer_keyed").withColumn(
    "customer_sk", F.col("customer_sk") == surrogate_key("customer_id", "valid_from")), "medallion_dim_customer_keyed")


def _named_fact(store: TableStore, fact: DataFrame) -> DataFrame:
    for key, dimension, names in (("customer_sk", "dim_customer_keyed", ["customer_id", "valid_from"]),
                                  ("product_sk", "dim_product", ["product_id"]), ("seller_sk", "dim_seller", ["seller_id"])):
        fact = fact.join(store.read("gold", dimension).select(key, *names), key, "left").drop(key)
    return fact


@query
def medallion_fct_sales(shop):
    """The keys of a large fact are replaced slice by slice, so that its three joins are not on disk whole at once."""
    store = _medallion(shop)
    fact = store.read("gold", "fct_sales")
    slices = slices_for(planned_bytes(fact))
    if slices == 1:
        return _named_fact(store, fact)
    named = [_named_fact(store, slice_of(fact, ["order_id"], n, slices)) for n in range(slices)]
    with freeing_shuffles(shop.spark):
        return shop.written("medallion_fct_sales", *named)


@query
def run_balance(shop):
    """Files depend on the writer's tasks and are left out."""
    return _medallion(shop).read("gold", "run_balance").drop("landing_files")


@query
def run_unplaced(shop):
    return unplaced(_medallion(shop).read("gold", "fct_sales"))


def _mart_feed(shop: Shop) -> tuple[TableStore, MartFeed]:
    """Silver tables in three deliveries that cut through orders: lines come before their orders and products."""
    _, store = _fresh(shop, "mart-feed")
    numbers = {"orders": ["order_id"], "order_items": ["order_id", "item_seq"], "products": ["product_id"],
               "reviews": ["review_id", "order_id"]}
    rows = dict(zip(numbers, side_by_side(shop.spark, [
        partial(shop.written, f"slv_{entity}", shop.silver(entity)) for entity in numbers])))
    for entity, df in rows.items():
        _open_silver(store, f"slv_{entity}", df)
    feed = MartFeed(store)

    def deliver(entity, n):
        # Products come one delivery later than lines, so that lines have to wait for them.
        due = F.pmod(F.xxhash64(*numbers[entity]), F.lit(3)) == (n if entity != "products" else (n + 2) % 3)
        store.append(rows[entity].where(due), "silver", f"slv_{entity}", n)

    for n in range(3):
        side_by_side(shop.spark, [partial(deliver, entity, n) for entity in numbers])
        feed.run()
    feed.run()
    return store, feed


query(lambda shop: _mart_feed(shop)[1].revenue_daily(shop.dates()), "mart_incremental_daily")
query(lambda shop: _mart_feed(shop)[1].sales_by_category(), "mart_incremental_category")
query(lambda shop: _mart_feed(shop)[1].sales_by_state(shop.current_customers()), "mart_incremental_state")
query(lambda shop: _mart_feed(shop)[1].order_funnel(), "mart_incremental_funnel")
query(lambda shop: _mart_feed(shop)[1].review_summary(), "mart_incremental_reviews")


@query
def late_arriving_products(shop):
    """Every line of a known order after three deliveries, with the product it was resolved to in the end."""
    store, feed = _mart_feed(shop)
    unknown = feed.unresolved().withColumn("product_category", F.lit("unknown"))
    columns = ["order_id", "item_seq", "product_id", "product_category"]
    return store.read("gold", "resolved_lines").select(*columns).unionByName(unknown.select(*columns))


# --- governed reads ---------------------------------------------------------------

def _register_role(label: str, groups: list[str]) -> None:
    query(
        lambda shop: governance.secure_read(shop.customers(), "dim_customer_keyed", groups).select(
            "customer_id", "email", "valid_from"),
        f"mask_email_{label}",
    )
    query(
        lambda shop: governance.secure_read(_by_state(shop), "mv_sales_by_state", groups),
        f"row_filter_{label}",
    )

    def tagged(shop):
        versions = governance.tag_column(shop.customer_history(), "email", "sensitivity", "pii")
        return governance.secure_read(versions, "dim_customer", groups).select("customer_id", "email", "signup_ts")

    query(tagged, f"tag_policy_mask_{label}")
    query(
        lambda shop: governance.visible_layers(shop.silver("sellers"), "sellers", groups),
        f"layer_visibility_{label}",
    )


@query
def dq_metrics_stream(shop):
    """The stored rule counts of all entities, landed in two drops and cleansed in small batches."""
    landing_root, store = _fresh(shop, "dq-stream")

    def deliver(entity, schema):
        rows = shop.raw(entity)
        # All copies of a row have one first column, so they come in one drop and the smallest stays.
        late = F.pmod(F.xxhash64(schema.schema.names[0]), F.lit(2)) == 0
        for drop in (rows.where(late), rows.where(~late)):
            _land(shop, entity, landing_root, drop)
            bronze.refresh_bronze(store, entity, landing_root)
            silver_streams.refresh_silver(store, entity)

    side_by_side(shop.spark, [partial(deliver, *named) for named in ENTITIES.items()])
    parts = [silver_streams.stored_metrics(store, entity) for entity in ENTITIES]
    counts = ["rows_checked", "rows_passed", "rows_failed", "rows_dropped"]
    return unions.union_all(*parts).groupBy("table_name", "rule", "action").agg(*[F.sum(c).alias(c) for c in counts])


_register_role("engineer", [ENGINEERS])
_register_role("analyst", [ANALYSTS])
_register_role("bi_reader", [BI_READER])


@query
def row_filter_no_group(shop):
    return shop.current_customers().where(region_visible("state", [])).select("customer_id", "state")


@query
def mask_email_no_group(shop):
    return shop.change_log().select("customer_id", "signup_ts", mask_email("email", []).alias("email"))


@query
def list_column_tags(shop):
    """Tags survive storage; counted per tagged column over the stored table."""
    versions = governance.tag_column(shop.change_log(), "email", "sensitivity", "pii")
    store = TableStore(shop.spark, scratch_path(shop.spark, "tags"))
    store.publish(versions, "gold", "dim_customer")
    stored = store.read("gold", "dim_customer")
    tags = governance.list_column_tags(stored, "dim_customer")
    filled = stored.agg(F.count("email").alias("filled_rows")).withColumn("table_name", F.lit("dim_customer"))
    return tags.join(filled, "table_name")


# --- headline numbers -------------------------------------------------------------

query(lambda shop: kpis.totals(_daily(shop)), "kpi_totals")
query(lambda shop: _rounded(kpis.revenue_by_month(_daily(shop)), avg_month_revenue=2)
      .orderBy(F.col("month_revenue").desc()), "kpi_month_avg")
query(lambda shop: _rounded(kpis.daily_trend(_daily(shop)), avg_day_revenue=2), "kpi_daily_trend")
query(lambda shop: _rounded(kpis.category_pareto(_by_category(shop)), revenue_pct=4, cumulative_pct=4),
      "kpi_pareto")
query(lambda shop: _rounded(kpis.state_shares(_by_state(shop)), revenue_pct=4), "kpi_state_shares")
query(lambda shop: _rounded(kpis.top_states_share(_by_state(shop)), revenue_pct=3), "kpi_topk_share")
query(lambda shop: _rounded(kpis.top_categories_share(_by_category(shop)), revenue_pct=3),
      "kpi_top_categories_share")
query(lambda shop: _rounded(kpis.review_quality(_review_summary(shop)),
                            positive_pct=4, negative_pct=4, avg_rating=4), "kpi_review_positive")
query(lambda shop: _rounded(kpis.status_rates(_funnel(shop)),
                            delivery_pct=4, cancellation_pct=4, return_pct=4), "kpi_status_rates")


@query
def top_k_products(shop):
    """The ten products with the largest revenue and their share of all revenue."""
    sold = shop.fact().groupBy("product_sk").agg(F.sum("revenue").cast("decimal(18,2)").alias("total_revenue"))
    named = sold.join(shop.products().select("product_sk", "product_id"), "product_sk").drop("product_sk")
    return _rounded(shares.top_k_share(named, "total_revenue", 10, "product_id"), share_pct=4)
