"""A balance of all rows between landing files, bronze, silver and the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.keys import UNKNOWN_SK
from marlstone.operators.slices import slice_of, slices_for
from marlstone.operators.unions import union_all
from marlstone.plans.silver import DEDUP_KEYS
from marlstone.schemas import ENTITIES, RESCUED
from marlstone.sources.tables import TableStore

MEASURES = ("landing_files", "bronze_rows", "rescued_rows", "arrived_rows", "duplicate_rows", "dropped_rows", "silver_rows")


def _measure(entity: str, df: DataFrame, **values: Column) -> list[tuple[str, str, int]]:
    """(entity, measure, value) rows, one per aggregate; the rows are read once for all of them.

    They are counted at once, so that no two counts have their shuffles on disk together.
    """
    found = df.agg(*[F.coalesce(value.cast("long"), F.lit(0).cast("long")).alias(name) for name, value in values.items()])
    counted = found.first()
    return [(entity, name, counted[name]) for name in values]


def _repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, how many rows repeat it."""
    return rows.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("more"))


def balance(store: TableStore) -> DataFrame:
    """One row per entity, and one of the fact.

    ``arrived_rows`` are the rows that bronze stands for: one per row, of payments one per installment.  They are
    duplicates, or dropped by a rule, or in silver.  Each of the three is counted where it is, none as what is left over,
    so ``adds_up`` says that no row is missing or there twice.  Of the fact, ``arrived_rows`` are the silver lines,
    ``dropped_rows`` those without a known order.
    """
    rows, one = [], F.count(F.lit(1))
    for name, entity in ENTITIES.items():
        bronze, silver = store.read("bronze", entity.bronze), store.read("silver", entity.silver)
        quarantine = store.read_parts("silver", entity.silver, "quarantine", silver.schema)
        landed = store.commit_log("bronze", entity.bronze).entries().select(F.inline("sources"))
        each = F.greatest(F.coalesce(F.size("installments"), F.lit(0)), F.lit(0)) if name == "payments" else F.lit(1)
        # Copies that met in one batch, and those that met the first arrival's key in a later one.
        copies = {"duplicate_rows": one} if name in DEDUP_KEYS else {}
        rows += [
            *_measure(name, landed, landing_files=one),
            *_measure(name, bronze, bronze_rows=one, rescued_rows=F.count(RESCUED), arrived_rows=F.sum(each), **copies),
            *_measure(name, quarantine, dropped_rows=one), *_measure(name, silver, silver_rows=one)]
        if name in DEDUP_KEYS:
            arrivals = store.read("silver", f"{entity.silver}_arrivals")
            slices = slices_for(store.stored_bytes("silver", f"{entity.silver}_arrivals"))
            for n in range(slices):
                some = slice_of(arrivals, DEDUP_KEYS[name][:1], n, slices)
                rows += _measure(name, _repeats(some, DEDUP_KEYS[name]), duplicate_rows=F.sum("more"),
                                 collapsed=F.sum(F.col("more") + 1))
    items, fact = store.read("silver", "slv_order_items"), store.read("gold", "fct_sales")
    unmatched = items.join(store.read("silver", "slv_orders").select("order_id"), "order_id", "left_anti")
    rows += [*_measure("fct_sales", items, arrived_rows=one), *_measure("fct_sales", unmatched, dropped_rows=one),
             *_measure("fct_sales", fact, silver_rows=one)]

    def of(measure):
        return F.sum(F.when(F.col("measure") == measure, F.col("value")))

    counts = store.spark.createDataFrame(rows, "entity string, measure string, value long")
    wide = counts.groupBy("entity").agg(*[
        of(m).alias(m) for m in (*MEASURES, "collapsed")])
    duplicates = F.coalesce("duplicate_rows", F.lit(0).cast("long")) - F.coalesce("collapsed", F.lit(0).cast("long"))
    placed = duplicates + F.col("dropped_rows") + F.col("silver_rows")
    return wide.select(
        "entity", *[(duplicates if m == "duplicate_rows" else F.col(m)).alias(m) for m in MEASURES],
        (F.col("arrived_rows") == placed).alias("adds_up"))


def unplaced(fact: DataFrame) -> DataFrame:
    """Lines and revenue of the fact without a day, and on the unknown product."""
    money = F.col("revenue").cast("decimal(18,2)")
    return union_all(*[
        fact.where(condition).agg(F.count(F.lit(1)).alias("lines"), F.sum(money).alias("revenue")).select(
            F.lit(name).alias("missing"), "lines", "revenue")
        for name, condition in (("day", F.col("date_sk").isNull()), ("product", F.col("product_sk") == UNKNOWN_SK))])
