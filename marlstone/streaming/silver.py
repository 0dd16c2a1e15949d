"""Bronze to silver: the cleansing functions applied to streams.

Entities that are deduplicated take two steps.  First every batch of bronze rows is cleansed and its copies
collapse, on the map side, to the smallest one (table ``<silver>_arrivals``); then a stream takes these batches
one after the other and keeps the rows whose key no earlier one had.  Earlier keys are those of the rows in silver and in
quarantine, read as columns and joined, so a first load neither shuffles nor keeps a key a second time; within a
batch the result is that of the batch functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from marlstone.operators.dedup import not_seen
from marlstone.operators.quality import RULES, dq_metrics, violates_drop_rule
from marlstone.operators.slices import slice_of, slices_for
from marlstone.plans.silver import CLEANERS, DEDUP_KEYS
from marlstone.schemas import ENTITIES
from marlstone.sources import files
from marlstone.sources.tables import PARQUET, SourceRewritten, TableStore

# Bounds a micro-batch, so that a first load of a large table proceeds in steps.
MAX_FILES_PER_BATCH = 10_000

DQ_SCHEMA = ("table_name string, rule string, action string, rows_checked long, rows_passed long, "
             "rows_failed long, rows_dropped long, batch_id long")


def append_stream(store: TableStore, df: DataFrame, layer: str, table: str) -> StreamingQuery:
    """Append a stream to a streaming table until its input is used up."""
    store.store_schema(layer, table, df.schema)
    query = (
        df.writeStream.foreachBatch(lambda batch, batch_id: store.append(batch, layer, table, batch_id))
        .option("checkpointLocation", store.checkpoint_path(layer, table))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def append_checked(store: TableStore, cleaned: DataFrame, entity: str, keys: Sequence[str] = ()) -> None:
    """Append a cleaned stream: good rows to silver, dropped ones to quarantine, rule counts to ``dq``.

    With ``keys``, rows whose key is there already, kept or dropped, are left out; a batch has a key once.
    A batch is written once, split by a flag; its counts come from the stored rows of both parts, so
    a re-run task cannot count twice.  One commit makes all three visible, and a repeated batch finds it.
    """
    spark, table = store.spark, ENTITIES[entity].silver
    store.store_schema("silver", table, cleaned.schema)
    rules = RULES[entity]
    nothing = spark.createDataFrame([], cleaned.schema)
    earlier = [parts[kind] for _, parts in store.commit_log("silver", table).commits()
               for kind in ("data", "quarantine")] if keys else []

    def append(batch: DataFrame, batch_id: int) -> None:
        if store.is_committed("silver", table, batch_id):
            return
        if earlier:
            # As a plan of the store's session: a stream's own session does not plan adaptively.
            seen = spark.read.schema(cleaned.schema).parquet(*earlier)
            batch = not_seen(nothing.unionByName(batch), seen, keys)
        part = store.new_part("silver", table)
        flagged = batch.withColumn("dropped", violates_drop_rule(rules))
        flagged.write.options(**PARQUET).partitionBy("dropped").parquet(f"{part}/rows")
        data, held, counts = f"{part}/rows/dropped=false", f"{part}/rows/dropped=true", f"{part}/dq"
        for folder in (data, held):
            files.make_folder(spark, folder)
        checked = spark.read.schema(batch.schema).parquet(data, held)
        dq_metrics(checked, rules, table).withColumn("batch_id", F.lit(batch_id).cast("long")).coalesce(1).write.parquet(counts)
        store.commit("silver", table, batch_id, data=data, quarantine=held, dq=counts)
        if keys:
            earlier.extend((data, held))

    (
        cleaned.writeStream.foreachBatch(append)
        .option("checkpointLocation", store.checkpoint_path("silver", table))
        .trigger(availableNow=True).start().awaitTermination()
    )


def stored_metrics(store: TableStore, entity: str) -> DataFrame:
    """Rule counts of every micro-batch of a silver table."""
    return store.read_parts("silver", ENTITIES[entity].silver, "dq", DQ_SCHEMA)


def quarantined(store: TableStore, entity: str) -> DataFrame:
    """The rows that drop rules kept out of a silver table."""
    table = ENTITIES[entity].silver
    return store.read_parts("silver", table, "quarantine", store.stored_schema("silver", table))


def collapse_arrivals(store: TableStore, entity: str, max_files: int) -> str:
    """Cleanse the bronze rows that are new, one row per key and batch; returns the table they are in."""
    source, target = ENTITIES[entity].bronze, f"{ENTITIES[entity].silver}_arrivals"
    if not store.stream_version("silver", target):
        store.open_stream_version("silver", target)
    store.bind_source("silver", target, "bronze", source)
    there = store.commit_log("bronze", source).last()
    rows = store.read_stream("bronze", source, max_files, store.source_position("silver", target))
    nothing = store.spark.createDataFrame([], rows.schema)
    store.store_schema("silver", target, CLEANERS[entity](nothing).schema)
    slices = slices_for(store.stored_bytes("bronze", source, store.source_position("silver", target)))
    # Cleaners leave this column as it is, so copies of a row have one slice.
    by = DEDUP_KEYS[entity][:1]

    def append(batch: DataFrame, batch_id: int) -> None:
        # As a plan of the store's session: a stream's own session does not plan adaptively.
        arrived = nothing.unionByName(batch)
        store.append([CLEANERS[entity](slice_of(arrived, by, n, slices)) for n in range(slices)], "silver", target, batch_id)

    (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", store.checkpoint_path("silver", target))
        .trigger(availableNow=True).start().awaitTermination()
    )
    store.advance_source("silver", target, there)
    return target


def _join_keys_only(store: TableStore, table: str, last: int) -> None:
    """Refuse a table whose stream kept its keys in a state store: its checkpoint does not fit any more."""
    if store.note("silver", table, "keys") is None:
        if last >= 0:
            raise SourceRewritten(f"silver.{table} was begun with keys in a state store; run a full refresh of it")
        store.note("silver", table, "keys", "joined")


def refresh_silver(store: TableStore, entity: str, max_files: int = MAX_FILES_PER_BATCH) -> dict[str, int]:
    """Cleanse the bronze rows that are new since the last run; returns the rule counts of this run."""
    source, target = ("bronze", ENTITIES[entity].bronze), ENTITIES[entity].silver
    if not store.stream_version("silver", target):
        store.open_stream_version("silver", target)
    bronze_rows = store.spark.createDataFrame([], store.stored_schema(*source))
    store.store_schema("silver", target, CLEANERS[entity](bronze_rows).schema)
    keys = DEDUP_KEYS.get(entity, ())
    if keys:
        source = "silver", collapse_arrivals(store, entity, max_files)
    store.bind_source("silver", target, *source)
    last, there = store.commit_log("silver", target).last(), store.commit_log(*source).last()
    position = store.source_position("silver", target)
    if keys:
        _join_keys_only(store, target, last)
        # A batch of arrivals has a key once, however its files are dealt to micro-batches.
        for upto in [n for n, _ in store.commit_log(*source).commits() if n > position] or [there]:
            append_checked(store, store.read_stream(*source, max_files, position, upto), entity, keys)
            store.advance_source("silver", target, upto)
            position = upto
    else:
        append_checked(store, CLEANERS[entity](store.read_stream(*source, max_files, position)), entity)
        store.advance_source("silver", target, there)
    new = stored_metrics(store, entity).where(F.col("batch_id") > last)
    per_rule = new.groupBy("rule").agg(F.sum("rows_checked").alias("n"), F.sum("rows_failed").alias("failed")).collect()
    if not per_rule:
        return {}
    return {"rows_checked": per_rule[0]["n"]} | {r["rule"]: r["failed"] for r in per_rule}
