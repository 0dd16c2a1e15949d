"""Landing files to bronze: every file once, raw rows with metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.schemas import ENTITIES, INGEST_METADATA, Entity, bronze_schema
from marlstone.sources.landing import keeping_raw, read_landing_files, with_ingest_metadata
from marlstone.sources.tables import PARQUET, TableStore, refuse_changes

# Bounds what one micro-batch lists on the driver.
MAX_FILES_PER_BATCH = 1000

_FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_landing(spark: SparkSession, path: str, entity: Entity, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """Streaming rows of landing files that all follow the entity's schema."""
    reader = keeping_raw(spark.readStream, entity.schema).option("maxFilesPerTrigger", max_files)
    if entity.format == "csv":
        # A header that differs from the schema fails the stream; columns are never mixed up.
        reader = reader.option("header", True).option("enforceSchema", False)
    return with_ingest_metadata(reader.format(entity.format).load(path))


def _append_new_files(store: TableStore, entity: Entity, folder: str, max_files: int) -> None:
    """Ingest with schema evolution.

    The stream carries only the names of new files (its checkpoint remembers which
    ones are done); each batch reads its files grouped by header, writes one folder and
    commits it with the names, lengths and times of the files it came from.  A repeated
    batch finds its commit and does nothing, or starts over where it never got there.
    """
    spark = store.spark
    listing = (
        spark.readStream.format("binaryFile").schema(_FILE_LISTING)
        .option("maxFilesPerTrigger", max_files).load(folder)
        .select("path", "length", F.unix_millis("modificationTime").alias("modified"))
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        if store.is_committed("bronze", entity.bronze, batch_id):
            return
        # A listing can name a file with glob marks more than once.
        found = {row["path"]: row.asDict() for row in batch.collect()}
        if not found:
            return
        paths = sorted(found)
        stored = store.stored_schema("bronze", entity.bronze)
        landed = stored[:-len(INGEST_METADATA)] if stored else entity.schema
        rows, widened = read_landing_files(spark, paths, entity.format, landed)
        store.store_schema("bronze", entity.bronze, bronze_schema(widened))
        part = store.new_part("bronze", entity.bronze)
        rows.write.options(**PARQUET).parquet(part)
        store.commit("bronze", entity.bronze, batch_id, [found[p] for p in paths], data=part)

    (
        listing.writeStream.foreachBatch(append)
        .option("checkpointLocation", store.checkpoint_path("bronze", entity.bronze))
        .trigger(availableNow=True).start().awaitTermination()
    )


def _append_fixed_schema(store: TableStore, entity: Entity, folder: str, max_files: int) -> None:
    """Ingest files that all follow the entity's schema, in one streaming scan."""
    (
        stream_landing(store.spark, folder, entity, max_files).writeStream
        .foreachBatch(lambda batch, batch_id: store.append(batch, "bronze", entity.bronze, batch_id))
        .option("checkpointLocation", store.checkpoint_path("bronze", entity.bronze))
        .trigger(availableNow=True).start().awaitTermination()
    )


def refresh_bronze(
    store: TableStore, entity: Entity | str, landing_root: str,
    evolve: bool = True, max_files: int = MAX_FILES_PER_BATCH, archived: bool = False,
) -> None:
    """Ingest the files that are new since the last run; a run without any adds nothing.

    Landing files that were ingested must stay as they were: one that was rewritten raises
    ``SourceRewritten``, and so does a missing one unless ``archived`` says that files may leave.
    (With a fixed schema the log does not name landing files, and they are not compared.)
    """
    if isinstance(entity, str):
        entity = ENTITIES[entity]
    folder = f"{landing_root.rstrip('/')}/{entity.name}"
    if not store.stream_version("bronze", entity.bronze):
        store.open_stream_version("bronze", entity.bronze)
    if store.stored_schema("bronze", entity.bronze) is None:
        store.store_schema("bronze", entity.bronze, bronze_schema(entity.schema))
    ingested = store.commit_log("bronze", entity.bronze).entries().select(F.inline("sources"))
    refuse_changes(ingested, folder, f"landing files of {entity.name}", archived)
    ingest = _append_new_files if evolve else _append_fixed_schema
    ingest(store, entity, folder, max_files)
