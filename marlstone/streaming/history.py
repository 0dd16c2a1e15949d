"""Versioned dimensions kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.dedup import dedup_by_key
from marlstone.operators.history import END, START, scd2_versions
from marlstone.operators.slices import slices_for
from marlstone.sources.buckets import BUCKETS, BucketedTable
from marlstone.sources.tables import TableStore


def history_schema(changes: T.StructType, sequence: str) -> T.StructType:
    kind = changes[sequence].dataType
    return T.StructType([*changes.fields, T.StructField(START, kind), T.StructField(END, kind)])


def apply_changes(
    target: BucketedTable, changes: DataFrame, batch_id: int, sequence: str,
    track: Sequence[str] | None = None, slices: int = 1,
) -> None:
    """Merge a batch of changes into a history; late ones too, wherever they belong.

    The history of a bucket is made from all its changes, so what comes out does not depend on the
    order of the batches: it equals ``scd2_versions`` over everything.  With ``track`` the changes
    that repeat their predecessor are kept beside the history (kind ``log``), since a late change can
    still part them.  Changes without a sequence are left to ``unsequenced``.
    """
    keys = list(target.keys)
    schema = history_schema(changes.schema, sequence)
    # Copies of a change are one row before they meet the stored ones.
    fresh = dedup_by_key(changes.where(F.col(sequence).isNotNull()), [*keys, sequence])

    def rebuilt(rows, read):
        held = read("log", changes.schema) if track else read("data", schema).drop(START, END)
        log = held.unionByName(rows)
        versions = scd2_versions(log, keys, sequence, track)
        return {"log": dedup_by_key(log, [*keys, sequence]), "data": versions} if track else {"data": versions}

    target.merge(fresh, batch_id, rebuilt, slices)


def refresh_history(
    store: TableStore, source: tuple[str, str], target: tuple[str, str], keys: Sequence[str], sequence: str,
    track: Sequence[str] | None = None, buckets: int = BUCKETS, max_files: int | None = None,
    tags: Mapping[str, Mapping[str, str]] | None = None,
) -> BucketedTable:
    """Bring the history of a streaming table up to date with its committed batches.

    Each micro-batch reads and rewrites the buckets of its own keys.  A source that was opened anew starts the
    history anew; the versions readers use stay until then.  ``tags`` go to columns of the stored schema.
    """
    if store.stream_version(*target) and store.is_bound_elsewhere(*target, *source):
        store.open_stream_version(*target)
    table = BucketedTable.open(store, *target, keys, buckets)
    store.bind_source(*target, *source)
    there = store.commit_log(*source).last()
    full = history_schema(store.stored_schema(*source), sequence)
    store.store_schema(*target, T.StructType([
        T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, **(tags or {}).get(f.name, {})}) for f in full]))
    position = store.source_position(*target)
    rows = store.read_stream(*source, max_files, position)
    # A batch may meet all that is stored; of replaced folders the log keeps the lengths, so this is at least as much.
    slices = slices_for(store.stored_bytes(*source, position) + store.stored_bytes(*target))
    (
        rows.writeStream.foreachBatch(
            lambda batch, batch_id: apply_changes(table, batch, batch_id, sequence, track, slices))
        .option("checkpointLocation", store.checkpoint_path(*target))
        .trigger(availableNow=True).start().awaitTermination()
    )
    store.advance_source(*target, there)
    return table
