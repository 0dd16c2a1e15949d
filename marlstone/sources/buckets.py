"""Tables kept in buckets by key, of which a batch rewrites only those it touches.

A key belongs to the bucket of its hash.  A batch reads the buckets of its own keys, makes them anew in
folders of its own, and one commit says from then on which folder holds which bucket.  Other buckets
are neither read nor written; readers that started before keep the folders they planned with.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources import files
from marlstone.sources.tables import PARQUET, TableStore

BUCKETS = 256


@dataclass(frozen=True)
class BucketedTable:
    """A streaming table of ``store`` whose parts are buckets, by kind: ``data`` and others."""

    store: TableStore
    layer: str
    table: str
    keys: tuple[str, ...]
    buckets: int

    @staticmethod
    def open(store: TableStore, layer: str, table: str, keys: Sequence[str], buckets: int = BUCKETS) -> BucketedTable:
        """The table, made if there is none.  The number of buckets is that of the first time."""
        if not store.stream_version(layer, table):
            store.open_stream_version(layer, table)
        held = store.note(layer, table, "buckets")
        if held is None:
            store.note(layer, table, "buckets", str(buckets))
        return BucketedTable(store, layer, table, tuple(keys), int(held or buckets))

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, schema: T.StructType, kind: str = "data", only: set[int] | None = None) -> DataFrame:
        """What the buckets hold now: of every bucket the folder committed last."""
        return self.store.read_parts(self.layer, self.table, kind, schema, only)

    def merge(
        self, rows: DataFrame, batch_id: int,
        rebuilt: Callable[[DataFrame, Callable[[str, T.StructType], DataFrame]], dict[str, DataFrame]],
        slices: int = 1,
    ) -> None:
        """Make the buckets of the keys in ``rows`` anew.

        ``rebuilt(rows, read)`` returns the new content by kind for all keys of those buckets;
        ``read(kind, schema)`` gives what these buckets hold now.  The buckets are dealt to ``slices`` that are made one
        after the other.  A batch that is committed already does nothing.
        """
        if self.store.is_committed(self.layer, self.table, batch_id):
            return
        # At most as many numbers as there are buckets.
        touched = {r[0] for r in rows.select(self.bucket_of().alias("b")).distinct().collect()}
        if not touched:
            return
        part = self.store.new_part(self.layer, self.table)
        parts = {}
        for n in range(min(slices, len(touched))):
            some = set(sorted(touched)[n::slices])
            due = rows.where(self.bucket_of().isin(*some)) if len(some) < len(touched) else rows
            for kind, content in rebuilt(due, lambda k, s: self.read(s, k, some)).items():
                # Rebalancing splits the tasks of a bucket that a hot key makes large.
                content.withColumn("_bucket", self.bucket_of()).hint("rebalance", F.col("_bucket")).write.mode(
                    "append").options(**PARQUET).partitionBy("_bucket").parquet(f"{part}/{kind}")
                for b in some:
                    folder = f"{part}/{kind}/_bucket={b}"
                    files.make_folder(self.store.spark, folder)
                    parts[f"{kind}/{b}"] = folder
        self.store.commit(self.layer, self.table, batch_id, **parts)
