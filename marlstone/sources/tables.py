"""Layered Parquet tables below one root folder.

``<root>/<layer>/<table>/v=<n>`` holds one version of a table.  A materialized
view gets a new version at every refresh and readers take the newest one whose
write has finished; a streaming table appends within its version until a full
refresh opens the next.  What a streaming table holds is what its commit log names
(``sources.commits``).  A running reader keeps the files it planned with, and no
job ever overwrites what it reads.

The root stands for the environment (dev, test, prod): the same code with another
root builds another copy.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources import files
from marlstone.sources.commits import Commit, CommitLog, changed_files

LAYERS = ("bronze", "silver", "gold")

# How stored tables are written.
PARQUET = {"compression": "zstd"}
# Keeps a write from marking its folder as finished.
UNFINISHED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


class SourceRewritten(RuntimeError):
    """The input of a stream is no longer the table the stream started from."""


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str

    def _folder(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def _versions(self, layer: str, table: str) -> list[int]:
        names = files.child_names(self.spark, self._folder(layer, table))
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())

    def version_path(self, layer: str, table: str, version: int) -> str:
        return f"{self._folder(layer, table)}/v={version}"

    # -- materialized views -------------------------------------------------

    def finished_version(self, layer: str, table: str) -> int | None:
        """Newest version whose write has finished."""
        for version in reversed(self._versions(layer, table)):
            if files.exists(self.spark, f"{self.version_path(layer, table, version)}/_SUCCESS"):
                return version
        return None

    def publish(
        self, df: DataFrame | Sequence[DataFrame], layer: str, table: str, partition_by: list[str] | None = None
    ) -> int:
        """Write a new version; it becomes visible when its last file is in place.

        Slices of a table are written one after the other; the last one makes the version visible.
        """
        version = max(self._versions(layer, table), default=0) + 1
        frames = [df] if isinstance(df, DataFrame) else list(df)
        for n, frame in enumerate(frames, 1):
            writer = frame.write.mode("error" if n == 1 else "append").options(**PARQUET)
            if n < len(frames):
                writer = writer.options(**UNFINISHED)
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(self.version_path(layer, table, version))
        return version

    def state_of(self, layer: str, table: str) -> str:
        """What tells whether a table changed: its version, and the last batch of a streaming table."""
        if self.stream_version(layer, table):
            return f"{layer}.{table} s{self.stream_version(layer, table)}.{self.commit_log(layer, table).last()}"
        return f"{layer}.{table} v{self.finished_version(layer, table)}"

    def refresh_view(
        self, layer: str, table: str, inputs: Sequence[tuple[str, str]],
        build: Callable[[], DataFrame | Sequence[DataFrame]], note: str = "",
    ) -> bool:
        """Publish a view unless it was made from the present state of its inputs; says whether it was.

        ``note`` stands for whatever else the view depends on, such as parameters.
        """
        made_from = "\n".join([*[self.state_of(*i) for i in inputs], note])
        newest = self.finished_version(layer, table)
        if newest and files.read_text(self.spark, f"{self.version_path(layer, table, newest)}/_inputs") == made_from:
            return False
        version = self.publish(build(), layer, table)
        files.write_text(self.spark, f"{self.version_path(layer, table, version)}/_inputs", made_from)
        return True

    def read(self, layer: str, table: str) -> DataFrame:
        """Batch read of the newest version of a view or streaming table."""
        if self.stream_version(layer, table):
            return self.read_parts(layer, table, "data", self.stored_schema(layer, table))
        version = self.finished_version(layer, table)
        if version is None:
            raise FileNotFoundError(f"{layer}.{table} has no finished version")
        return self.spark.read.parquet(self.version_path(layer, table, version))

    # -- streaming tables ---------------------------------------------------

    def stream_version(self, layer: str, table: str) -> int:
        """Current version of a streaming table; 0 if there is none."""
        names = files.child_names(self.spark, f"{self._folder(layer, table)}/_streaming")
        return max((int(n) for n in names if n.isdigit()), default=0)

    def open_stream_version(self, layer: str, table: str) -> int:
        """Start an empty version with a checkpoint of its own."""
        version = self.stream_version(layer, table) + 1
        files.make_folder(self.spark, f"{self.version_path(layer, table, version)}/parts")
        files.write_text(self.spark, f"{self._folder(layer, table)}/_streaming/{version}", "")
        return version

    def _stream_folder(self, layer: str, table: str) -> str:
        return self.version_path(layer, table, self.stream_version(layer, table))

    def commit_log(self, layer: str, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self._stream_folder(layer, table)}/log")

    def new_part(self, layer: str, table: str) -> str:
        """A folder for what one attempt of a batch writes; it counts once the batch is committed."""
        return f"{self._stream_folder(layer, table)}/parts/{uuid.uuid4().hex}"

    def is_committed(self, layer: str, table: str, batch_id: int) -> bool:
        return self.commit_log(layer, table).has(batch_id)

    def commit(
        self, layer: str, table: str, batch_id: int, sources: Sequence[dict] = (), **parts: str
    ) -> None:
        """Make written folders, by kind, part of the table, all at once."""
        written = [f for folder in parts.values() for f in files.list_files(self.spark, folder)]
        self.commit_log(layer, table).add(Commit(batch_id, parts, written, list(sources)))

    def append(self, df: DataFrame | Sequence[DataFrame], layer: str, table: str, batch_id: int) -> None:
        """Write and commit the rows of one batch, slices of it one after the other; a batch that is committed
        already adds nothing."""
        frames = [df] if isinstance(df, DataFrame) else list(df)
        if self.is_committed(layer, table, batch_id):
            # Only the stream's own state has to be brought up to date.
            for frame in frames:
                frame.write.format("noop").mode("overwrite").save()
            return
        part = self.new_part(layer, table)
        for frame in frames:
            frame.write.mode("append").options(**PARQUET).parquet(part)
        self.commit(layer, table, batch_id, data=part)

    def stored_bytes(self, layer: str, table: str, after: int = -1) -> int:
        """Bytes of the files that a streaming table committed above batch ``after``."""
        lengths = self.commit_log(layer, table).entries().where(F.col("batch_id") > after).select(F.inline("files"))
        return lengths.agg(F.sum("length")).first()[0] or 0

    def checkpoint_path(self, layer: str, table: str) -> str:
        return f"{self._stream_folder(layer, table)}/checkpoint"

    def read_parts(
        self, layer: str, table: str, kind: str, schema: T.StructType | str, buckets: set[int] | None = None
    ) -> DataFrame:
        """The ``data``, ``quarantine`` or ``dq`` rows of all committed batches of a streaming table.

        Of a table kept in buckets, every bucket's newest folder, or those of ``buckets`` only.
        """
        folders = []
        newest: dict[str, str] = {}
        for _, parts in self.commit_log(layer, table).commits():
            if kind in parts:
                folders.append(parts[kind])
            # Buckets (``kind/number``) hold what was committed for them last.
            newest |= {name: folder for name, folder in parts.items() if name.startswith(f"{kind}/")}
        folders += [f for name, f in newest.items() if buckets is None or int(name.rpartition("/")[2]) in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read_batches(self, layer: str, table: str, after: int, upto: int) -> DataFrame:
        """The rows of the batches committed above ``after`` and up to ``upto``."""
        schema = self.stored_schema(layer, table)
        commits = self.commit_log(layer, table).commits()
        folders = [parts["data"] for n, parts in commits if after < n <= upto and "data" in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def stored_schema(self, layer: str, table: str) -> T.StructType | None:
        folder = f"{self.version_path(layer, table, self.stream_version(layer, table))}/schema"
        numbers = [int(n) for n in files.child_names(self.spark, folder) if n.isdigit()]
        if not numbers:
            return None
        text = files.read_text(self.spark, f"{folder}/{max(numbers)}")
        return T.StructType.fromJson(json.loads(text))

    def store_schema(self, layer: str, table: str, schema: T.StructType) -> None:
        """Record a schema if it differs from the stored one; older ones stay as history."""
        if self.stored_schema(layer, table) == schema:
            return
        folder = f"{self.version_path(layer, table, self.stream_version(layer, table))}/schema"
        numbers = [int(n) for n in files.child_names(self.spark, folder) if n.isdigit()]
        files.write_text(self.spark, f"{folder}/{max(numbers, default=0) + 1}", schema.json())

    def read_stream(
        self, layer: str, table: str, max_files: int | None = None, after: int = -1, upto: int | None = None
    ) -> DataFrame:
        """Streaming read of a streaming table: the committed batches above ``after``, and up to ``upto`` if given.

        The stream lists folders of committed batches only, so it never meets the files of a batch
        that is being written or was given up.
        """
        folders = [parts["data"] for n, parts in self.commit_log(layer, table).commits()
                   if n > after and (upto is None or n <= upto) and "data" in parts]
        base = f"{self._stream_folder(layer, table)}/parts"
        names = [f.removeprefix(f"{base}/") for f in folders]
        # Always a pattern: a repeated batch may read files of folders that are not listed any more.
        path = f"{base}/{{{','.join(names) or 'none'}}}"
        reader = self.spark.readStream.schema(self.stored_schema(layer, table))
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(path)

    def note(self, layer: str, table: str, name: str, text: str | None = None) -> str | None:
        """A small text kept with a version of a streaming table; written once, or read."""
        path = f"{self._stream_folder(layer, table)}/{name}"
        if text is not None:
            files.write_text(self.spark, path, text)
        return files.read_text(self.spark, path) if text is None else text

    def is_bound_elsewhere(self, layer: str, table: str, source_layer: str, source: str) -> bool:
        """Whether a stream started from another version of its source than the present one."""
        bound = self.note(layer, table, "source")
        return bound is not None and bound != f"{source_layer}.{source} v{self.stream_version(source_layer, source)}"

    def bind_source(self, layer: str, table: str, source_layer: str, source: str) -> None:
        """Tie a stream to the version of its source it started from, and to the files of that version.

        A file stream would read rewritten files a second time, or miss what was removed, without a
        word; this check refuses instead, and a full refresh resolves it.
        """
        current = f"{source_layer}.{source} v{self.stream_version(source_layer, source)}"
        bound = self.note(layer, table, "source")
        if bound is None:
            self.note(layer, table, "source", current)
        elif bound != current:
            raise SourceRewritten(
                f"{layer}.{table} was built from {bound}, its source is now {current}; "
                "run a full refresh of it and of all tables built from it"
            )
        recorded = self.commit_log(source_layer, source).entries().select(F.inline("files"))
        refuse_changes(recorded, f"{self._stream_folder(source_layer, source)}/parts", f"{source_layer}.{source}")

    def source_position(self, layer: str, table: str) -> int:
        """The last batch of its source that a stream has read to the end; -1 before the first run."""
        folder = f"{self._stream_folder(layer, table)}/read"
        return max((int(n) for n in files.child_names(self.spark, folder) if n.isdigit()), default=-1)

    def advance_source(self, layer: str, table: str, position: int) -> None:
        """Note that a run has read all batches of its source up to ``position``."""
        if position > self.source_position(layer, table):
            files.write_text(self.spark, f"{self._stream_folder(layer, table)}/read/{position}", "")


def refuse_changes(recorded: DataFrame, folder: str, name: str, removed_ok: bool = False) -> None:
    """Raise if files that a stream has read were rewritten or removed since."""
    changed = changed_files(recorded, folder)
    if removed_ok:
        changed = changed.where("change <> 'removed'")
    found = changed.orderBy("path").limit(3).collect()
    if found:
        raise SourceRewritten(
            f"files of {name} changed after they were read: " + ", ".join(f"{r['path']} ({r['change']})" for r in found)
            + "; run a full refresh of all tables built from them")
