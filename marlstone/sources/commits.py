"""The commit log of a streaming table: which written folders belong to it.

A batch writes into folders that no other attempt uses.  Its entry in the log, one small file
written last, names those folders and their files; readers and streams see what the log names and nothing else.
So a commit is the creation of one object and needs no rename: what a lost attempt left behind, half or whole,
is never read.  An entry that was cut short lacks its closing mark and counts as not written.

Entries also keep length and time of every file, and of the files a batch was made from.  ``changed_files``
compares them with what is there now: a stream may only go on from sources that nobody rewrote.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources import files

# Up to so many entries the driver reads one by one, more in a Spark job.
FEW_ENTRIES = 100

FILE = "path string, length long, modified long"
_ENTRY = (f"batch_id long, parts map<string, string>, files array<struct<{FILE}>>, "
          f"sources array<struct<{FILE}>>, done boolean")


@dataclass(frozen=True)
class Commit:
    """One batch: its folders by kind, their files, and the files it was made from."""

    batch_id: int
    parts: dict[str, str]
    files: list[dict] = field(default_factory=list)
    sources: list[dict] = field(default_factory=list)

    def text(self) -> str:
        # The mark comes last, so that an entry cut short does not have it.
        return json.dumps({**asdict(self), "done": True})


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    folder: str

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/{batch_id:012d}.json"

    def _entry(self, path: str) -> Commit | None:
        try:
            found = json.loads(files.read_text(self.spark, path) or "")
        except ValueError:
            return None
        if not found.pop("done", False):
            return None
        return Commit(**found)

    def has(self, batch_id: int) -> bool:
        return self._entry(self._path(batch_id)) is not None

    def add(self, commit: Commit) -> None:
        """Make a batch part of the table; the last thing a batch does."""
        path = self._path(commit.batch_id)
        if self.has(commit.batch_id):
            raise FileExistsError(f"batch {commit.batch_id} is committed already")
        files.remove(self.spark, path)  # at most an entry cut short
        files.write_text(self.spark, path, commit.text())

    def entries(self) -> DataFrame:
        """All commits as rows; entries cut short are left out."""
        if not files.child_names(self.spark, self.folder):
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).json(self.folder).where("done")

    def commits(self) -> list[tuple[int, dict[str, str]]]:
        """(batch, folders by kind), oldest first: one small row per batch."""
        names = files.child_names(self.spark, self.folder)
        if len(names) <= FEW_ENTRIES:
            found = [c for n in names if (c := self._entry(f"{self.folder}/{n}"))]
            return sorted((c.batch_id, c.parts) for c in found)
        return sorted((r["batch_id"], r["parts"]) for r in self.entries().select("batch_id", "parts").collect())

    def last(self) -> int:
        """The newest committed batch; -1 without any."""
        return max((n for n, _ in self.commits()), default=-1)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a folder as (path, length, modified); Spark lists them, nothing is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select("path", "length", F.unix_millis("modificationTime").alias("modified"))


def changed_files(recorded: DataFrame, folder: str) -> DataFrame:
    """(path, change) of recorded files that were ``removed`` or ``rewritten`` since.

    ``recorded`` has one row per file (path, length, modified).  Files that nobody recorded are no change.
    """
    spark = recorded.sparkSession
    if not files.exists(spark, folder):
        return recorded.select("path", F.lit("removed").alias("change"))
    now = listing(spark, folder).select(
        "path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
    change = F.when(F.col("_length").isNull(), "removed").when(~same, "rewritten")
    return recorded.join(now, "path", "left").select("path", change.alias("change")).where("change is not null")
