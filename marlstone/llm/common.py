"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import uuid

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marlstone.session import scratch_path

# Words are runs of characters outside ASCII white space, in every operator.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage for good."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tag(label: str) -> str:
    """A column name that no input column has."""
    return f"_{label}_{uuid.uuid4().hex[:8]}"


def remainder(ident: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def ascii_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; ``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D."""
    return encoded(text).lower().split()


class Memo(dict):
    """Results of ``f`` by argument; emptied when full, so that its memory is bounded."""

    def __init__(self, f, limit: int = 300_000):
        super().__init__()
        self.f, self.limit = f, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.f(key)
        return value


class Lately(Memo):
    """A memo in two halves: when one is full, the other half, of results not asked for since, is dropped."""

    def __init__(self, f, limit: int):
        super().__init__(f, limit // 2)
        self.before = {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.f(key)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Recent(dict):
    """Results by key, asked for in sets of keys; when full, those not asked for lately are dropped."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.before = limit // 2, {}

    def unseen(self, keys: set) -> list:
        """Keys that need a result; the results of the others stay here until the next call."""
        new = [k for k in keys if k not in self]
        if len(self) + len(new) > self.limit:
            self.before = dict(self)
            self.clear()
            new = list(keys)
        before = self.before
        self.update((k, before[k]) for k in new if k in before)
        return [k for k in new if k not in before]


def plain_pattern(pattern: str):
    """A word pattern, for texts of characters below U+0250 and what they are in lower case, in the quicker library where that is possible."""
    seen = sorted({c for k in range(0x250) for c in chr(k) + chr(k).lower()})
    quick = pattern
    for name in (r"\p{L}", r"\p{N}"):
        # One class within brackets by the characters it holds.
        quick = quick.replace(name, "".join(re.escape(c) for c in seen if regex.match(name, c)))
    return regex.compile(pattern) if r"\p" in quick or r"\P" in quick else re.compile(quick)


def per_process(key: tuple, make):
    """What ``make`` returns, kept for the next tasks of the same worker process.

    Functions travel by value, so a module's globals last only as long as a task; ``sys`` lasts.
    """
    kept = sys.__dict__.setdefault("_llm_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def forget_kept() -> None:
    """Give up what this worker process keeps for other operators, before a task that needs the room itself."""
    if sys.__dict__.pop("_llm_kept", None):
        gc.collect()  # memos refer to the engines that hold them
    release()


def release() -> None:
    """Hand freed memory back to the system: workers outlive their tasks, and idle ones count against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


def word_hasher() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def map_batches(df: DataFrame, schema: str | T.StructType, make) -> DataFrame:
    """``mapInArrow`` with ``make() -> (batch -> dict of columns)``; ``make`` runs once per task.

    If what it returns has an attribute ``end``, that is called when the task ends.
    """
    target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(target)

    def run(batches):
        work = make()
        try:
            for batch in batches:
                if batch.num_rows:
                    columns = work(batch)
                    yield pa.RecordBatch.from_arrays(
                        [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
                         for f in arrow], schema=arrow)
        finally:
            getattr(work, "end", lambda: None)()
            batch = columns = work = None
            release()

    return df.mapInArrow(run, target)
