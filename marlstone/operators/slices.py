"""Work cut by key, so that the shuffles of one slice at a time are on disk.

Rows of one key are in one slice.  What is grouped or joined by that key can be made slice by slice and
written one after the other: the result is the same, the input is read once per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stored bytes per slice; rows in a shuffle take several times their stored size.
SLICE_BYTES = 256 << 20


def slices_for(stored_bytes: int) -> int:
    """Into how many slices to cut work over so many stored bytes."""
    return max(1, -(-stored_bytes // SLICE_BYTES))


def slice_of(df: DataFrame, keys: Sequence[str], number: int, slices: int) -> DataFrame:
    """The rows of one slice; NULL keys have one too."""
    return df if slices == 1 else df.where(F.pmod(F.xxhash64(*keys), F.lit(slices)) == number)


def planned_bytes(df: DataFrame) -> int:
    """What the planner expects to read; of stored tables the size of their files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
