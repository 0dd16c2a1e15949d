"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key; NULL keys count as one key.

    Batch: the smallest row wins (NULL before any value), compared on ``order_by``
    first and then on all other columns, so reruns agree.  It is an aggregate, not
    a window: copies collapse before the shuffle, so a key holding a third of the
    input reaches its reducer as one row per map task.

    Stream: the first arrival wins, and every key seen stays in the state store.
    """
    keys = list(keys)
    if df.isStreaming:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [c for c in (order_by or []) if c not in keys]
    ranked += [c for c in rest if c not in ranked]
    winner = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_winner"))
    return winner.select(
        *[F.col(c) if c in keys else F.col("_winner").getField(c).alias(c) for c in df.columns]
    )


def not_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``seen`` does not have; NULL keys count as one key."""
    held = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return df.join(held, reduce(lambda a, b: a & b, same), "left_anti")


def latest_by_key(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The row with the greatest sequence per key (an overwriting dimension).

    Ties on the sequence are broken by the remaining columns.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys and c != sequence]
    if not others:
        return df.groupBy(*keys).agg(F.max(sequence).alias(sequence)).select(*df.columns)
    ranked = [sequence, *others]
    winner = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_winner"))
    return winner.select(
        *[F.col(c) if c in keys else F.col("_winner").getField(c).alias(c) for c in df.columns]
    )
