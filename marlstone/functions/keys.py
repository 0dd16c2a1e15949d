"""Surrogate and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the key of the catch-all dimension row.
UNKNOWN_SK = -1


def surrogate_key(*parts: Column | str) -> Column:
    """64-bit hash of the business key: stable across runs, needs no sequence.

    A dimension with very many rows can collide on 64 bits; ``key_collisions`` in
    ``marlstone.operators.quality`` counts that.
    """
    return F.xxhash64(*[F.col(p) if isinstance(p, str) else p for p in parts])


def date_key(moment: Column | str) -> Column:
    """Calendar key ``yyyyMMdd`` as an int, computed without formatting text."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.day(moment)).cast("int")
