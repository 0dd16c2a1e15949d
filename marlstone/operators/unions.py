"""Literal rows and unions by column name."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_row(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """One row with the columns and types of ``df``; columns not named are NULL."""
    return df.sparkSession.range(1).select(*[
        F.lit(values.get(field.name)).cast(field.dataType).alias(field.name)
        for field in df.schema.fields
    ])


def with_sentinel(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """``df`` and one literal row, all duplicates kept."""
    return df.unionByName(literal_row(df, values))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs; columns missing somewhere are NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def same_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; columns ``df`` lacks become NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
