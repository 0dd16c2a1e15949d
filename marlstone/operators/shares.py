"""Shares, running shares and reference lines over small grouped results.

All windows here run over rows that are already grouped (scores, statuses,
states, categories, calendar days), never over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.numbers import safe_ratio

# A decimal: shares of counts are then exact to the digits shown.
_HUNDRED = Decimal("100.0")


def share_of_total(value: Column) -> Column:
    """Percentage of the column's total over all rows."""
    return safe_ratio(value * F.lit(_HUNDRED), F.sum(value).over(Window.partitionBy()))


def cumulative_share(df: DataFrame, value: str, tie_breaker: str, into: str = "cumulative_pct") -> DataFrame:
    """Running percentage of the total, largest value first (a Pareto line)."""
    running = Window.orderBy(F.col(value).desc_nulls_last(), F.col(tie_breaker)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.withColumn(
        into, safe_ratio(F.sum(value).over(running) * F.lit(_HUNDRED), F.sum(value).over(Window.partitionBy()))
    )


def with_average(df: DataFrame, value: str, into: str) -> DataFrame:
    """The mean over all rows beside each row (a reference line)."""
    return df.withColumn(into, F.avg(value).over(Window.partitionBy()))


def top_k(df: DataFrame, value: str, k: int, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The ``k`` largest rows; each task keeps only its own ``k`` candidates."""
    return df.orderBy(F.col(value).desc_nulls_last(), *tie_breakers).limit(k)


def top_k_share(df: DataFrame, value: str, k: int, tie_breaker: str) -> DataFrame:
    """The ``k`` largest rows with their share of the total of all rows."""
    total = df.agg(F.sum(value)).scalar()
    largest = top_k(df, value, k, [tie_breaker])
    return largest.withColumn("share_pct", safe_ratio(F.col(value) * F.lit(_HUNDRED), total))
