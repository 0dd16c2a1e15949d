"""Joins between facts and dimensions.

No join here carries a broadcast hint on a table that can grow.  Catalyst
broadcasts a side only below ``spark.sql.autoBroadcastJoinThreshold``, the
adaptive planner checks the real size again at run time, and beyond it the join
is a sort-merge join whose skewed partitions the adaptive planner splits.  The
side that can be skewed (the fact) is always on the left, where both inner and
left joins can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.keys import UNKNOWN_SK


def inner_equi_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return left.join(right, on, "inner")


def left_equi_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return left.join(right, on, "left")


def left_join_current_version(
    rows: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Attach ``columns`` of the current version; rows without one keep NULLs."""
    current = dimension.where(F.col("is_current")).select(key, *columns)
    return rows.join(current, key, "left")


def left_join_on_expression(
    rows: DataFrame, dimension: DataFrame, expression: Column, dimension_key: str,
    columns: Sequence[str],
) -> DataFrame:
    """Join on a computed key; computed once, so the join stays an equi-join."""
    keyed = rows.withColumn("_join_key", expression)
    looked_up = dimension.select(F.col(dimension_key).alias("_join_key"), *columns)
    return keyed.join(looked_up, "_join_key", "left").drop("_join_key")


def unknown_member_join(
    rows: DataFrame, dimension: DataFrame, key: str, surrogate: str, unknown: int = UNKNOWN_SK
) -> DataFrame:
    """Look up a surrogate key; rows without a match point at the unknown member."""
    found = rows.join(dimension.select(key, surrogate), key, "left")
    return found.withColumn(surrogate, F.coalesce(F.col(surrogate), F.lit(unknown).cast("long")))


def join_with_unknown_member(
    fact: DataFrame, dimension: DataFrame, surrogate: str, spread: Sequence[str],
    unknown: int = UNKNOWN_SK, salts: int = 64,
) -> DataFrame:
    """Inner join on a surrogate key whose unknown member may hold most of the fact.

    The unknown member is the one value known beforehand to be hot, so its fact
    rows are spread over ``salts`` copies of that single dimension row by a hash of
    ``spread``.  All other dimension rows are kept once.
    """
    is_unknown = F.col(surrogate) == unknown
    salted_fact = fact.withColumn(
        "_salt",
        F.when(is_unknown, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)).cast("int"),
    )
    copies = F.when(is_unknown, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dimension = dimension.withColumn("_salt", F.explode(copies))
    return salted_fact.join(salted_dimension, [surrogate, "_salt"], "inner").drop("_salt")
