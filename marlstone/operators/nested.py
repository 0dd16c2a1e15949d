"""Arrays to rows, structs to columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_struct_array(df: DataFrame, array: str, keep: list[str], fields: list[str]) -> DataFrame:
    """One row per array element; rows with an empty or NULL array disappear."""
    one_per_element = df.select(*keep, F.explode(array).alias("_element"))
    return one_per_element.select(*keep, *[F.col(f"_element.{name}").alias(name) for name in fields])


def flatten_struct(df: DataFrame, struct: str, fields: Mapping[str, str]) -> DataFrame:
    """Replace a struct by columns: field name -> column name; grain unchanged."""
    return df.select(
        *[c for c in df.columns if c != struct],
        *[F.col(f"{struct}.{name}").alias(column) for name, column in fields.items()],
    )
