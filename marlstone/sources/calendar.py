"""Calendar rows, generated by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default bounds of the calendar.
FIRST_DAY, LAST_DAY = "2024-01-01", "2027-12-31"


def calendar_days(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def calendar_span(df: DataFrame, moment: str) -> DataFrame:
    """One row per day from the first to the last date of a column."""
    span = df.agg(F.min(moment).cast("date").alias("a"), F.max(moment).cast("date").alias("b"))
    return span.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
