"""The version of each key that is in force at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def current_as_of(df: DataFrame, keys: list[str], effective: str, when, enabled: str | None = None, ties: list[str] | None = None) -> DataFrame:
    """Enabled versions that are in force by ``when``, the newest of each key."""
    known = df.where(F.col(effective) <= F.lit(when))
    known = known.where(F.col(enabled)) if enabled else known
    order = [F.col(effective).desc(), *(F.col(t).desc() for t in ties or [])]
    return known.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def ambiguous(matches: DataFrame, item: str, name: str) -> DataFrame:
    """Items that match the patterns of more than one name."""
    return matches.groupBy(item).agg(F.count_distinct(name).alias("names")).where("names > 1")
