"""Raw copies: each write of a file's table goes to a folder of its own, the newest number is current."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lakeops.scratch import exists, folders


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(m[1]) for f in folders(spark, path) if (m := re.fullmatch(r"_?v(\d+)", f)))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions whose write has ended."""
    return [n for n in _numbers(spark, path) if exists(spark, f"{path}/v{n}/_SUCCESS")]


def write_versioned(df: DataFrame, path: str) -> int:
    """Writes the next version; the number of a failed one is not used again."""
    number = max(_numbers(df.sparkSession, path), default=0) + 1
    df.write.parquet(f"{path}/v{number}")
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version, or the newest whole one."""
    whole = versions(spark, path)
    if number is None and not whole or number is not None and number not in whole:
        raise ValueError(f"no version {number or ''} at {path}".replace("  ", " "))
    return spark.read.parquet(f"{path}/v{number or whole[-1]}")
