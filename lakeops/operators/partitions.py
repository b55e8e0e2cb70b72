"""File names against patterns, and partition columns from names, dates or the load time.

A pattern is a name with ``<placeholder>`` fields, such as ``<yyyy><mm><dd>_cities.csv``; a field is as long as its name.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FIELD = re.compile(r"<([^>]+)>")
PARTS = {"yyyy": F.year, "mm": F.month, "dd": F.dayofmonth, "hh": F.hour}


def fields_of(pattern: str) -> list[tuple[str, int, int]]:
    """(placeholder, first position from 1, length) of each field in a matching name."""
    out, shift = [], 0
    for m in _FIELD.finditer(pattern):
        out.append((m[1], m.start() - shift + 1, len(m[1])))
        shift += 2
    return out


def regex_of(pattern: str) -> str:
    at, parts = 0, []
    for m in _FIELD.finditer(pattern):
        parts += [re.escape(pattern[at : m.start()]), f".{{{len(m[1])}}}"]
        at = m.end()
    return "^" + "".join([*parts, re.escape(pattern[at:])]) + "$"


def matches_pattern(name: Column, pattern: str) -> Column:
    """Fixed characters must be equal, fields may hold anything of their length."""
    return name.rlike(regex_of(pattern))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """file (the name), path, length and modified of every file below a landing folder. Spark's tasks list them; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "length", F.col("modificationTime").alias("modified"))


def match_files(files: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Adds ``dataset``, the one whose pattern a file's name matches, null for unknown files. A name that fits several datasets is an error."""
    fits = F.filter(F.array(*(F.when(matches_pattern(F.col("file"), p), F.lit(d)) for d, p in patterns.items())), lambda d: d.isNotNull())
    one = F.when(F.size(fits) > 1, F.raise_error(F.concat(F.lit("more than one dataset for "), "file", F.lit(": "), F.concat_ws(", ", fits)))).otherwise(F.get(fits, 0))
    return files.withColumn("dataset", one)


def from_file_name(df: DataFrame, name: Column, pattern: str, names: list[str] | None = None) -> DataFrame:
    """A string column for each field (of ``names``)."""
    return df.withColumns({p: F.substring(name, at, n) for p, at, n in fields_of(pattern) if names is None or p in names})


def from_date(df: DataFrame, column: str, parts: tuple[str, ...] = ("yyyy", "mm", "dd")) -> DataFrame:
    """``<column>_yyyy``, ``_mm``, ``_dd``, ``_hh`` integers."""
    return df.withColumns({f"{column}_{p}": PARTS[p](F.col(column)) for p in parts})


def add(df: DataFrame, file_name: Column | None = None, pattern: str | None = None, date_column: str | None = None, parts: tuple[str, ...] = ("yyyy", "mm", "dd"), loaded: datetime | None = None) -> tuple[DataFrame, list[str]]:
    """The strategy: fields of the file name, else a partitionable date, else the load time to the hour. Gives the frame and the new columns."""
    if pattern and file_name is not None:
        return from_file_name(df, file_name, pattern), [p for p, _, _ in fields_of(pattern)]
    if date_column:
        return from_date(df, date_column, parts), [f"{date_column}_{p}" for p in parts]
    if loaded is None:
        raise ValueError("nothing to partition by")
    stamped = df.withColumn("load", F.lit(loaded.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
    return from_date(stamped, "load", ("yyyy", "mm", "dd", "hh")).drop("load"), [f"load_{p}" for p in ("yyyy", "mm", "dd", "hh")]
