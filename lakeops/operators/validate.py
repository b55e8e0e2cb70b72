"""Structural checks of a batch, thresholds, the final gate and its outcome."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.spec import ABSOLUTE, FAIL_FAST, PERCENTAGE, PERMISSIVE, REJECT

CORRUPT = "_corrupt_record"
REJECTED_UNKNOWN, REJECTED_CORRUPTED, REJECTED_SCHEMA_MISMATCH, REJECTED_INVALID = "REJECTED_UNKNOWN", "REJECTED_CORRUPTED", "REJECTED_SCHEMA_MISMATCH", "REJECTED_INVALID"
INGESTED_WITH_ERRORS, INGESTED_WITHOUT_ERRORS = "INGESTED_WITH_ERRORS", "INGESTED_WITHOUT_ERRORS"


class Structure(NamedTuple):
    valid: DataFrame
    wrong: DataFrame


def is_wrong(df: DataFrame, corrupt: str = CORRUPT) -> Column:
    """Whether the reader could not take a row apart. It looks at the other columns as well: Spark refuses to read a file for the corrupt column alone."""
    others = [F.col(f"`{c}`") for c in df.columns if c != corrupt]
    return F.col(corrupt).isNotNull() & (F.xxhash64(*others) >= F.lit(-(1 << 63)))


def structural_split(df: DataFrame, corrupt: str = CORRUPT) -> Structure:
    """Rows that the reader could take apart, and the raw text of those it could not."""
    if corrupt not in df.columns:
        return Structure(df, df.select(F.lit(None).cast("string").alias(corrupt)).where(F.lit(False)))
    # both sides look at all columns: a reader that is asked for some takes only those apart, and misses rows that are wrong elsewhere
    wrong = is_wrong(df, corrupt)
    return Structure(df.where(~wrong).drop(corrupt), df.where(wrong).select(corrupt))


def under_threshold(bad: Column, total: Column, threshold: float, kind: str) -> Column:
    if kind == ABSOLUTE:
        return bad <= threshold
    if kind == PERCENTAGE:
        return F.coalesce(F.try_divide(100 * bad, total) <= threshold, F.lit(True))
    raise ValueError(f"unknown threshold kind {kind}")


def accept(counts: DataFrame, mode: str, threshold: float = 0, kind: str = ABSOLUTE) -> DataFrame:
    """Adds ``accepted`` to rows of (valid, wrong) counts: one valid row at least, and no wrong one, or in permissive mode few."""
    valid, wrong = F.col("valid"), F.col("wrong")
    few = under_threshold(wrong, valid + wrong, threshold, kind) if mode == PERMISSIVE else F.lit(False)
    return counts.withColumn("accepted", (valid > 0) & ((wrong == 0) | few))


def gate(counts: DataFrame, mode: str, threshold: float = 0, kind: str = ABSOLUTE, quality_mode: str | None = None) -> DataFrame:
    """Adds ``passed`` to rows of (total, invalid, failed): failed quality rows count in reject mode only."""
    bad = F.col("invalid") + (F.col("failed") if quality_mode == REJECT else F.lit(0))
    ok = bad == 0 if mode == FAIL_FAST else under_threshold(bad, F.col("total"), threshold, kind)
    return counts.withColumn("passed", ok)


def outcome(structured: Column, castable: Column, errors: Column, known: Column | None = None, readable: Column | None = None) -> Column:
    """The label of a batch: the first check that failed, or how it was ingested."""
    label = F.when(known == False, REJECTED_UNKNOWN) if known is not None else None  # noqa: E712
    if readable is not None:
        label = label.when(~readable, REJECTED_CORRUPTED) if label is not None else F.when(~readable, REJECTED_CORRUPTED)
    label = label.when(~structured, REJECTED_SCHEMA_MISMATCH) if label is not None else F.when(~structured, REJECTED_SCHEMA_MISMATCH)
    return label.when(~castable, REJECTED_INVALID).when(errors > 0, INGESTED_WITH_ERRORS).otherwise(INGESTED_WITHOUT_ERRORS)


def header_matches(actual: list[str], declared: list[str]) -> bool:
    """Equal length and equal names in order, case aside."""
    return [c.strip().lower() for c in actual] == [c.strip().lower() for c in declared]


def schema_matches(actual: T.StructType, required: T.StructType) -> bool:
    """Equal width, and every required field there with its type and nullability; metadata aside."""
    there = {f.name: (f.dataType, f.nullable) for f in actual.fields}
    return len(actual) == len(required) and all(there.get(f.name) == (f.dataType, f.nullable) for f in required.fields)


def columns_present(df: DataFrame, names: list[str], exactly: bool = False) -> bool:
    there = {c.lower() for c in df.columns}
    wanted = {n.lower() for n in names}
    return wanted <= there and (not exactly or len(df.columns) == len(names))


def for_format(kind: str):
    """The structural check of a format: text formats split rows, typed formats compare schemas, JSON does both."""
    checks = {"csv": structural_split, "xls": structural_split, "json": structural_split, "api": structural_split, "topic": structural_split, "parquet": schema_matches, "orc": schema_matches, "avro": schema_matches, "table": schema_matches}
    if kind not in checks:
        raise ValueError(f"no validator for {kind}")
    return checks[kind]


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: counts of both, and how many rows of each the other lacks (duplicates counted); both zero means equal tables."""
    b = b.select(*a.columns)
    sides = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    per_row = sides.groupBy(*a.columns).agg(F.sum("_side").alias("d"), F.count_if(F.col("_side") == 1).alias("l"), F.count_if(F.col("_side") == -1).alias("r"))
    zero = F.lit(0).cast("long")
    total = per_row.agg(*(F.coalesce(F.sum(c), zero).alias(n) for c, n in ((F.col("l"), "left_rows"), (F.col("r"), "right_rows"), (F.greatest("d", zero), "only_left"), (F.greatest(-F.col("d"), zero), "only_right"))))
    return total.withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))
