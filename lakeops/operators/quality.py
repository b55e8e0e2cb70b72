"""Quality rules evaluated in one pass: every row gets the names of the rules that it fails.

Uniqueness costs one shuffle a rule, integrity one join with the distinct keys (broadcast by the planner where their known size allows it);
not-null and expression rules are plain columns. Nothing is unioned or subtracted.

Keys with a large share of all rows (nulls, defaults) don't make a large task: a sample finds them, at most ``2 / HOT`` of them, and their first rows are aggregated, partially before
the shuffle. Other rows of such a key have lost already; they are spread by a salt. What meets in one task of a hot key are copies of its first row, equal in every column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

FAILED = "failed_rules"
#: The share of rows that makes a key hot, the rows of the sample that finds it, and the parts that its rows are spread over.
HOT, SAMPLED, SALTS = 0.005, 10_000, 256


@dataclass(frozen=True)
class Unique:
    """One row of equal values survives: the first by ``order_by``, then by a hash of the row."""

    columns: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    name: str = "unique"


@dataclass(frozen=True)
class NotNull:
    columns: tuple[str, ...]
    nan_is_null: bool = False
    name: str = "not_null"


@dataclass(frozen=True)
class Integrity:
    """The columns must occur together in ``reference`` as ``keys`` (by position); a null among them fails."""

    columns: tuple[str, ...]
    reference: DataFrame
    keys: tuple[str, ...]
    name: str = "integrity"


@dataclass(frozen=True)
class Expression:
    """A SQL condition; false and null fail."""

    sql: str
    name: str = "expression"


def _missing(df: DataFrame, rule: NotNull) -> Column:
    kinds = dict(df.dtypes)

    def one(c: str) -> Column:
        bad = F.col(c).isNull()
        return bad | F.isnan(c) if rule.nan_is_null and kinds.get(c) in ("float", "double") else bad

    bad = one(rule.columns[0])
    for c in rule.columns[1:]:
        bad = bad | one(c)
    return bad


def hot_keys(df: DataFrame, columns: list[str], share: float = HOT, sampled: int = SAMPLED) -> list[Row]:
    """Keys that have about ``share`` of all rows or more. One pass over their columns; a task sends at most ``sampled`` rows on."""
    some = df.select(*columns).orderBy(F.rand(23)).limit(sampled).groupBy(*columns).agg(F.count("*").alias("_n")).collect()
    of = sum(r["_n"] for r in some)
    return [r[:-1] for r in some if r["_n"] > 1 and r["_n"] >= share / 2 * of]


def _repeats(df: DataFrame, columns: list[str], order: list[Column], row: Column, flag: str) -> DataFrame:
    """Adds whether a row is not the first one of its key."""
    hot = hot_keys(df, columns)
    if not hot:
        return df.withColumn(flag, F.row_number().over(Window.partitionBy(*columns).orderBy(*order)) > 1)
    names = [f"_hot_{i}" for i in range(len(columns))]
    keys = df.sparkSession.createDataFrame(hot, StructType([StructField(n, df.schema[c].dataType) for n, c in zip(names, columns, strict=True)]))
    on = [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in zip(columns, names, strict=True)]
    place = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    # the hot keys, ``2 / HOT`` rows at most
    firsts = df.withColumn("_place", place).join(F.broadcast(keys), on).groupBy(*names).agg(F.min("_place").alias("_place"))
    held = df.join(F.broadcast(firsts), on, "left")
    lost = F.col("_place").isNotNull() & ~F.col("_place").eqNullSafe(place)
    salt = F.when(lost, F.pmod(row, F.lit(SALTS)) + 1).otherwise(F.lit(0))
    held = held.withColumn("_lost", lost).withColumn("_salt", salt)
    number = F.row_number().over(Window.partitionBy(*columns, "_salt").orderBy(*order))
    return held.withColumn(flag, F.col("_lost") | (number > 1)).drop(*names, "_place", "_lost", "_salt")


def apply_rules(df: DataFrame, rules: list) -> DataFrame:
    """Adds ``failed_rules``; rows are neither lost nor multiplied."""
    columns, flags = list(df.columns), []
    row = F.xxhash64(*(F.col(f"`{c}`") for c in columns))
    for i, rule in enumerate(rules):
        flag = f"_failed_{i}"
        if isinstance(rule, Unique):
            df = _repeats(df, list(rule.columns), [F.col(c) for c in rule.order_by] + [row], row, flag)
        elif isinstance(rule, NotNull):
            df = df.withColumn(flag, _missing(df, rule))
        elif isinstance(rule, Integrity):
            keys = rule.reference.select(*(F.col(k).alias(f"_key_{i}_{n}") for n, k in enumerate(rule.keys))).distinct().withColumn(flag, F.lit(False))
            on = [F.col(c) == F.col(f"_key_{i}_{n}") for n, c in enumerate(rule.columns)]
            df = df.join(keys, on, "left").drop(*(f"_key_{i}_{n}" for n in range(len(rule.keys)))).withColumn(flag, F.coalesce(flag, F.lit(True)))
        elif isinstance(rule, Expression):
            df = df.withColumn(flag, ~F.coalesce(F.expr(rule.sql), F.lit(False)))
        else:
            raise TypeError(f"no such rule: {rule}")
        flags.append(F.when(F.col(flag), F.lit(rule.name)).otherwise(""))
    failed = F.array_remove(F.array(F.lit(""), *flags), "")  # unlike a lambda it stays inside generated code
    return df.select(*(F.col(f"`{c}`") for c in columns), failed.alias(FAILED))


def passing(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size(FAILED) == 0).drop(FAILED)


def failing(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size(FAILED) > 0)


def report(flagged: DataFrame) -> DataFrame:
    """(rule, failures) of every rule that some row fails."""
    return flagged.select(F.explode(FAILED).alias("rule")).groupBy("rule").agg(F.count("*").alias("failures"))


def counts(flagged: DataFrame, bad_columns: str | None = None) -> DataFrame:
    """total, invalid (cast failures), failed and passed rows in one aggregation."""
    invalid = F.size(bad_columns) > 0 if bad_columns else F.lit(False)
    return flagged.agg(F.count("*").alias("total"), F.count_if(invalid).alias("invalid"), F.count_if(~invalid & (F.size(FAILED) > 0)).alias("failed"), F.count_if(~invalid & (F.size(FAILED) == 0)).alias("passed_rows"))
