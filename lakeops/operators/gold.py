"""Transformation stages: functions from frame to frame that a list composes.

A join condition is SQL text; the running frame is aliased ``current`` and the other side with its stage's name, so that
conditions can be qualified. The physical join is the planner's choice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.scratch import exists

Stage = Callable[[DataFrame], DataFrame]
JOINS = ("inner", "leftouter", "rightouter", "fullouter", "leftsemi", "leftanti", "cross")


def source(spark: SparkSession, kind: str, text: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table, a path, or the result of a SQL text."""
    if kind == "table":
        return spark.table(text)
    if kind == "path":
        return spark.read.format(fmt).load(text)
    if kind == "sql":
        return spark.sql(text)
    raise ValueError(f"unknown table kind {kind}")


def table_stage(other: DataFrame, name: str, join: str | None = None, condition: str | None = None) -> Stage:
    """Joins the running frame with another; without a join type the other one replaces it."""
    if join is None:
        return lambda df: other
    if join not in JOINS:
        raise ValueError(f"unknown join type {join}")
    right = other.alias(name)
    return lambda df: df.alias("current").join(right, F.expr(condition) if condition else None, join)


def select_stage(columns: list[tuple[str, str] | str]) -> Stage:
    pairs = [(c, c) if isinstance(c, str) else c for c in columns]
    return lambda df: df.select(*(F.col(c).alias(a) for c, a in pairs))


def column_stage(name: str, expression: str) -> Stage:
    return lambda df: df.withColumn(name, F.expr(expression))


def filter_stage(condition: str) -> Stage:
    return lambda df: df.where(F.expr(condition))


def fill_stage(value, columns: list[str] | None = None) -> Stage:
    """Nulls of the columns that have the value's type."""
    return lambda df: df.na.fill(value, subset=columns)


def aggregate(kind: str, column: str, order: str | None = None) -> Column:
    """``first`` and ``last`` are by an order column, so that they mean something."""
    c = F.col(column)
    if kind in ("first", "last"):
        if order is None:
            raise ValueError(f"{kind} needs an order column")
        return F.min_by(c, order) if kind == "first" else F.max_by(c, order)
    known = {"sum": F.sum, "sumDistinct": F.sum_distinct, "count": F.count, "countDistinct": F.count_distinct, "min": F.min, "max": F.max, "avg": F.avg, "mean": F.avg, "stddev_samp": F.stddev_samp, "stddev_pop": F.stddev_pop}
    if kind not in known:
        raise ValueError(f"unknown aggregate {kind}")
    return known[kind](c)


def agg_stage(group_by: list[str], aggregates: list[tuple]) -> Stage:
    """``aggregates``: (name, kind, column[, order column]); no group columns give one row."""
    return lambda df: df.groupBy(*group_by).agg(*(aggregate(*rest).alias(name) for name, *rest in aggregates))


def lambda_stage(hot: DataFrame, hot_filter: str, cold_filter: str) -> Stage:
    """The cold rows of the running frame and the hot rows of another, columns by name, missing ones null."""
    return lambda cold: cold.where(F.expr(cold_filter)).unionByName(hot.where(F.expr(hot_filter)), allowMissingColumns=True)


def stage(step: Stage, drop: list[str] | None = None, distinct: bool = False, view: str | None = None, cache: list[DataFrame] | None = None) -> Stage:
    """A stage with its modifiers; a cached frame is put into ``cache`` for its owner to release."""

    def run(df: DataFrame) -> DataFrame:
        out = step(df)
        out = out.drop(*drop) if drop else out
        out = out.distinct() if distinct else out
        if view:
            out.createOrReplaceTempView(view)
        if cache is not None:
            cache.append(out := out.persist(StorageLevel.MEMORY_AND_DISK))
        return out

    return run


def run_stages(df: DataFrame | None, stages: list[Stage]) -> DataFrame:
    return reduce(lambda frame, step: step(frame), stages, df)


@contextmanager
def scope(spark: SparkSession, views: tuple[str, ...] = ()) -> Iterator[list[DataFrame]]:
    """Caches and views that end with the run."""
    cached: list[DataFrame] = []
    try:
        yield cached
    finally:
        for df in cached:
            df.unpersist()
        for view in views:
            spark.catalog.dropTempView(view)


def with_params(stages: list[Stage], params: dict[str, object]) -> list[Stage]:
    """Makes run parameters literal columns before every stage, unless a column has the name, and drops them at the end."""

    def add(df: DataFrame | None) -> DataFrame | None:
        return df if df is None else df.withColumns({p: F.lit(v) for p, v in params.items() if p not in df.columns})

    return [(lambda df, s=s: s(add(df))) for s in stages] + [lambda df: df.drop(*params)]


def _stored_schema(spark: SparkSession, path: str | None, name: str | None) -> StructType | None:
    """The columns of a table, none if it does not exist or has no files yet."""
    if name:
        return spark.table(name).schema if spark.catalog.tableExists(name) else None
    if not exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as empty:
        if empty.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def write_table(df: DataFrame, mode: str, path: str | None = None, name: str | None = None, partition_by: str = "", merge_schema: bool = False) -> None:
    """append, overwrite, truncate (the table stays registered, its rows go) or view; ``partition_by`` as "a/b".

    An append with columns that the table lacks is an error, unless ``merge_schema``; a registered table then gets them, and readers of a path merge the files' schemas."""
    if mode == "view":
        return df.createOrReplaceTempView(name)
    if mode not in ("append", "overwrite", "truncate"):
        raise ValueError(f"unknown write mode {mode}")
    spark = df.sparkSession
    if mode == "append":
        there = _stored_schema(spark, path, name)
        new = [f for f in df.schema.fields if there is not None and f.name not in there.names]
        if new and not merge_schema:
            raise ValueError(f"columns that the table lacks: {', '.join(f.name for f in new)}")
        if new and name:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        if name and there is not None:
            order = spark.table(name).columns
            df = df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(there[c].dataType).alias(c) for c in order))
    writer = df.write.format("parquet").mode("append" if mode == "append" else "overwrite")
    writer = writer.partitionBy(*partition_by.split("/")) if partition_by else writer
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.saveAsTable(name, **({"path": path} if path else {})) if name else writer.save(path)
