"""Schemas from flat column lists, column roles, and the columns that are added to stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.spec import ARRAY, BINARY, BOOLEAN, DATE, DATETIME, DECIMAL, DOUBLE, FLOAT, INTEGER, LONG, SHORT, STRING, STRUCT, ColumnSpec, DatasetSpec

SIMPLE = {INTEGER: T.IntegerType(), SHORT: T.ShortType(), LONG: T.LongType(), FLOAT: T.FloatType(), DOUBLE: T.DoubleType(), STRING: T.StringType(), BOOLEAN: T.BooleanType(), DATE: T.DateType(), DATETIME: T.TimestampType(), BINARY: T.BinaryType()}


def type_of(column: ColumnSpec, columns: tuple[ColumnSpec, ...] = (), kind: str | None = None) -> T.DataType:
    kind = kind or column.type
    if kind in SIMPLE:
        return SIMPLE[kind]
    if kind == DECIMAL:
        return T.DecimalType(column.precision, column.scale)
    inner = [c for c in columns if c.parent == column.name]
    if kind == STRUCT:
        return T.StructType([T.StructField(c.name, type_of(c, columns)) for c in inner])
    if kind == ARRAY:
        if column.element == ARRAY:  # an array of arrays names its inner array as the only child
            return T.ArrayType(type_of(inner[0], columns))
        return T.ArrayType(type_of(column, columns, column.element or STRING))
    raise ValueError(f"{column.name}: no Spark type for {kind}")


def struct_of(columns: tuple[ColumnSpec, ...]) -> T.StructType:
    """The nested schema of a flat list; everything is nullable."""
    return T.StructType([T.StructField(c.name, type_of(c, columns)) for c in columns if c.parent is None])


def all_strings(columns: tuple[ColumnSpec, ...]) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.StringType()) for c in columns if c.parent is None])


def keep_declared(df: DataFrame, names: list[str]) -> DataFrame:
    """Drops what is not declared; order as declared, names without regard to case."""
    there = {c.lower(): c for c in df.columns}
    return df.select(*(F.col(f"`{there[n.lower()]}`").alias(n) for n in names if n.lower() in there))


def persisted_view(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The declared columns that are stored, under their aliases."""
    return df.select(*(F.col(f"`{c.name}`").alias(c.stored_name) for c in spec.columns if c.parent is None and not c.ignore_persistence))


def resolve_roles(spec: DatasetSpec) -> dict[str, list[str]]:
    """Stored names of primary key, timestamp and sensitive columns."""
    return {flag: [c.stored_name for c in spec.role(flag) if not c.ignore_persistence] for flag in ("primary_key", "timestamp", "sensitive")}


def stamp(df: DataFrame, when: datetime, run_id: str, prefix: str = "datalake") -> DataFrame:
    """Adds load date, day and run id; clock and id are arguments, so a rerun gives equal rows."""
    date = F.lit(when.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return df.withColumns({f"{prefix}_load_date": date, f"{prefix}_load_day": F.date_trunc("day", date), f"{prefix}_ingestion_uuid": F.lit(run_id)})


def sensitive_columns(schema: T.StructType, within: str = "") -> list[str]:
    """Paths of fields whose metadata has ``sensitive``, also inside structs and arrays of structs."""
    out = []
    for f in schema.fields:
        path, kind = f"{within}{f.name}", f.dataType
        if f.metadata.get("sensitive"):
            out.append(path)
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            out += sensitive_columns(kind, f"{path}.")
    return out


def sensitive_as_string(schema: T.DataType, hidden: bool = False) -> T.DataType:
    """The schema with every sensitive leaf as string."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, sensitive_as_string(f.dataType, hidden or bool(f.metadata.get("sensitive"))), True, f.metadata) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(sensitive_as_string(schema.elementType, hidden), True)
    return T.StringType() if hidden else schema
