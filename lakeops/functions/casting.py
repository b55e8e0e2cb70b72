"""Typed casts of text columns that keep good and bad rows apart, in one pass.

Everything goes through ``try_`` functions: a value that can't be cast is null and its column is listed in ``bad_columns``; ANSI mode stays as it is.

Structs and arrays come as JSON text. Each level is parsed with text leaves, and every leaf is then cast like a column of its own (patterns and
transforms included), so that nothing is lost in the parser: what fails is listed by its path, ``st.a`` for a field, ``st[]`` for elements, ``st[].b`` for a
field of elements. A container that is no JSON, or JSON of another shape, fails by its own path. Absent fields and JSON nulls are null and don't fail;
a container inside a JSON string is read like one outside.
"""

from __future__ import annotations

from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.catalog import CATALOG, function
from lakeops.schema import SIMPLE, type_of
from lakeops.spec import ARRAY, DATE, DATETIME, DECIMAL, INTEGER, LONG, SHORT, STRING, STRUCT, ColumnSpec

DATE_PATTERN = "dd-MM-yyyy"
DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
BAD = "bad_columns"


class Split(NamedTuple):
    """One flagged frame and two filters of it; persist ``flagged`` where both are used."""

    flagged: DataFrame
    valid: DataFrame
    invalid: DataFrame


def normalize(text: Column, transform: str | None) -> Column:
    """Decimal comma and thousands separators to plain numbers."""
    if transform == "comma":
        return F.translate(F.translate(text, ".", ""), ",", ".")
    if transform == "comma-eng":
        return F.translate(text, ",", "")
    return text


def _modern(text: Column, pattern: str, kind: str) -> Column:
    """Years before 1900 of moments, and the year 0001 of dates, become 1900, at the place of the year in the pattern only."""
    at = pattern.find("yyyy")
    if at < 0:
        return text
    year = F.substring(text, at + 1, 4)
    old = year == "0001" if kind == DATE else (year < "1900") & year.rlike("^[0-9]{4}$")
    return F.when(old, F.overlay(text, F.lit("1900"), at + 1, 4)).otherwise(text)


def nested(text: Column, column: ColumnSpec, columns: tuple[ColumnSpec, ...]) -> tuple[Column, Column]:
    """The value of a struct or array in JSON text, and the paths of what can't be cast."""
    text = F.trim(text)
    # parsers stop after the first value; inside brackets and braces what follows it shows
    whole = F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False)) & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return _nested(text, column, column.type, columns, column.name, whole)


def _nested(text: Column, column: ColumnSpec, kind: str, columns: tuple[ColumnSpec, ...], path: str, readable: Column) -> tuple[Column, Column]:
    none = F.array().cast("array<string>")
    inner = [c for c in columns if c.parent == column.name]
    if kind == STRUCT:
        parsed = F.from_json(text, T.StructType([T.StructField(c.name, T.StringType()) for c in inner]))
        ok = readable & text.startswith("{") & parsed.isNotNull()
        fields = [_value(parsed[c.name], c, c.type, columns, f"{path}.{c.name}") for c in inner]
        value = F.struct(*(v.alias(c.name) for c, (v, _) in zip(inner, fields, strict=True)))
        failed = F.concat(none, *(f for _, f in fields))
    else:
        parsed = F.from_json(text, T.ArrayType(T.StringType()))
        ok = readable & text.startswith("[") & parsed.isNotNull()
        # an array of arrays names its inner array as the only child
        of, element = (inner[0], ARRAY) if column.element == ARRAY else (column, column.element or STRING)
        value = F.transform(parsed, lambda x: _value(x, of, element, columns, f"{path}[]")[0])
        failed = F.array_distinct(F.flatten(F.transform(parsed, lambda x: _value(x, of, element, columns, f"{path}[]")[1])))
    return F.when(ok, value), F.when(text.isNull(), none).when(ok, failed).otherwise(F.array(F.lit(path)))


def _value(text: Column, column: ColumnSpec, kind: str, columns: tuple[ColumnSpec, ...], path: str) -> tuple[Column, Column]:
    """A field or element: its value and the paths that fail."""
    if kind in (ARRAY, STRUCT):
        return _nested(F.trim(text), column, kind, columns, path, F.lit(True))
    value = cast_column(replace(column, type=kind), columns, text)
    failed = text.isNotNull() & value.isNull() if kind != STRING else F.lit(False)
    return value, F.when(failed, F.array(F.lit(path))).otherwise(F.array().cast("array<string>"))


def cast_column(column: ColumnSpec, columns: tuple[ColumnSpec, ...] = (), text: Column | None = None) -> Column:
    """The typed value of a text column, null where it can't be cast."""
    text = F.trim(F.col(f"`{column.name}`") if text is None else text)
    if column.transform in CATALOG:
        text = function(column.transform)(text)
    text = normalize(text, column.transform)
    if column.type == STRING:
        return text
    if column.type in (DATE, DATETIME):
        pattern = column.pattern or (DATE_PATTERN if column.type == DATE else DATETIME_PATTERN)
        if column.lenient:
            text = F.substring(text, 1, len(pattern.replace("'", "")))
        text = _modern(text, pattern, column.type)
        moment = F.try_to_timestamp(text, F.lit(pattern))
        return moment.cast("date") if column.type == DATE else moment
    if column.type in (ARRAY, STRUCT):
        return nested(text, column, columns)[0]
    kind = type_of(column) if column.type == DECIMAL else SIMPLE[column.type]
    if column.type in (DECIMAL, INTEGER, LONG, SHORT):
        # a failed cast costs an exception; no number is empty or begins with a letter, so placeholders (N/A, null) need none
        return F.when((text > "") & (text < ":") | (text >= "\x7f"), text.try_cast(kind))
    return text.try_cast(kind)


def cast_split(df: DataFrame, columns: tuple[ColumnSpec, ...], typed: bool = False, text: str | None = None) -> Split:
    """Casts all declared columns in one select. Other columns stay. ``typed``: the source's columns are typed already, nothing is cast.
    ``text``: a column of this name holds the source's declared columns of the rows that fail."""
    if typed:
        flagged = df.withColumn(BAD, F.array().cast("array<string>"))
        flagged = flagged.withColumn(text, F.lit(None).cast("string")) if text else flagged
        return Split(flagged, df, flagged.where(F.lit(False)))
    top = [c for c in columns if c.parent is None]
    names = {c.name for c in top}
    raw = [F.col(f"`{n}`") for n in df.columns if n not in names]
    values, marks, simple, deep = [], [], [], []
    for i, c in enumerate(top):
        value, mark = F.col(f"`{c.name}`"), f"_mark_{i}"
        there = value.isNotNull()
        if c.type in (ARRAY, STRUCT):
            value, failed = nested(value, c, columns)
            marks.append(failed.alias(mark))
            deep.append(F.col(mark))
        else:
            value = cast_column(c, columns)
            if c.type != STRING:
                marks.append(there.alias(mark))
                simple.append(F.when(F.col(mark) & F.col(f"`{c.name}`").isNull(), F.lit(c.name)).otherwise(""))
        values.append(value.alias(c.name))
    if text:
        marks.append(F.struct(*(F.col(f"`{c.name}`") for c in top)).alias(text))
    # the rows come out of a generator: flags and filters on them would go below a select and cast everything again
    cast = df.select(F.inline(F.array(F.struct(*values, *raw, *marks))))
    # array_remove, unlike a lambda, stays inside generated code
    bad = F.array_remove(F.array(F.lit(""), *simple), "")
    bad = (F.concat(bad, *deep) if deep else bad).alias(BAD)
    flagged = cast.select(*(F.col(f"`{c.name}`") for c in top), *raw, bad, *([F.col(text)] if text else []))
    # JSON is made of the rows that fail only
    flagged = flagged.withColumn(text, F.when(F.size(BAD) > 0, F.to_json(text))) if text else flagged
    return Split(flagged, flagged.where(F.size(BAD) == 0).drop(BAD), flagged.where(F.size(BAD) > 0))
