import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from lakeops.functions.casting import BAD, cast_split
from lakeops.functions.catalog import CATALOG, function, register
from lakeops.spec import ColumnSpec


def typed(spark, values, columns):
    return cast_split(spark.createDataFrame([tuple(values)], ", ".join(f"{c.name} string" for c in columns)), tuple(columns))


def test_valid_row_of_every_type(spark):
    columns = [ColumnSpec("s"), ColumnSpec("i", "integer"), ColumnSpec("f", "float"), ColumnSpec("d", "double"), ColumnSpec("b", "boolean"), ColumnSpec("day", "date", lenient=True), ColumnSpec("l", "long"), ColumnSpec("t", "datetime", pattern="dd-MM-yyyy HH:mm:ss"), ColumnSpec("n", "decimal", precision=5, scale=1), ColumnSpec("a", "array", element="integer")]
    split = typed(spark, [" A ", "1", "1.1", "1.12345", "true", "01-01-2020 23:59:59", "2", "01-01-2020 23:59:59", "7.25", "[1,2]"], columns)
    row = split.valid.first()
    assert (row.s, row.i, round(row.f, 3), row.d, row.b, row.day, row.l, row.t) == ("A", 1, 1.1, 1.12345, True, dt.date(2020, 1, 1), 2, dt.datetime(2020, 1, 1, 23, 59, 59))
    assert str(row.n) in ("7.2", "7.3") and row.a == [1, 2] and split.invalid.count() == 0


def test_bad_values_are_named_and_null(spark):
    columns = [ColumnSpec("a", "long"), ColumnSpec("b", "date"), ColumnSpec("c", "long")]
    split = typed(spark, ["NoNumber", "20-21-2019", None], columns)
    row = split.invalid.first()
    assert row[BAD] == ["a", "b"] and row.a is None and split.valid.count() == 0


def test_english_thousands_and_decimal_commas(spark):
    columns = [ColumnSpec(n, k, transform="comma-eng") for n, k in (("a", "integer"), ("b", "float"), ("c", "double"), ("d", "long"))]
    row = typed(spark, ["1,450", "1,234.12", "1,234,567.89", "12,123,45,124"], columns).valid.first()
    assert (row.a, round(row.b, 2), row.c, row.d) == (1450, 1234.12, 1234567.89, 1212345124)
    assert typed(spark, ["1.234,56"], [ColumnSpec("a", "double", transform="comma")]).valid.first().a == 1234.56


def test_old_years_and_microseconds(spark):
    columns = [ColumnSpec("a", "date"), ColumnSpec("b", "datetime"), ColumnSpec("c", "datetime", pattern="yyyy-MM-dd HH:mm:ss.SSSSSS"), ColumnSpec("d", "date", pattern="yyyyMMdd")]
    row = typed(spark, ["01-02-0001", "0999-03-04 01:02:03", "2020-01-01 00:00:00.123457", "20000001"], columns).flagged.first()
    assert (row.a, row.b, row.c) == (dt.date(1900, 2, 1), dt.datetime(1900, 3, 4, 1, 2, 3), dt.datetime(2020, 1, 1, 0, 0, 0, 123457)) and row.d is None


def test_function_catalog(spark):
    assert typed(spark, [None], [ColumnSpec("a", transform="mask-asterisk")]).valid.first().a == "*" * 16
    with pytest.raises(KeyError):
        function("unknown")
    register("twice", lambda c: c)
    assert "twice" in CATALOG


def test_typed_sources_are_left_alone(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    split = cast_split(df, (ColumnSpec("a", "string"),), typed=True)
    assert split.valid.collect() == df.collect() and split.invalid.count() == 0


NESTED = [
    ColumnSpec("id", "long"), ColumnSpec("st", "struct"), ColumnSpec("a", "integer", parent="st"), ColumnSpec("b", parent="st"), ColumnSpec("at", "date", pattern="yyyy-MM-dd", parent="st"),
    ColumnSpec("deep", "array", element="struct", parent="st"), ColumnSpec("x", "double", transform="comma", parent="deep"), ColumnSpec("list", "array", element="integer"),
    ColumnSpec("grid", "array", element="array"), ColumnSpec("line", "array", element="long", parent="grid"),
]


@pytest.mark.parametrize(
    "st,numbers,grid,bad",
    [
        ('{"a": 1, "b": "y", "at": "2020-02-01", "deep": [{"x": "1.234,5"}, {}]}', "[1, 2]", "[[1], [], null, [2, 3]]", []),
        (None, None, None, []),
        ("{}", "[]", "[]", []),
        ('{"a": null, "b": null, "deep": null}', "[null]", "[null]", []),
        ('{"a": "bad", "b": "y"}', None, None, ["st.a"]),
        (None, '[1, "q"]', None, ["list[]"]),
        ('{"a": 1', "[1", "1]", ["st", "list", "grid"]),
        ('[{"a": 1}]', '{"a": 1}', "[[1], 2]", ["st", "list", "grid[]"]),
        ('{"a": 1.5, "at": "2020-02-31", "deep": [{"x": "q"}, {"x": "r"}, 7]}', "[3000000000]", '[["x"], [1.5]]', ["st.a", "st.at", "st.deep[].x", "st.deep[]", "list[]", "grid[][]"]),
        ('{"a": {"q": 1}, "deep": {"x": 1}}', "7", '"[[1]]"', ["st.a", "st.deep", "list", "grid"]),
        ('{"a": 1} trailing', "[1], [2]", "", ["st", "list", "grid"]),
        ('{"a": 1}}', "[1]]", "[[1]]}", ["st", "list", "grid"]),
        ('{"a": 1}]', '[1], "w": 2', "[[1]],", ["st", "list", "grid"]),
        (' {"b": " padded \\" quote", "deep": [{"x": 5}]} ', " [ 1 ] ", " [[1]] ", []),
    ],
)
def test_nested_values_fail_by_path(spark, st, numbers, grid, bad):
    df = spark.createDataFrame([("1", st, numbers, grid)], "id string, st string, list string, grid string")
    split = cast_split(df, tuple(NESTED))
    row = split.flagged.first()
    assert row[BAD] == bad
    assert (split.valid.count(), split.invalid.count()) == ((0, 1) if bad else (1, 0))
    assert dict(split.valid.dtypes)["st"] == "struct<a:int,b:string,at:date,deep:array<struct<x:double>>>" and dict(split.valid.dtypes)["grid"] == "array<array<bigint>>"


def test_nested_values(spark):
    df = spark.createDataFrame([("1", '{"a": 1, "b": " y ", "at": "2020-02-01", "deep": [{"x": "1.234,5"}, {}, null]}', '[1, null, "3"]', "[[1], [], null]")], "id string, st string, list string, grid string")
    row = cast_split(df, tuple(NESTED)).valid.first()
    assert row.st.asDict(True) == {"a": 1, "b": "y", "at": dt.date(2020, 2, 1), "deep": [{"x": 1234.5}, {"x": None}, None]}
    assert (row.list, row.grid) == ([1, None, 3], [[1], [], None])


def test_casts_are_evaluated_once(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = cast_split(df, (ColumnSpec("a", "decimal", precision=7, scale=3),)).valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("as decimal(7,3)") == 1, plan


def test_placeholders_are_not_cast_and_only_failed_rows_become_json(spark):
    texts = ["7", " +7 ", "-7", "\t7", "\x7f7", "N/A", "null", "", " ", "7a", "1.5", "-", "\u00a07", None]
    columns = (ColumnSpec("a", "long"), ColumnSpec("p", "decimal", precision=7, scale=3))
    df = spark.createDataFrame([(t, t) for t in texts], "a string, p string")
    split = cast_split(df, columns, text="_text")
    plain = df.select(F.trim("a").try_cast("long").alias("a"), F.trim("p").try_cast("decimal(7,3)").alias("p"), F.struct("a", "p").alias("t"))
    want = [(r.a, r.p, [c for c in ("a", "p") if r.t[c] is not None and r[c] is None], r.t) for r in plain.collect()]
    got = split.flagged.collect()
    assert [(r.a, r.p, r[BAD]) for r in got] == [w[:3] for w in want]
    assert [r["_text"] and json.loads(r["_text"]) for r in got] == [w[3].asDict() if w[2] else None for w in want]
    plan = split.flagged._jdf.queryExecution().executedPlan().toString()
    made = [line for line in plan.split("\n") if "StructsToJson" in line]
    assert made and all(re.search(r"CASE WHEN \(size\([^)]*\) > 0\) THEN [^ ]*StructsToJson", line.replace("invoke(", "")) for line in made), plan
    assert plan.count("try_cast(trim(") == 2 and " < :)" in plan, plan
