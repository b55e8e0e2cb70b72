import re
import datetime as dt
import io
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import privacy
from lakeops.operators.validate import CORRUPT, structural_split
from lakeops.schema import all_strings, keep_declared, persisted_view, resolve_roles, sensitive_as_string, sensitive_columns, stamp, struct_of
from lakeops.sources import api, files, jdbc, sinks, xlsx
from lakeops.spec import ColumnSpec, DatasetSpec, from_jdbc_columns
from lakeops.streaming import topics

CITY = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "country", "geonameid")])


def test_csv_header_modes_and_rows_of_the_wrong_width(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("name,country,geonameid\nTomelloso,Spain,1\nshort,Spain\nlong,Spain,2,more\n", "utf-8")
    split = structural_split(files.read_csv(spark, str(path), CITY))
    assert split.valid.collect() == [("Tomelloso", "Spain", "1")] and {r[0] for r in split.wrong.collect()} == {"short,Spain", "long,Spain,2,more"}
    assert [r[0] for r in split.valid.select("name").collect()] == ["Tomelloso"] and split.valid.count() == 1  # whatever columns are asked for
    assert files.csv_header(spark, str(path)) == ["name", "country", "geonameid"]
    assert files.read_csv(spark, str(path), CITY, files.WITHOUT_HEADER).count() == 4 and files.read_csv(spark, str(path), CITY, files.IGNORE_HEADER).count() == 3
    with pytest.raises(ValueError):
        files.read_files(spark, str(path), "fixed")


def test_broken_json_lines(spark, tmp_path):
    (tmp_path / "j.json").write_text('{"name": "a", "n": 1}\n{"name": "b", "n": \n', "utf-8")
    split = structural_split(files.read_files(spark, str(tmp_path / "j.json"), "json", T.StructType().add("name", "string").add("n", "integer")))
    assert split.valid.collect() == [("a", 1)] and split.wrong.count() == 1


def test_compressed_files_and_rejects(spark, tmp_path):
    df = spark.createDataFrame([(b"\x00\xff", "x")], "b binary, s string")
    for fmt in ("csv", "json", "parquet", "orc"):
        sinks.write_compressed(df, str(tmp_path / fmt), fmt)
    assert spark.read.csv(str(tmp_path / "csv")).first()[0] == "AP8=" and bytes(spark.read.parquet(str(tmp_path / "parquet")).first().b) == b"\x00\xff"
    path = sinks.write_rejects(spark.createDataFrame([(1, ["a", "b"])], "k int, bad array<string>"), str(tmp_path), "invalid")
    assert spark.read.csv(path, header=True).first().bad == "a|b"


def test_rejects_are_gzip_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "REJECT_ROWS", 2)
    df = spark.range(5).coalesce(1)
    for fmt, read in (("csv", lambda p: spark.read.csv(p, header=True)), ("json", spark.read.json)):
        path = sinks.write_rejects(df, str(tmp_path), fmt, fmt)
        assert len(list((tmp_path / fmt).glob(f"part-*.{fmt}.gz"))) == 3
        assert sorted(int(r.id) for r in read(path).collect()) == [0, 1, 2, 3, 4]


def workbook() -> bytes:
    out = io.BytesIO()
    head = '<?xml version="1.0"?>'
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'{head}<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"{head}<sst {ns}><si><t>name</t></si><si><r><t>Al</t></r><r><t>icante</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'{head}<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>n</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>7</v></c></row><row r="3"><c r="B3"><v>8</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_workbooks_of_any_width_and_without_addresses(spark, tmp_path):
    wide = pd.DataFrame([[f"{r}-{c}" for c in range(60)] for r in range(3)], columns=[f"c{c}" for c in range(60)])
    assert [xlsx.column_number(xlsx.column_letters(i)) for i in range(2000)] == list(range(2000))
    (tmp_path / "wide.xlsx").write_bytes(xlsx.workbook(wide))
    (tmp_path / "again.xlsx").write_bytes(xlsx.workbook(wide))
    got = xlsx.read_xlsx(spark, str(tmp_path / "*.xlsx"), "Data", "B2")
    assert got.columns == list(wide.columns) and sorted(map(tuple, got.collect())) == sorted([*wide.itertuples(index=False, name=None)] * 2)
    bare = re.sub(rb' r="[A-Z]*[0-9]+"', b"", zipfile.ZipFile(tmp_path / "wide.xlsx").read("xl/worksheets/sheet2.xml"))
    with zipfile.ZipFile(tmp_path / "wide.xlsx") as old, zipfile.ZipFile(tmp_path / "bare.xlsx", "w") as new:
        for name in old.namelist():
            new.writestr(name, bare if name.endswith("sheet2.xml") else old.read(name))
    got = xlsx.read_xlsx(spark, str(tmp_path / "bare.xlsx"), "Data", "A1")
    assert got.columns == list(wide.columns) and sorted(map(tuple, got.collect())) == [*wide.itertuples(index=False, name=None)]


def test_workbooks(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"b{i}.xlsx").write_bytes(workbook())
    got = files.read_files(spark, str(tmp_path / "*.xlsx"), "xls")
    assert got.columns == ["name", "n"] and sorted(map(tuple, got.collect()), key=str) == sorted([("Alicante", "7"), (None, "8")] * 2, key=str)
    part = xlsx.read_xlsx(spark, str(tmp_path / "b1.xlsx"), "One", "B2:B3", "without_header")
    assert part.columns == ["_c0"] and [r[0] for r in part.collect()] == ["7", "8"]
    narrow = T.StructType([T.StructField(n, T.StringType()) for n in ("name", CORRUPT)])
    assert sorted(map(tuple, xlsx.read_xlsx(spark, str(tmp_path / "b1.xlsx"), schema=narrow).collect()), key=str) == [("Alicante", "Alicante,7"), (None, ",8")]
    none = spark.createDataFrame([(None,)], "content binary")
    assert xlsx.workbook_rows(none, "content", narrow).count() == 0


def test_jdbc_texts_and_watermarks(spark):
    assert jdbc.jdbc_url("mssql", "h", 1433, "d") == "jdbc:sqlserver://h:1433;databaseName=d"
    assert jdbc.table_text("t") == "t" and jdbc.table_text("t", "s") == "s.t"
    assert jdbc.table_text(query=f"select 1 from t where a > {jdbc.WATERMARK}", watermark="2020") == "(select 1 from t where a > '2020') q"
    with pytest.raises(ValueError):
        jdbc.jdbc_url("other")
    t = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2020, 1, 2),)], "ts timestamp")
    assert jdbc.high_watermark(t.where("false"), "ts").first().watermark == dt.datetime(1900, 1, 1)
    assert jdbc.newer_than(t, t.limit(0), "ts").count() == 2 and jdbc.newer_than(t, None, "ts").count() == 2
    assert jdbc.newer_than(t, t, "ts").count() == 0 and jdbc.newer_than(t, t, "ts", inclusive=True).count() == 1
    with pytest.raises(ValueError):
        jdbc.high_watermark(spark.createDataFrame([(1,)], "ts int"), "ts")


def test_api_payloads(spark):
    bodies = [('{"d": {"value": [{"UserName": "a", "Emails": ["x"]}, {"UserName": 1, "Emails": "no"}]}, "next": "/2"}',), ('{"d": {}}',), ("broken",), (None,)]
    schema = struct_of((ColumnSpec("UserName"), ColumnSpec("Emails", "array", element="string")))
    df = spark.createDataFrame(bodies, "body string")
    got = api.explode_api_payloads(df, "body", "d.value", schema).collect()
    assert len(got) == 2 and got[0].UserName == "a" and got[0].Emails == ["x"] and got[0][CORRUPT] is None and got[1][CORRUPT]
    assert [r.link for r in api.next_links(df, "body", "next").collect()] == ["/2"]


def test_topic_batches_are_skipped_when_empty_and_avro_and_kafka_are_guarded(spark, tmp_path):
    schema = T.StructType().add("a", "integer")
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))
    seen = []
    topics.ingest(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), lambda df, n: seen.append(df.count()), str(tmp_path / "mark"))
    assert seen == []
    assert not files.has_format(spark, "no-such-format") and files.has_format(spark, "parquet")
    if not files.has_format(spark, "avro"):
        pytest.skip("Spark's Avro package is not on the class path")
    path = str(tmp_path / "avro")
    spark.createDataFrame([(1,)], schema).write.format("avro").save(path)
    assert files.read_files(spark, path, "avro").count() == 1


def test_nested_schemas_roles_and_stamps(spark):
    columns = (ColumnSpec("UserName", primary_key=True), ColumnSpec("AddressInfo", "array", element="struct"), ColumnSpec("City", "struct", parent="AddressInfo"), ColumnSpec("Name", parent="City"), ColumnSpec("n", "decimal", precision=4, scale=1), ColumnSpec("m", "array", element="array"), ColumnSpec("inner", "array", parent="m", element="long"))
    assert struct_of(columns).simpleString() == "struct<UserName:string,AddressInfo:array<struct<City:struct<Name:string>>>,n:decimal(4,1),m:array<array<bigint>>>"
    assert all_strings(columns).simpleString() == "struct<UserName:string,AddressInfo:string,n:string,m:string>"
    spec = DatasetSpec("x", (ColumnSpec("a", primary_key=True, alias="id"), ColumnSpec("t", "date", timestamp=True, ignore_persistence=True), ColumnSpec("s", sensitive=True)))
    assert resolve_roles(spec) == {"primary_key": ["id"], "timestamp": [], "sensitive": ["s"]}
    df = spark.createDataFrame([("1", "2", "3")], "a string, t string, s string")
    assert persisted_view(df, spec).columns == ["id", "s"] and keep_declared(df, ["T", "q"]).columns == ["T"]
    assert stamp(df, dt.datetime(2020, 1, 2, 3), "r", "gold").first().gold_load_day == dt.datetime(2020, 1, 2)
    hidden = T.StructType([T.StructField("a", T.ArrayType(T.StructType([T.StructField("b", T.IntegerType(), True, {"sensitive": True})]))), T.StructField("c", T.LongType())])
    assert sensitive_columns(hidden) == ["a.b"] and sensitive_as_string(hidden).simpleString() == "struct<a:array<struct<b:string>>,c:bigint>"


@pytest.mark.parametrize("bad", [
    {"columns": (ColumnSpec("a", "decimal"),)}, {"columns": (ColumnSpec("a", "map"),)}, {"columns": (ColumnSpec("a"),), "load_mode": "last_changes"},
    {"columns": (ColumnSpec("a", timestamp=True),)}, {"columns": (ColumnSpec("a", sensitive=True),)}, {"columns": (ColumnSpec("a"), ColumnSpec("b", alias="a"))},
    {"columns": (ColumnSpec("k", primary_key=True), ColumnSpec("a", sensitive=True)), "partition_by": ("a",)}, {"columns": (ColumnSpec("a"),), "load_mode": "other"},
])
def test_specs_are_checked(bad):
    with pytest.raises(ValueError):
        DatasetSpec("x", **bad)


def test_specs_from_a_database_catalog():
    got = from_jdbc_columns([("id", "BIGINT", 19, 0), ("p", "DECIMAL", 38, 6), ("x", "geometry", None, None)], keys=("id",))
    assert [(c.type, c.primary_key, c.precision) for c in got] == [("long", True, None), ("decimal", False, 38), ("string", False, None)]


def test_privacy(spark):
    df = spark.createDataFrame([("a", "bc", "secret", 1), ("ab", "c", None, 2)], "x string, y string, s string, n int")
    ids = [r[0] for r in df.select(privacy.surrogate_id(["x", "y"], "salt")).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 128 for i in ids)
    split = privacy.split_sensitive(df, ["x", "y"], ["s"], None, "salt", "data key", "master")
    assert "secret" not in str(split.main.collect()) + str(split.sensitive.collect())
    assert sorted((r.x, r.s) for r in privacy.rejoin(split, ["s"], "master").collect()) == [("a", "secret"), ("ab", None)]
    with pytest.raises(Exception):
        privacy.rejoin(split, ["s"], "wrong key").collect()
    history = spark.createDataFrame([(1, "old"), (1, "new"), (1, "new"), (2, None)], "k int, s string")
    split = privacy.split_sensitive(history, ["k"], ["s"], None, "salt", "data key", "master")
    assert sorted((r.k, r.s or "") for r in privacy.rejoin(split, ["s"], "master").collect()) == [(1, "new"), (1, "new"), (1, "old"), (2, "")]
    split = privacy.split_sensitive(history, ["k"], ["s"], None, "grain of salt", "run secret", "master secret")
    for frame in (split.main, split.sensitive, privacy.rejoin(split, ["s"], "master secret")):
        frame.collect()
        plan = frame._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("grain of salt", "run secret", "master secret"))
    assert df.select(privacy.mask("s").alias("m")).distinct().count() == 1
    same = spark.createDataFrame([("q",), ("q",)], "a string")
    assert same.select(privacy.encrypt("a", F.lit("k")).alias("e")).distinct().count() == 2


def test_jdbc_queries_use_the_shared_database_of_the_session(spark, tmp_path):
    from types import SimpleNamespace

    from lakeops.queries import scans

    spark.createDataFrame([(i, f"N{i}", i % 2) for i in range(5)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(str(tmp_path / "nation.parquet"))
    url = "jdbc:derby:memory:lakeops_shared;create=true"
    spark.conf.set("lakeops.jdbc.url", url)
    try:
        for _ in range(2):  # calls in one database don't meet
            assert scans.jdbc_roundtrip(spark, str(tmp_path)).count() == 5
        names = [r[0] for r in jdbc.read_jdbc(spark, url, query="select tablename from sys.systables where tabletype = 'T'").collect()]
        assert len(names) == 2 and all(n.startswith("NATION_") for n in names)
    finally:
        spark.conf.unset("lakeops.jdbc.url")
    assert scans.database(spark)[0].startswith("jdbc:derby:memory:")
    for master in ("local-cluster[3,2,3000]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError):
            scans.database(SimpleNamespace(conf=spark.conf, sparkContext=SimpleNamespace(master=master)))
