"""File readers. Text formats are read as strings with a column for rows that do not fit; typing is a later step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeops.operators.validate import CORRUPT

FIRST_LINE, WITHOUT_HEADER, IGNORE_HEADER = "first_line", "without_header", "ignore_header"
TYPED = ("parquet", "orc", "avro")


def read_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """The reader of a format. fixed and text are formats without a reader."""
    if fmt == "csv":
        return read_csv(spark, path, schema, **options)
    if fmt == "json":
        return read_json(spark, path, schema, **options)
    if fmt == "xls":
        from lakeops.sources.xlsx import read_xlsx

        return read_xlsx(spark, path, **options)
    if fmt in TYPED:
        reader = spark.read.options(**options)
        return (reader.schema(schema) if schema else reader).format(fmt).load(path)
    raise ValueError(f"no reader for format {fmt}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header_mode: str = FIRST_LINE, sep: str = ",", charset: str = "UTF-8", escape: str = "\\", quote: str = '"', multiline: bool = False, null_value: str = "", line_sep: str | None = None) -> DataFrame:
    """All strings; a row with more or fewer fields has its text in ``_corrupt_record``. US-ASCII is read as UTF-8, which contains it."""
    fields = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields if f.name != CORRUPT] + [T.StructField(CORRUPT, T.StringType())])
    options = {"header": header_mode != WITHOUT_HEADER, "enforceSchema": True, "sep": sep, "encoding": "UTF-8" if charset == "US-ASCII" else charset, "escape": escape, "quote": quote, "multiLine": multiline, "nullValue": null_value, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if line_sep:
        options["lineSep"] = line_sep
    return spark.read.options(**options).schema(fields).csv(path)


def csv_header(spark: SparkSession, path: str, sep: str = ",", charset: str = "UTF-8") -> list[str]:
    """The names in the first line; nothing else is read."""
    return spark.read.options(header=True, sep=sep, encoding=charset, inferSchema=False).csv(path).columns


def read_json(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False, charset: str = "UTF-8") -> DataFrame:
    fields = schema if CORRUPT in schema.names else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"multiLine": multiline, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} | ({"encoding": charset} if multiline or charset != "UTF-8" else {})
    return spark.read.options(**options).schema(fields).json(path)


def has_format(spark: SparkSession, name: str) -> bool:
    """Whether a data source is on the class path (avro, kafka and delta come in jars of their own)."""
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(name, spark._jsparkSession.sessionState().conf())
        return True
    except Exception:
        return False
