"""Rows out of a table of API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.validate import CORRUPT


def explode_api_payloads(responses: DataFrame, body: str, data_in: str | None, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """One row per object of the array at ``data_in`` (a dotted path, or the whole body) of each response.

    Objects are parsed permissively: one that does not fit has its text in ``_corrupt_record``. Responses without the array give no rows."""
    path = "$" + "".join(f".{p}" for p in (data_in.split(".") if data_in else []))
    items = F.from_json(F.get_json_object(body, path), "array<string>")
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = responses.select(*(keep or []), F.explode(items).alias("_item"))
    return rows.select(*(keep or []), F.from_json("_item", fields, options).alias("_row")).select(*(keep or []), "_row.*")


def next_links(responses: DataFrame, body: str, link_in: str) -> DataFrame:
    """The links to following pages, where responses have one."""
    return responses.select(F.get_json_object(body, f"$.{link_in}").alias("link")).where("link is not null")
