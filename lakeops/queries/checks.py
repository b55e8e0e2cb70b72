"""Workbooks, structural checks by format, partition strategies, roles, cached stages, empty batches."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import gold, partitions, silver, validate
from lakeops.queries.scans import ORDER_FIELDS, ORDER_LINES, order_lines
from lakeops.registry import query, table
from lakeops.schema import persisted_view, resolve_roles
from lakeops.scratch import scratch
from lakeops.sources import files, xlsx
from lakeops.spec import DATETIME, DOUBLE, LONG, ColumnSpec, DatasetSpec
from lakeops.streaming import topics

@query("select c_custkey::varchar as c_custkey, c_name, c_mktsegment from customer")
def excel_sheet_range(spark, sf_dir):
    """Customers as workbooks of 5,000 keys each; the sheet and the corner of its range are named."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"content": [xlsx.workbook(rows)]})

    books = c.groupBy(F.floor(F.col("c_custkey") / 5000)).applyInPandas(pack, "content binary")
    names = T.StructType([T.StructField(n, T.StringType()) for n in c.columns])
    return xlsx.workbook_rows(books, "content", names, "Data", "B2")


@query(f"""
select 'csv' as kind, split_part(line, ',', 1)::bigint as o_orderkey from ({ORDER_LINES}) where not wrong
union all select 'parquet', o_orderkey from orders
union all select 'orc', o_orderkey from orders where o_orderstatus = 'none'
""")
def validator_dispatch(spark, sf_dir):
    """Orders in three formats through the check of their format: a file of other types than declared has no valid rows."""
    out, o = None, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    declared = {"parquet": o.schema, "orc": T.StructType([T.StructField("o_orderkey", T.StringType()), o.schema["o_orderstatus"]])}
    for kind in ("csv", "parquet", "orc"):
        path, check = scratch(spark, kind), validate.for_format(kind)
        if kind == "csv":
            order_lines(spark, sf_dir).write.text(path)
            valid = check(files.read_csv(spark, path, ORDER_FIELDS, files.WITHOUT_HEADER)).valid
        else:
            o.write.format(kind).save(path)
            read = files.read_files(spark, path, kind)
            valid = read if check(read.schema, declared[kind]) else read.where(F.lit(False))
        part = valid.select(F.lit(kind).alias("kind"), F.col("o_orderkey").cast("long").alias("o_orderkey"))
        out = part if out is None else out.unionByName(part)
    return out


@query("""
with t(name, good) as (values ('header', true), ('header in another order', false), ('columns', true), ('columns exactly', false))
select name as "check", good as passed, case when good then (select count(*) from orders) else 0 end as rows_passed from t
""")
def header_and_column_checks(spark, sf_dir):
    """The header of stored lines and the columns of a table against what is declared; a check that fails lets no row pass."""
    o, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), scratch(spark, "headed")
    o.write.option("header", True).csv(path)
    header, got = files.csv_header(spark, path), files.read_csv(spark, path, ORDER_FIELDS)
    checks = {
        "header": validate.header_matches(header, [n.upper() for n in ORDER_FIELDS.names]),
        "header in another order": validate.header_matches(header, ORDER_FIELDS.names[::-1]),
        "columns": validate.columns_present(o, ["O_ORDERKEY", "o_custkey"]),
        "columns exactly": validate.columns_present(o, ["o_orderkey", "o_custkey"], exactly=True),
    }
    rows = validate.structural_split(got).valid.agg(F.count("o_orderkey").alias("n"))  # one row
    verdicts = F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.lit(v).alias("passed")) for n, v in checks.items())))
    return rows.select("n", verdicts.alias("v")).select("v.check", "v.passed", F.when(F.col("v.passed"), F.col("n")).otherwise(0).alias("rows_passed"))


@query("""
select 'file name' as strategy, o_orderkey, strftime(o_orderdate, '%Y/%m/%d') as place from orders
union all select 'date', o_orderkey, strftime(o_orderdate, '%Y/%-m') from orders
union all select 'load time', o_orderkey, '2024/3/5/6' from orders
""")
def partition_strategies(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    name, out = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_orders.csv")), None
    for strategy, how in (("file name", {"file_name": name, "pattern": "<yyyy><mm><dd>_orders.csv"}), ("date", {"date_column": "o_orderdate", "parts": ("yyyy", "mm")}), ("load time", {"loaded": datetime(2024, 3, 5, 6, 7, 8)})):
        added, names = partitions.add(o, **how)
        part = added.select(F.lit(strategy).alias("strategy"), "o_orderkey", F.concat_ws("/", *names).alias("place"))
        out = part if out is None else out.unionByName(part)
    return out


EVENTS = DatasetSpec(
    "events",
    (ColumnSpec("user_id", LONG, alias="user", primary_key=True), ColumnSpec("event_type", alias="kind", primary_key=True), ColumnSpec("ts", DATETIME, alias="happened", timestamp=True), ColumnSpec("event_id", LONG), ColumnSpec("value", DOUBLE, ignore_persistence=True)),
    load_mode="last_changes",
)


@query("""
select "user", kind, event_id, 'user,kind' as keys, 'happened' as "time"
from (select user_id as "user", event_type as kind, event_id, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from events) where n = 1
""")
def roles_by_alias(spark, sf_dir):
    """The latest row of each key, with key and time found by their roles under the stored names."""
    stored, roles = persisted_view(table(spark, sf_dir, "events"), EVENTS), resolve_roles(EVENTS)
    latest = silver.latest_per_key(stored, roles["primary_key"], roles["timestamp"][0], ["event_id"])
    return latest.select("user", "kind", "event_id", F.lit(",".join(roles["primary_key"])).alias("keys"), F.lit(roles["timestamp"][0]).alias("time"))


@query("""
with t as (select o_custkey, count(*) as n from orders group by o_custkey)
select 'busy' as side, o_custkey, n from t where n > 10 union all select 'calm', o_custkey, n from t where n <= 10
""")
def gold_cached_stage(spark, sf_dir):
    """A cached aggregate feeds two tables; the cache ends with the run."""
    path = scratch(spark, "sides")
    with gold.scope(spark) as cached:
        totals = gold.run_stages(table(spark, sf_dir, "orders"), [gold.stage(gold.agg_stage(["o_custkey"], [("n", "count", "o_orderkey")]), cache=cached)])
        for side, condition in (("busy", "n > 10"), ("calm", "n <= 10")):
            gold.write_table(gold.run_stages(totals, [gold.filter_stage(condition)]).withColumn("side", F.lit(side)), "append", path)
    assert not totals.is_cached
    return spark.read.parquet(path)


@query("select event_id, user_id, event_type, 1::bigint as loads from events")
def stream_empty_batch(spark, sf_dir):
    """Two runs of one checkpoint: what arrives in between has no rows, so its batch loads nothing."""
    landing, path, mark = scratch(spark, "landing"), scratch(spark, "loads"), scratch(spark, "mark")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")

    def load(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{path}/load={number}")

    for part in (e, e.where(F.lit(False))):
        part.write.mode("append").parquet(landing)
        topics.ingest(spark.readStream.schema(e.schema).parquet(landing), load, mark)
    got = spark.read.parquet(path)
    loads = got.agg(F.count_distinct("load").alias("loads"))  # one row
    return got.select("event_id", "user_id", "event_type").crossJoin(loads)
