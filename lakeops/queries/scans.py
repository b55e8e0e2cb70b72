"""Sources, sinks, projections of files."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.casting import cast_split
from lakeops.operators import partitions, silver, validate, versions
from lakeops.plans import sqlsync
from lakeops.registry import query, table
from lakeops.schema import keep_declared, persisted_view, sensitive_as_string, sensitive_columns, stamp
from lakeops.scratch import leaf_files, rename, scratch
from lakeops.sources import api, files, jdbc, sinks
from lakeops.spec import DOUBLE, LONG, ColumnSpec, DatasetSpec
from lakeops.streaming import topics

EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("k", T.LongType())])


def database(spark) -> tuple[str, str]:
    """The JDBC URL in ``lakeops.jdbc.url``, a database that all executors reach, and an end for the call's table names, so that none of its tables is overwritten.
    Without the setting, under a local master, an embedded database; other masters' executors share none."""
    url, own = spark.conf.get("lakeops.jdbc.url", None), uuid.uuid4().hex[:12]
    if url:
        return url, f"_{own}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"lakeops.jdbc.url is not set, and the executors of {master} share no database in memory")
    return f"jdbc:derby:memory:lakeops{own};create=true", f"_{own}"


@query("select * from orders")
def scan_parquet(spark, sf_dir):
    return files.read_files(spark, f"{sf_dir}/orders.parquet", "parquet")


def order_lines(spark, sf_dir) -> DataFrame:
    """Orders as CSV lines; every 50th has a field too many, every 70th lacks two."""
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.select(F.when(F.col("o_orderkey") % 50 == 0, F.concat(line, F.lit(",extra"))).when(F.col("o_orderkey") % 70 == 0, F.concat_ws(",", "o_orderkey", "o_custkey")).otherwise(line).alias("value"))


ORDER_LINES = """
select case when o_orderkey % 50 = 0 then concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'extra')
  when o_orderkey % 70 = 0 then concat_ws(',', o_orderkey, o_custkey) else concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) end as line,
  o_orderkey % 50 = 0 or o_orderkey % 70 = 0 as wrong
from orders
"""
ORDER_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")])


def read_order_lines(spark, sf_dir) -> DataFrame:
    path = scratch(spark, "csv")
    order_lines(spark, sf_dir).write.text(path)
    return files.read_csv(spark, path, ORDER_FIELDS, header_mode=files.WITHOUT_HEADER)


@query(ORDER_LINES)
def csv_roundtrip_permissive(spark, sf_dir):
    got = read_order_lines(spark, sf_dir)
    line = F.coalesce(validate.CORRUPT, F.concat_ws(",", *ORDER_FIELDS.names))
    return got.select(line.alias("line"), F.col(validate.CORRUPT).isNotNull().alias("wrong"))


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def orc_roundtrip(spark, sf_dir):
    path = scratch(spark, "orc")
    table(spark, sf_dir, "orders").write.orc(path)
    return files.read_files(spark, path, "orc")


@query("select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def compressed_roundtrip(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch(spark, "json")
    sinks.write_compressed(o, path, "json")
    return files.read_json(spark, path, o.schema).drop(validate.CORRUPT)


@query("select event_id, event_type, (props->>'$.k')::bigint as k from events")
def json_props_typed(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    path = scratch(spark, "events-json")
    e.select(F.to_json(F.struct("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k")))).write.text(path)
    return files.read_json(spark, path, EVENT).drop(validate.CORRUPT)


@query("""
select case when event_id % 97 = 0 then null else event_id end as event_id, case when event_id % 97 = 0 then null else event_type end as event_type,
  case when event_id % 97 = 0 then null else (props->>'$.k')::bigint end as k, case when event_id % 97 = 0 then '{"event_id": ' || event_id || ', broken' end as wrong
from events
""")
def decode_json_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    good = F.to_json(F.struct("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k")))
    bad = F.concat(F.lit('{"event_id": '), "event_id", F.lit(", broken"))
    # a broken payload keeps no field, as one that was cut off can't be trusted
    got = topics.decode_json_events(e.select(F.when(F.col("event_id") % 97 == 0, bad).otherwise(good).cast("binary").alias("value")), EVENT)
    fine = F.col(validate.CORRUPT).isNull()
    return got.select(*(F.when(fine, F.col(c)).alias(c) for c in EVENT.names), F.col(validate.CORRUPT).alias("wrong"))


@query("select user_id, event_id, event_type, value from events")
def api_payload_explode(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    body = F.to_json(F.struct(F.struct(F.collect_list(F.struct("event_id", "event_type", "value")).alias("items")).alias("data"), F.lit(None).cast("string").alias("next")))
    responses = e.groupBy("user_id", F.floor(F.col("event_id") / 100).alias("page")).agg(body.alias("body"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    return api.explode_api_payloads(responses, "body", "data.items", schema, keep=["user_id"]).drop(validate.CORRUPT)


@query("select n_nationkey, n_name, n_regionkey from nation")
def jdbc_roundtrip(spark, sf_dir):
    url, own = database(spark)
    sqlsync.write_sql(table(spark, sf_dir, "nation"), url, f"nation{own}", partitions=2)
    n = sqlsync.read_sql(spark, url, table=f"nation{own}")
    return n.toDF(*(c.lower() for c in n.columns))


@query("select o_orderkey, o_custkey, o_orderstatus from orders")
def jdbc_partitioned_scan(spark, sf_dir):
    url, own = database(spark)
    sqlsync.write_sql(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), url, f"orders{own}", partitions=4)
    o = jdbc.read_jdbc(spark, url, table=f"orders{own}", partition_column="o_orderkey", partitions=4)
    return o.toDF(*(c.lower() for c in o.columns))


@query("select n_regionkey, count(*) as nations, min(n_name) as first_name from nation where n_nationkey >= 3 and n_name <> 'NATION_7' group by n_regionkey")
def sql_mart_sync(spark, sf_dir):
    url, own = database(spark)
    select = f'select "n_regionkey", count(*) as nations, min("n_name") as first_name from staging{own} where "n_name" <> \'NATION_7\' group by "n_regionkey"'
    sqlsync.sync(spark, table(spark, sf_dir, "nation").withColumn("n_name", F.col("n_name").cast("varchar(40)")), url, f"staging{own}", "n_nationkey >= 3", [(select, f"mart{own}", "overwrite")], staging_types="n_name VARCHAR(40)")
    got = sqlsync.read_sql(spark, url, table=f"mart{own}")
    return got.toDF(*(c.lower() for c in got.columns)).withColumn("nations", F.col("nations").cast("long"))


@query("""
select o_orderkey, o_orderstatus, o_totalprice, case when year(o_orderdate) > 1994 then o_orderpriority end as o_orderpriority, year(o_orderdate)::varchar || '/' as o_year
from orders where not coalesce(o_orderstatus = 'F' and o_totalprice < 100000, false)
""")
def delete_where(spark, sf_dir):
    """From a table with partitions, whose later files have one more column."""
    path = scratch(spark, "orders")
    o = table(spark, sf_dir, "orders").withColumn("o_year", F.concat(F.year("o_orderdate"), F.lit("/")))
    old = o.where("year(o_orderdate) <= 1994").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_year")
    silver.append(old, path, ["o_year"])
    silver.append(o.where("not coalesce(year(o_orderdate) <= 1994, false)").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_year"), path, ["o_year"])
    sqlsync.delete_where(spark, path, "o_orderstatus = 'F' and o_totalprice < 100000")
    return silver.read(spark, path, o).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_year")


@query("select event_id, user_id, event_type, value from events where ts > (select max(ts) from events where ts < timestamp '2024-01-20')")
def incremental_watermark(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return jdbc.newer_than(e, e.where("ts < timestamp '2024-01-20'"), "ts").select("event_id", "user_id", "event_type", "value")


@query("select event_id, user_id, event_type from events where ts > timestamp '2024-01-20'")
def incremental_watermark_query(spark, sf_dir):
    url, own = database(spark)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type"), F.col("ts").cast("timestamp").alias("happened"))
    sqlsync.write_sql(e, url, f"events{own}", partitions=4, createTableColumnTypes="event_type VARCHAR(20)")
    mark = spark.createDataFrame([("2024-01-20 00:00:00",)], "at string").first()["at"]
    got = jdbc.read_jdbc(spark, url, query=f'select "event_id", "user_id", "event_type" from events{own} where "happened" > timestamp({jdbc.WATERMARK})', watermark=mark)
    return got.toDF(*(c.lower() for c in got.columns))


@query("select max(ts) as watermark from events")
def high_watermark(spark, sf_dir):
    return jdbc.high_watermark(table(spark, sf_dir, "events"), "ts")


@query("select c_custkey, c_mktsegment, c_acctbal from customer")
def prune_to_declared(spark, sf_dir):
    return keep_declared(table(spark, sf_dir, "customer"), ["C_CUSTKEY", "c_mktsegment", "not_there", "c_acctbal"]).toDF("c_custkey", "c_mktsegment", "c_acctbal")


@query("select c_custkey as id, c_name as name, c_acctbal as balance from customer")
def persist_subset_alias(spark, sf_dir):
    spec = DatasetSpec("customer", (ColumnSpec("c_custkey", LONG, alias="id"), ColumnSpec("c_name", alias="name"), ColumnSpec("c_nationkey", LONG, ignore_persistence=True), ColumnSpec("c_acctbal", DOUBLE, alias="balance")))
    return persisted_view(table(spark, sf_dir, "customer"), spec)


@query("select n_nationkey, timestamp '2024-03-05 06:07:08' as datalake_load_date, timestamp '2024-03-05 00:00:00' as datalake_load_day, 'run-1' as datalake_ingestion_uuid from nation")
def load_stamp(spark, sf_dir):
    return stamp(table(spark, sf_dir, "nation").select("n_nationkey"), datetime(2024, 3, 5, 6, 7, 8), "run-1")


def landed_orders(spark, sf_dir) -> str:
    """A landing folder with a CSV file of orders for each month, one of statuses for each year, and one that nobody knows."""
    base, o = scratch(spark, "landing"), table(spark, sf_dir, "orders")
    parts = (
        (o.select(F.date_format("o_orderdate", "yyyyMM").alias("f"), "o_orderkey", "o_totalprice"), "{}_orders.csv"), (o.select(F.year("o_orderdate").alias("f"), "o_orderkey", "o_orderstatus"), "status_{}.csv"),
        (o.select(F.lit("x").alias("f"), "o_orderkey"), "notes_{}.txt"),
    )
    for i, (rows, name) in enumerate(parts):
        written = f"{base}-written/{i}"
        rows.repartition("f").write.partitionBy("f").csv(written)
        for file in leaf_files(spark, written):
            if not file.startswith("_"):
                rename(spark, f"{written}/{file}", f"{base}/{i}/{name.format(file.split('/')[0].split('=')[1])}")
    return base


PATTERNS = {"orders": "<yyyy><mm>_orders.csv", "status": "status_<yyyy>.csv"}


@query("""
select strftime(o_orderdate, '%Y%m') || '_orders.csv' as file, 'orders' as dataset from orders group by all
union all select 'status_' || year(o_orderdate) || '.csv', 'status' from orders group by all
union all select 'notes_x.txt', null
""")
def file_pattern_match(spark, sf_dir):
    """Files of a landing folder, listed and matched with the datasets' patterns."""
    return partitions.match_files(partitions.landing_files(spark, landed_orders(spark, sf_dir)), PATTERNS).select("file", "dataset")


@query("select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') as yyyy, strftime(o_orderdate, '%m') as mm from orders")
def partition_from_filename(spark, sf_dir):
    """Rows of all files of a dataset, with the fields of the name of the file that each comes from."""
    base = landed_orders(spark, sf_dir)
    files_ = partitions.match_files(partitions.landing_files(spark, base), PATTERNS).where("dataset = 'orders'")
    rows = spark.read.schema("o_orderkey long, o_totalprice double").csv(f"{base}/0").select("*", F.col("_metadata.file_name").alias("file"))
    known = rows.join(files_.select("file"), "file", "left_semi")
    return partitions.from_file_name(known, F.col("file"), PATTERNS["orders"]).drop("file")


@query("select event_id, year(ts)::int as ts_yyyy, month(ts)::int as ts_mm, day(ts)::int as ts_dd, hour(ts)::int as ts_hh from events")
def partition_from_date(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    return partitions.from_date(e, "ts", ("yyyy", "mm", "dd", "hh")).drop("ts")


@query("""
select user_id, event_id, event_type from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events where ts <= timestamp '2024-01-15' and event_type <> 'error') where n = 1
""")
def current_version_as_of(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("enabled", F.col("event_type") != "error")
    return versions.current_as_of(e, ["user_id"], "ts", datetime(2024, 1, 15), "enabled", ["event_id"]).select("user_id", "event_id", "event_type")


@query("select c_custkey, to_base64(c_name::blob) as c_name from customer")
def binary_base64(spark, sf_dir):
    return sinks.binary_to_base64(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").cast("binary").alias("c_name")))




@query("""
with m(mode) as (values ('first_line'), ('without_header'), ('ignore_header'))
select mode, case when mode = 'ignore_header' then 'x,y' else 'key,priority' end as header, o_orderkey::varchar as "key", o_orderpriority as priority from orders, m where mode <> 'without_header'
union all select mode, '', o_orderkey::varchar, o_orderpriority from orders, m where mode = 'without_header'
""")
def csv_header_modes(spark, sf_dir):
    """A header with the declared names, none, and one with other names that is skipped; the first line alone tells the names."""
    o, out = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("priority")), None
    for mode, names in ((files.FIRST_LINE, o.columns), (files.WITHOUT_HEADER, None), (files.IGNORE_HEADER, ["x", "y"])):
        path = scratch(spark, mode)
        (o.toDF(*names) if names else o).write.option("header", names is not None).csv(path)
        header = ",".join(files.csv_header(spark, path)) if names else ""
        got = files.read_csv(spark, path, o.schema, mode).select(F.lit(mode).alias("mode"), F.lit(header).alias("header"), "key", "priority")
        out = got if out is None else out.unionByName(got)
    return out


@query("select c_custkey, c_name, c_nationkey::varchar as c_nationkey, c_mktsegment from customer")
def sensitive_fields_as_text(spark, sf_dir):
    """Sensitive leaves inside a struct are found by their metadata and read as text."""
    mark = {"sensitive": True}
    person = F.struct(F.col("c_name").alias("name", metadata=mark), F.col("c_nationkey").alias("nation", metadata=mark), F.col("c_mktsegment").alias("segment"))
    c = table(spark, sf_dir, "customer").select("c_custkey", person.alias("person"))
    assert sensitive_columns(c.schema) == ["person.name", "person.nation"]
    text = c.select("c_custkey", F.from_json(F.to_json("person"), sensitive_as_string(c.schema["person"].dataType)).alias("person"))
    return text.select("c_custkey", F.col("person.name").alias("c_name"), F.col("person.nation").alias("c_nationkey"), F.col("person.segment").alias("c_mktsegment"))


@query("select o_orderkey, o_custkey, o_totalprice::decimal(12, 2)::varchar as o_totalprice, o_orderdate::date::varchar as o_orderdate, o_orderstatus, 12 as digits, 2 as decimals from orders")
def spec_from_catalog(spark, sf_dir):
    """A dataset's columns from the database's own description of a table that was just written there; the table's rows as text are cast by them."""
    url, end = database(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12, 2)").alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderstatus")
    sqlsync.write_sql(o, url, f"described{end}")
    columns = jdbc.described(spark, url, f"described{end}", keys=("o_orderkey",), date_pattern="yyyy-MM-dd")
    price = next(c for c in columns if c.name == "o_totalprice")
    text = o.select(*(F.col(c).cast("string").alias(c) for c in o.columns))
    cast = cast_split(text, DatasetSpec("described", columns).columns).valid
    return cast.withColumns({"o_totalprice": F.col("o_totalprice").cast("string"), "o_orderdate": F.col("o_orderdate").cast("string"), "digits": F.lit(price.precision), "decimals": F.lit(price.scale)})
