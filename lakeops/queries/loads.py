"""Load semantics, histories and run statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import bronze, silver, stats
from lakeops.queries.casts import LINE_ORDER
from lakeops.registry import query, table
from lakeops.scratch import scratch
from lakeops.spec import FULL_SNAPSHOT, INCREMENTAL, LAST_CHANGES
from lakeops.streaming import topics

#: Two batches of users' latest events that make up the table: up to the 15th, and from the 10th on; every 40th user moves back in time.
OLD = "(select * from events where ts < timestamp '2024-01-15')"
NEW = "(select * replace (case when user_id % 40 = 3 then ts - interval 20 day else ts end as ts) from events where ts >= timestamp '2024-01-10')"


def first_batch(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").where("ts < timestamp '2024-01-15'")


def second_batch(spark, sf_dir) -> DataFrame:
    moved = F.when(F.col("user_id") % 40 == 3, F.col("ts") - F.expr("interval 20 days")).otherwise(F.col("ts"))
    return table(spark, sf_dir, "events").where("ts >= timestamp '2024-01-10'").withColumn("ts", moved)


def monthly(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("yyyy"))


@query("select o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::int as yyyy from orders")
def load_full_snapshot(spark, sf_dir):
    """A snapshot of the older orders, then one of all."""
    path, o = scratch(spark, "snapshot"), monthly(table(spark, sf_dir, "orders"))
    silver.write(spark, path, o.where("yyyy < 1996"), FULL_SNAPSHOT, partition_by=["yyyy"])
    silver.write(spark, path, o, FULL_SNAPSHOT, partition_by=["yyyy"])
    return silver.read(spark, path)


@query("select o_orderkey, o_custkey, case when year(o_orderdate) in (1996, 1998) then -o_totalprice else o_totalprice end as o_totalprice, year(o_orderdate)::int as yyyy from orders")
def load_replace_partitions(spark, sf_dir):
    """All orders, then two years of them once more with other values."""
    path, o = scratch(spark, "partitions"), monthly(table(spark, sf_dir, "orders"))
    silver.write(spark, path, o, INCREMENTAL, partition_by=["yyyy"])
    silver.write(spark, path, o.where("yyyy in (1996, 1998)").withColumn("o_totalprice", -F.col("o_totalprice")), INCREMENTAL, partition_by=["yyyy"], reprocess=silver.FULL)
    return silver.read(spark, path)


@query("select o_orderkey, o_custkey, case when year(o_orderdate) >= 1995 then o_orderpriority end as o_orderpriority from orders")
def load_incremental(spark, sf_dir):
    """The older orders, then the newer ones with a column more."""
    path, o = scratch(spark, "incremental"), table(spark, sf_dir, "orders")
    silver.write(spark, path, o.where(F.year("o_orderdate") < 1995).select("o_orderkey", "o_custkey"), INCREMENTAL)
    silver.write(spark, path, o.where(F.year("o_orderdate") >= 1995).select("o_orderkey", "o_custkey", "o_orderpriority"), INCREMENTAL)
    return silver.read(spark, path).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("select o_orderkey, case when year(o_orderdate) >= 1995 then o_orderpriority end as o_orderpriority from orders")
def catalog_register_refresh(spark, sf_dir):
    """A table is registered, gets a batch with a new column, and is registered anew."""
    name, path, o = f"t_{uuid.uuid4().hex[:12]}", scratch(spark, "registered"), table(spark, sf_dir, "orders")
    silver.append(o.where(F.year("o_orderdate") < 1995).select("o_orderkey"), path)
    silver.register(spark, "lakeops_registered", name, path, create_database=True)
    silver.append(o.where(F.year("o_orderdate") >= 1995).select("o_orderkey", "o_orderpriority"), path)
    silver.register(spark, "lakeops_registered", name, path, refresh=True)
    return spark.table(f"lakeops_registered.{name}").select("o_orderkey", "o_orderpriority")


@query("select 'after' as read, o_orderkey, null::varchar as o_note from orders")
def bronze_read_missing(spark, sf_dir):
    """A table that is not there has no rows; a declared column that its files lack is null."""
    path, o = scratch(spark, "missing"), table(spark, sf_dir, "orders").select("o_orderkey")
    declared = T.StructType([*o.schema.fields, T.StructField("o_note", T.StringType())])
    before = silver.read_or_empty(spark, path, declared).select(F.lit("before").alias("read"), "*")
    silver.append(o, path)
    return before.unionByName(silver.read_or_empty(spark, path, declared).select(F.lit("after").alias("read"), "*"))


@query(f"""
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(f'{c} desc' for c in LINE_ORDER)}) as n from lineitem) where n = 1
""")
def latest_per_key(spark, sf_dir):
    got = silver.latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER[0], list(LINE_ORDER[1:]))
    return got.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


LATEST = "(select * from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from {} b) where n = 1)"
UPSERTED = f"""
with o as {LATEST.format(OLD)}, w as {LATEST.format(NEW)}
select coalesce(o.user_id, w.user_id) as user_id, coalesce(o.event_type, w.event_type) as event_type,
  case when w.event_id is not null and (o.event_id is null or {{guard}}) then w.event_id else o.event_id end as event_id,
  case when w.event_id is not null and (o.event_id is null or {{guard}}) then w.value else o.value end as value
from o full join w on o.user_id = w.user_id and o.event_type = w.event_type
"""


def _batches(spark, sf_dir) -> list[DataFrame]:
    return [silver.latest_per_key(b(spark, sf_dir), ["user_id", "event_type"], "ts", ["event_id"]) for b in (first_batch, second_batch)]


@query(UPSERTED.format(guard="o.ts <= w.ts"))
def upsert_last_changes(spark, sf_dir):
    path = scratch(spark, "upsert")
    for batch in _batches(spark, sf_dir):
        silver.write(spark, path, batch, LAST_CHANGES, ["user_id", "event_type"], "ts")
    return silver.read(spark, path).select("user_id", "event_type", "event_id", "value")


@query(UPSERTED.format(guard="true"))
def upsert_parquet_union_form(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    return silver.upsert_union(old, new, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "value")


DAYS = LATEST.replace("*, row_number", "*, day(ts)::int as dd, row_number")
LOCKED = f"""
with o as {DAYS.format(OLD)}, w as {DAYS.format(NEW)}
select coalesce(o.user_id, w.user_id) as user_id, coalesce(o.event_type, w.event_type) as event_type, coalesce(o.dd, w.dd) as dd,
  case when w.event_id is not null and (o.event_id is null or o.ts <= w.ts) then w.event_id else o.event_id end as event_id
from o full join w on o.user_id = w.user_id and o.event_type = w.event_type and o.dd = w.dd
"""


@query(LOCKED)
def upsert_partition_locked(spark, sf_dir):
    path = scratch(spark, "locked")
    for batch in _batches(spark, sf_dir):
        silver.write(spark, path, batch.withColumn("dd", F.dayofmonth("ts")), LAST_CHANGES, ["user_id", "event_type"], "ts", ["dd"], allow_partition_change=False)
    return silver.read(spark, path).select("user_id", "event_type", "dd", "event_id")


@query(UPSERTED.format(guard="o.ts <= w.ts").replace("as value\n", "as value, day(case when w.event_id is not null and (o.event_id is null or o.ts <= w.ts) then w.ts else o.ts end)::int as dd\n"))
def upsert_partition_moves(spark, sf_dir):
    path = scratch(spark, "moves")
    for batch in _batches(spark, sf_dir):
        silver.write(spark, path, batch.withColumn("dd", F.dayofmonth("ts")), LAST_CHANGES, ["user_id", "event_type"], "ts", ["dd"])
    return silver.read(spark, path).select("user_id", "event_type", "event_id", "value", "dd")


@query("""
select o_orderkey, o_orderstatus, null::varchar as o_orderpriority from orders where o_orderkey % 2 = 0
union all select o_orderkey, null, o_orderpriority from orders where o_orderkey % 2 = 1
""")
def schema_evolution_union(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old, new = silver.evolve(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus"), o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderpriority"))
    return old.unionByName(new)


@query(f"select event_id, user_id, event_type from {LATEST.format(OLD)} union all select event_id, user_id, event_type from {LATEST.format(NEW)}")
def history_append(spark, sf_dir):
    path = scratch(spark, "history")
    for batch in _batches(spark, sf_dir):
        silver.write(spark, path, batch, LAST_CHANGES, ["user_id", "event_type"], "ts", keep_history=True)
    return silver.read(spark, f"{path}_historical").select("event_id", "user_id", "event_type")


@query("""
select o_orderkey, case when o_orderkey % 10 = 0 then 'partial' when o_orderkey % 4 = 0 then 'full' else 'none' end as reprocess from orders
""")
def reprocess_detect(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    files = o.withColumn("file", F.concat(F.lit("f"), "o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, ".fix.csv").otherwise(".csv")))
    return silver.reprocess_kind(files, files.where("o_orderkey % 4 = 0").select("file")).select("o_orderkey", "reprocess")


@query("select n_nationkey, n_name || '-2' as n_name, 2 as versions from nation")
def bronze_versions(spark, sf_dir):
    path, n = scratch(spark, "bronze"), table(spark, sf_dir, "nation")
    for i in (1, 2):
        bronze.write_versioned(n.select("n_nationkey", F.concat("n_name", F.lit(f"-{i}")).alias("n_name")), path)
    return bronze.read_version(spark, path).withColumn("versions", F.lit(len(bronze.versions(spark, path))))


def runs(spark, sf_dir) -> DataFrame:
    """A run history from events: each user's day is a run; signups and views start it, errors end it."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat_ws("-", "user_id", F.dayofmonth("ts")).alias("run_id"), F.concat(F.lit("d"), F.col("user_id") % 20).alias("dataset"),
        F.when(F.col("event_type") == "error", stats.DONE).otherwise(stats.RUNNING).alias("state"), F.col("ts").alias("at"), "event_id", "value",
    )


RUNS = "(select user_id || '-' || day(ts) as run_id, 'd' || user_id % 20 as dataset, case when event_type = 'error' then 'DONE' else 'RUNNING' end as state, ts as \"at\", event_id, value from events)"
STATE = f"(select *, min(\"at\") over (partition by run_id) as started, max(\"at\") over (partition by run_id) as ended, row_number() over (partition by run_id order by \"at\" desc, state) as n from {RUNS})"


@query(f"select dataset, state, count(*) as runs, sum(epoch(date_trunc('second', ended))::bigint - epoch(date_trunc('second', started))::bigint)::bigint as seconds from {STATE} where n = 1 group by dataset, state")
def run_stats_rollup(spark, sf_dir):
    state = stats.latest_state(runs(spark, sf_dir))
    return state.groupBy("dataset", "state").agg(F.count("*").alias("runs"), F.sum("seconds").alias("seconds"))


@query(f"select event_id, run_id, row_number() over (order by \"at\", event_id) as place from {RUNS} where state = 'RUNNING' and value > 90")
def pending_batches(spark, sf_dir):
    waiting = runs(spark, sf_dir).withColumn("pending", (F.col("state") == stats.RUNNING) & (F.col("value") > 90))
    return stats.pending(waiting, "pending", ["at", "event_id"]).select("event_id", "run_id", F.col("place").cast("long").alias("place"))


@query(f"select dataset, count(*) as running from {STATE} where n = 1 and state = 'RUNNING' and epoch(date_trunc('second', started)) >= epoch(timestamp '2024-01-30 23:00:00') - 21600 group by dataset")
def running_guard(spark, sf_dir):
    return stats.running_within(runs(spark, sf_dir), "2024-01-30 23:00:00")


@query("select event_id, user_id, event_type from events")
def stream_drain_once(spark, sf_dir):
    """Two drains of one checkpoint; the second takes only what arrived in between."""
    landing, path, mark = scratch(spark, "landing"), scratch(spark, "drained"), scratch(spark, "mark")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        e.where(part).write.mode("append").parquet(landing)
        topics.drain_to_files(spark.readStream.schema(e.schema).parquet(landing), path, mark)
    return spark.read.parquet(path)


@query(f"select user_id, event_type, event_id, value from {LATEST.format('events')}")
def stream_ingest_foreach_batch(spark, sf_dir):
    landing, path, mark = scratch(spark, "landing"), scratch(spark, "silver"), scratch(spark, "mark")
    e = table(spark, sf_dir, "events")
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        e.where(part).write.mode("append").parquet(landing)

        def load(batch: DataFrame, number: int) -> None:
            silver.write(batch.sparkSession, path, silver.latest_per_key(batch, ["user_id", "event_type"], "ts", ["event_id"]), LAST_CHANGES, ["user_id", "event_type"], "ts")

        topics.ingest(spark.readStream.schema(e.schema).parquet(landing), load, mark)
    return silver.read(spark, path).select("user_id", "event_type", "event_id", "value")
