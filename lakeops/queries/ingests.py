"""Whole batches: outcomes, stored rejects, stamps and partitions, reprocessing, sensitive columns, run history, streams; nested casts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.casting import BAD, cast_split
from lakeops.functions.privacy import SensitiveSplit, rejoin
from lakeops.operators import gold, silver, stats
from lakeops.operators.quality import Expression, NotNull
from lakeops.plans.ingest import SENSITIVE, Lake, Run, Secrets, run_batch
from lakeops.plans.transform import transform
from lakeops.queries.casts import BAD_LINE, LINE, WRONG_LINE, text_lines
from lakeops.queries.scans import read_order_lines
from lakeops.registry import query, table
from lakeops.scratch import scratch
from lakeops.spec import ABSOLUTE, ARRAY, DATETIME, DOUBLE, INCREMENTAL, INTEGER, LAST_CHANGES, LONG, PERCENTAGE, PERMISSIVE, REJECT, STRUCT, ColumnSpec, DatasetSpec
from lakeops.streaming import topics

AT = datetime(2024, 3, 5, 6, 7, 8)
CSV_ORDER = (ColumnSpec("o_orderkey", LONG, primary_key=True), ColumnSpec("o_custkey", LONG), ColumnSpec("o_orderstatus"), ColumnSpec("o_orderpriority"))


def batches(spark, sf_dir) -> list[tuple[str, DataFrame, DatasetSpec]]:
    """A batch for each way to end: lineitem as text, whole or without its bad lines, and orders as CSV lines of which some are broken."""
    lines, orders = text_lines(spark, sf_dir), read_order_lines(spark, sf_dir)
    good = lines.where("l_quantity <> 'N/A' and l_shipdate <> '31-02-2000'")
    few = {"validation_mode": PERMISSIVE, "threshold": 60, "threshold_kind": PERCENTAGE}
    rules = (Expression("l_quantity < 40", "small"), NotNull(("l_orderkey", "l_linenumber")))
    return [
        ("clean", good, DatasetSpec("clean", LINE)),
        ("failed casts allowed", lines, DatasetSpec("lines", LINE, **few)),
        ("failed casts", lines, DatasetSpec("lines", LINE)),
        ("failed rules reported", good, DatasetSpec("ruled", LINE, rules=rules)),
        ("failed rules rejected", good, DatasetSpec("ruled", LINE, rules=rules, quality_mode=REJECT)),
        ("broken lines allowed", orders, DatasetSpec("orders", CSV_ORDER, **few)),
        ("broken lines", orders, DatasetSpec("orders", CSV_ORDER, threshold=1, threshold_kind=ABSOLUTE)),
    ]


def run_all(spark, sf_dir) -> tuple[str, list[tuple]]:
    """All batches, each with a table, rejects and a place in the history of its own; the folder and (batch, outcome, loaded, read, wrong, invalid, failed) of each."""
    base, out = scratch(spark, "lake"), []
    for i, (name, df, spec) in enumerate(batches(spark, sf_dir)):
        lake = Lake(f"{base}/tables/{i}", f"{base}/rejects/{i}", f"{base}/history")
        out.append((name, *run_batch(spark, df, spec, lake, Run(f"run-{i}", AT + timedelta(minutes=i), file=f"file-{i}"))))
    return base, out


COUNTS = f"""
l as (select count(*) as n, count(*) filter ({BAD_LINE}) as bad, count(*) filter (not {BAD_LINE} and l_quantity >= 40) as large from lineitem),
o as (select count(*) as n, count(*) filter ({WRONG_LINE}) as wrong from orders),
b(i, batch, outcome, loaded, "read", wrong, invalid, failed) as (
  select 0, 'clean', 'INGESTED_WITHOUT_ERRORS', true, n - bad, 0, 0, 0 from l
  union all select 1, 'failed casts allowed', 'INGESTED_WITH_ERRORS', true, n, 0, bad, 0 from l
  union all select 2, 'failed casts', 'REJECTED_INVALID', false, n, 0, bad, 0 from l
  union all select 3, 'failed rules reported', 'INGESTED_WITH_ERRORS', true, n - bad, 0, 0, large from l
  union all select 4, 'failed rules rejected', 'REJECTED_INVALID', false, n - bad, 0, 0, large from l
  union all select 5, 'broken lines allowed', 'INGESTED_WITH_ERRORS', true, n, wrong, 0, 0 from o
  union all select 6, 'broken lines', 'REJECTED_SCHEMA_MISMATCH', false, n, wrong, 0, 0 from o)
"""


@query(f"""
with {COUNTS}
select batch, outcome, loaded, "read", wrong, invalid, failed, case when loaded then "read" - wrong - invalid end::bigint as stored from b
""")
def ingest_outcomes(spark, sf_dir):
    """Every way a batch can end, and how many rows its table then has."""
    base, results = run_all(spark, sf_dir)
    stored = None
    for i, (name, _, loaded, *_) in enumerate(results):
        if loaded:
            one = silver.read(spark, f"{base}/tables/{i}").agg(F.lit(name).alias("batch"), F.count("*").alias("stored"))
            stored = one if stored is None else stored.unionByName(one)
    ended = spark.createDataFrame(results, "batch string, outcome string, loaded boolean, read long, wrong long, invalid long, failed long")
    return ended.join(stored, "batch", "left")


@query(f"""
with bad as (select l_orderkey, l_linenumber, concat_ws('|', case when l_linenumber = 3 then 'l_quantity' end, case when day(l_shipdate) = 10 then 'l_shipdate' end) as columns from lineitem where {BAD_LINE}),
wrong as (select o_orderkey from orders where {WRONG_LINE}),
large as (select l_orderkey, l_linenumber from lineitem where not {BAD_LINE} and l_quantity >= 40)
select i as batch, 'invalid' as reason, l_orderkey as "key", l_linenumber::bigint as line, columns as detail from bad, (values (1), (2)) v(i)
union all select i, 'quality', l_orderkey, l_linenumber, 'small' from large, (values (3), (4)) v(i)
union all select i, 'schema_mismatch', o_orderkey, null, null from wrong, (values (5), (6)) v(i)
""")
def ingest_stored_rejects(spark, sf_dir):
    """The rows that batches stored with their rejects: texts as they came with the columns that failed, rows with the rules they fail, broken lines."""
    base, _ = run_all(spark, sf_dir)
    out = None
    for i in (1, 2):
        text = spark.read.csv(f"{base}/rejects/{i}/invalid", header=True)
        part = text.select(F.lit(i).alias("batch"), F.lit("invalid").alias("reason"), F.trim("l_orderkey").cast("long").alias("key"), F.trim("l_linenumber").cast("long").alias("line"), F.col(BAD).alias("detail"))
        out = part if out is None else out.unionByName(part)
    for i in (3, 4):
        rows = spark.read.schema("row string, failed_rules array<string>").json(f"{base}/rejects/{i}/quality")
        row = F.from_json("row", "l_orderkey long, l_linenumber long")
        key, line = row["l_orderkey"], row["l_linenumber"]
        out = out.unionByName(rows.select(F.lit(i).alias("batch"), F.lit("quality").alias("reason"), key.alias("key"), line.alias("line"), F.concat_ws("|", "failed_rules").alias("detail")))
    for i in (5, 6):
        lines = spark.read.text(f"{base}/rejects/{i}/schema_mismatch")
        none = F.lit(None)
        out = out.unionByName(lines.select(F.lit(i).alias("batch"), F.lit("schema_mismatch").alias("reason"), F.split("value", ",")[0].cast("long").alias("key"), none.cast("long").alias("line"), none.cast("string").alias("detail")))
    return out


@query(f"""
with {COUNTS}
select 'run-' || i as run_id, 'DONE' as state, outcome as result, 'file-' || i as file, ("read" - wrong)::bigint as read_valid, wrong::bigint as read_invalid, ("read" - wrong - invalid)::bigint as cast_valid,
  invalid::bigint as cast_invalid, ("read" - wrong - invalid - failed)::bigint as quality_valid, failed::bigint as quality_invalid from b
""")
def ingest_run_history(spark, sf_dir):
    """What the runs left in the history: the newest record of each."""
    base, _ = run_all(spark, sf_dir)
    return stats.latest_state(spark.read.schema(stats.RUN).parquet(f"{base}/history")).select("run_id", "state", "result", "file", "rows.*")


@query("""
with t as (select o_custkey, count(*) as orders, sum(o_totalprice) as spent from orders group by o_custkey),
n as (select count(*) as rows, count(*) filter (orders > 12) as busy, count(*) filter (c_nationkey is null) as unknown from t left join customer on c_custkey = o_custkey)
select 'report' as kind, case when busy > 0 then 'calm: ' || busy || ' of ' || rows || ' rows' end as message, null::bigint as "key", rows::bigint as n, case when busy > 0 then 'INGESTED_WITH_ERRORS' else 'INGESTED_WITHOUT_ERRORS' end as result from n
union all select 'row', null, o_custkey, orders, null from t
""")
def gold_run_report(spark, sf_dir):
    """A gold run with rules: what it wrote, and what its history tells of it."""
    base = scratch(spark, "gold")
    stages = [
        gold.agg_stage(["o_custkey"], [("orders", "count", "o_orderkey"), ("spent", "sum", "o_totalprice")]),
        gold.table_stage(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c", "leftouter", "current.o_custkey = c.c_custkey"),
    ]
    rules = [Expression("orders <= 12", "calm"), NotNull(("c_nationkey",), name="known")]
    transform(spark, "spending", table(spark, sf_dir, "orders"), stages, {"mode": "overwrite", "path": f"{base}/table"}, rules, history=f"{base}/history", run_id="gold-1", at=AT)
    run = stats.latest_state(spark.read.schema(stats.RUN).parquet(f"{base}/history"))
    none = F.lit(None)
    told = run.select(F.lit("report").alias("kind"), F.get("messages", F.lit(0)).alias("message"), none.cast("long").alias("key"), F.col("rows.read_valid").alias("n"), "result")
    return told.unionByName(spark.read.parquet(f"{base}/table").select(F.lit("row").alias("kind"), none.cast("string").alias("message"), F.col("o_custkey").alias("key"), F.col("orders").alias("n"), none.cast("string").alias("result")))


EVENT_TEXT = (ColumnSpec("event_id", LONG, primary_key=True), ColumnSpec("user_id", LONG), ColumnSpec("event_type"), ColumnSpec("ts", DATETIME, timestamp=True, partitionable=True), ColumnSpec("value", DOUBLE))


def text_events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.col("value").cast("string").alias("value"))


@query("""
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, year(ts)::int as ts_yyyy, month(ts)::int as ts_mm, day(ts)::int as ts_dd, '2024-03-05 06:07:08' as loaded, 'run-1' as run_id from events
""")
def ingest_stamped_partitions(spark, sf_dir):
    """Stored rows have the stamps of their load and the partitions of their date."""
    path = scratch(spark, "events")
    run_batch(spark, text_events(spark, sf_dir), DatasetSpec("events", EVENT_TEXT, INCREMENTAL), Lake(path), Run("run-1", AT))
    got = silver.read(spark, path)
    return got.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "ts_yyyy", "ts_mm", "ts_dd", F.date_format("datalake_load_date", "yyyy-MM-dd HH:mm:ss").alias("loaded"), F.col("datalake_ingestion_uuid").alias("run_id"))


@query("select o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, 'INGESTED_WITHOUT_ERRORS' as outcome from orders")
def ingest_typed_source(spark, sf_dir):
    """Rows of a format that has types are loaded as they are; nothing is cast."""
    path, o = scratch(spark, "typed"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    spec = DatasetSpec("typed", (ColumnSpec("o_orderkey", LONG, primary_key=True), ColumnSpec("o_custkey", LONG), ColumnSpec("o_totalprice", DOUBLE), ColumnSpec("o_orderdate", DATETIME)))
    result = run_batch(spark, o, spec, Lake(path), typed=True)
    got = silver.read(spark, path)
    assert dict(got.dtypes) == dict(o.dtypes)
    return got.withColumns({"o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "outcome": F.lit(result.outcome)})


@query("""
with e as (select event_id, case when ts < timestamp '2024-01-15' then 1 else 2 end as half, value from events)
select event_id, case when half = 1 then -value else value end as value, case when half = 1 then 'again' else 'second' end as run_id from e
union all select event_id, value, 'fix' from e where half = 1 and event_id % 10 = 0
""")
def ingest_reprocessed_files(spark, sf_dir):
    """Two files of an incremental dataset, partitioned by the files' names; the first comes again with other values and replaces its partition, then its fix is appended."""
    base, e = scratch(spark, "files"), text_events(spark, sf_dir).select("event_id", "value", "ts")
    spec = DatasetSpec("halves", (ColumnSpec("event_id", LONG), ColumnSpec("value", DOUBLE)), INCREMENTAL, file_pattern="events_<hh>.csv")
    first, second = e.where("ts < '2024-01-15'"), e.where("ts >= '2024-01-15'")
    negative = first.withColumn("value", (-F.col("value").cast("double")).cast("string"))
    files = [("first", "events_01.csv", first), ("second", "events_02.csv", second), ("again", "events_01.csv", negative), ("fix", "events_01.fix.csv", first.where("cast(event_id as long) % 10 = 0"))]
    for i, (run, file, df) in enumerate(files):
        run_batch(spark, df.drop("ts"), spec, Lake(f"{base}/table", history=f"{base}/history"), Run(run, AT + timedelta(hours=i), file))
    return silver.read(spark, f"{base}/table").select("event_id", "value", F.col("datalake_ingestion_uuid").alias("run_id"))


@query("select c_custkey, c_name, c_nationkey, case when c_custkey % 5 = 0 then 'second' else 'first' end as run_id from customer")
def ingest_sensitive_columns(spark, sf_dir):
    """Two batches of customers with hidden names: the main table has pseudonyms, and with the key the names come back."""
    path, c = scratch(spark, "customers"), table(spark, sf_dir, "customer")
    spec = DatasetSpec(
        "customers", (ColumnSpec("c_custkey", LONG, primary_key=True), ColumnSpec("c_name", sensitive=True), ColumnSpec("c_nationkey", INTEGER), ColumnSpec("seen", DATETIME, timestamp=True)), LAST_CHANGES,
    )
    lake = Lake(path, secrets=Secrets("salt", "data", "master"))
    for i, (run, df) in enumerate((("first", c), ("second", c.where("c_custkey % 5 = 0")))):
        text = df.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("string").alias("c_nationkey"), F.lit(f"2024-01-0{i + 1} 00:00:00").alias("seen"))
        run_batch(spark, text, spec, lake, Run(run, AT + timedelta(days=i)))
    main, hidden = silver.read(spark, path), silver.read(spark, path + SENSITIVE)
    clear = rejoin(SensitiveSplit(main, hidden), ["c_name"], "master")
    masked = main.where("length(c_name) = 128").select("c_custkey")
    return clear.join(masked, "c_custkey").select("c_custkey", "c_name", "c_nationkey", F.col("datalake_ingestion_uuid").alias("run_id"))


@query("""
select event_id, user_id, 2024 as load_yyyy, 3 as load_mm, 5 as load_dd, 6 + event_id % 2 as load_hh, count(*) over () as stored
from events where value is not null
""")
def stream_ingest_dataset(spark, sf_dir):
    """A topic's text through the whole batch pipeline: casts, a rule, counts, rejects, history, partitions by the load's hour. Two drains; the second one's batch comes twice."""
    base, e = scratch(spark, "topic"), text_events(spark, sf_dir).drop("ts")
    spec = DatasetSpec("topic", tuple(c for c in EVENT_TEXT if c.name != "ts"), INCREMENTAL, rules=(NotNull(("value",), name="value"),), validation_mode=PERMISSIVE, threshold=100, threshold_kind=PERCENTAGE)
    lake = Lake(f"{base}/table", f"{base}/rejects", f"{base}/history", write_failed=False)
    stream = lambda: spark.readStream.schema(e.schema).parquet(f"{base}/landing")
    for i in (0, 1):
        part = e.where(F.col("event_id").cast("long") % 2 == i)
        part.write.mode("append").parquet(f"{base}/landing")
        topics.ingest_dataset(stream(), spec, lake, f"{base}/mark", clock=lambda i=i: AT + timedelta(hours=i))
    key = topics.batch_key(f"{base}/mark", 1)
    run_batch(spark, part, spec, lake, Run(key, AT + timedelta(hours=1), batch=key, by_hour=True))
    got = silver.read(spark, f"{base}/table")
    stored = got.agg(F.count("*").alias("stored"))  # one row
    return got.select("event_id", "user_id", "load_yyyy", "load_mm", "load_dd", F.col("load_hh").cast("long").alias("load_hh")).crossJoin(stored)


NESTED = (
    ColumnSpec("event_id", LONG), ColumnSpec("props", STRUCT), ColumnSpec("k", INTEGER, parent="props"), ColumnSpec("who", STRUCT, parent="props"), ColumnSpec("user", LONG, parent="who"),
    ColumnSpec("values", ARRAY, element=DOUBLE),
)


@query("""
with e as (select event_id, user_id, value, (props->>'$.k')::int as k from events)
select event_id, case when event_id % 7 <> 1 and event_id % 11 <> 2 then k end as k, case when event_id % 11 not in (2, 3) then user_id end as "user",
  case when event_id % 13 <> 4 and event_id % 17 <> 5 then value end as value,
  concat_ws(',', case when event_id % 11 = 2 then 'props' else nullif(concat_ws(',', case when event_id % 7 = 1 then 'props.k' end, case when event_id % 11 = 3 then 'props.who' end), '') end,
    case when event_id % 17 = 5 then 'values' when event_id % 13 = 4 then 'values[]' end) as bad
from e
""")
def cast_nested_paths(spark, sf_dir):
    """Properties with broken fields, containers of another shape and cut-off texts; what fails is named by its path."""
    e = table(spark, sf_dir, "events")
    k = F.when(F.col("event_id") % 7 == 1, F.lit('"k": "many"')).otherwise(F.concat(F.lit('"k": '), F.get_json_object("props", "$.k")))
    who = F.when(F.col("event_id") % 11 == 3, F.lit('"who": [1]')).otherwise(F.concat(F.lit('"who": {"user": "'), "user_id", F.lit('"}')))
    props = F.concat(F.lit("{"), k, F.lit(", "), who, F.when(F.col("event_id") % 11 == 2, "").otherwise("}"))
    values = F.when(F.col("event_id") % 17 == 5, F.lit("[1")).when(F.col("event_id") % 13 == 4, F.lit('["x"]')).otherwise(F.concat(F.lit("["), F.col("value").cast("string"), F.lit("]")))
    flagged = cast_split(e.select(F.col("event_id").cast("string").alias("event_id"), props.alias("props"), values.alias("values")), NESTED).flagged
    return flagged.select("event_id", F.col("props.k").alias("k"), F.col("props.who.user").alias("user"), F.col("values")[0].alias("value"), F.concat_ws(",", BAD).alias("bad"))
