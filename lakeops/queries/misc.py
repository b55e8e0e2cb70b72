"""Time series, features, privacy, and the flagship pipeline."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import privacy
from lakeops.functions.catalog import function
from lakeops.operators import features, gold, quality, silver, timeseries
from lakeops.operators.quality import Expression, Integrity, NotNull
from lakeops.plans.ingest import prepare
from lakeops.registry import query, table
from lakeops.spec import DATE, DOUBLE, INTEGER, LONG, PERMISSIVE, ColumnSpec, DatasetSpec


def months(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_orderstatus", F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").cast("double").alias("n"))


MONTHS = "(select o_orderstatus, date_trunc('month', o_orderdate)::date as month, count(*)::double as n from orders group by all)"
TOTALS = "(select date_trunc('month', o_orderdate)::date as month, count(*)::double as n from orders group by all)"


@query(f"select o_orderstatus, month::varchar as month, n, case when b = 0 then 0 else n - b end as change from (select *, lag(n, 2, 0) over (partition by o_orderstatus order by month) as b from {MONTHS})")
def variation_abs(spark, sf_dir):
    return timeseries.variation(months(spark, sf_dir), "n", "month", "change", 2, ["o_orderstatus"]).withColumn("month", F.col("month").cast("string"))


@query(f"select month::varchar as month, n, round(case when b = 0 then 0 else (n - b) / n * 100 end, 6) as change from (select *, lag(n, 1, 0) over (order by month) as b from {TOTALS})")
def variation_pct(spark, sf_dir):
    total = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").cast("double").alias("n"))
    got = timeseries.variation(total, "n", "month", "change", 1, percentage=True)
    return got.withColumns({"change": F.round("change", 6), "month": F.col("month").cast("string")})


@query("select o_orderkey, o_totalprice, round(case when b = 0 then 0 else o_totalprice - b end, 2) as change from (select *, lag(o_totalprice, 3, 0) over (order by o_orderdate, o_orderkey) as b from orders)")
def variation_global(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    got = timeseries.variation(o, "o_totalprice", "o_orderdate", "change", 3, ties=["o_orderkey"])
    return got.select("o_orderkey", "o_totalprice", F.round("change", 2).alias("change"))


@query("""
with s as (select o_custkey as id, (make_date(year(o_orderdate)::int, (2 * ceil(month(o_orderdate) / 2))::int, 20) + case when o_custkey % 3 = 1 and year(o_orderdate) >= 1997 then interval 1 month else interval 0 month end)::date as d, count(*) as n from orders group by all),
g as (select *, coalesce(year(d) * 12 + month(d) - lag(year(d) * 12 + month(d)) over (partition by id order by d), month(d)) as gap from s),
r as (select * from g where gap = 2 or d = (select max(d) from g x where x.gap <> 2 and x.id = g.id))
select id, (d - k * interval 1 month)::date::varchar as d, n from r, unnest(generate_series(0, greatest(gap, 1) - 1)) t(k)
""")
def monthly_converter(spark, sf_dir):
    """Orders of every customer by two months; those of every third customer come a month later from 1997 on, which leaves odd gaps; customers' series end in different months."""
    o = table(spark, sf_dir, "orders")
    late = F.when((F.col("o_custkey") % 3 == 1) & (F.year("o_orderdate") >= 1997), 1).otherwise(0)
    d = F.add_months(F.make_date(F.year("o_orderdate"), (2 * F.ceil(F.month("o_orderdate") / 2)).cast("int"), F.lit(20)), late)
    s = o.groupBy(F.col("o_custkey").alias("id"), d.alias("d")).agg(F.count("*").alias("n"))
    return timeseries.monthly_converter(s, "id", "d", "bi-monthly").withColumn("d", F.col("d").cast("string"))


@query("select p_partkey, case when p_retailprice > 1000 then 1.0::double else 0.0 end as dear, case when p_size > 25 then 1.0::double else 0.0 end as big from part")
def feat_binarizer(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("double"))
    return features.binarize(p, ["p_retailprice", "size"], ["dear", "big"], [1000, 25]).select("p_partkey", "dear", "big")


@query("select p_partkey, case when p_size < 10 then 0.0::double when p_size < 30 then 1.0 else 2.0 end as bucket from part")
def feat_bucketizer(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("double"))
    return features.bucketize(p, "size", "bucket", [0.0, 10.0, 30.0, 1000.0]).select("p_partkey", "bucket")


@query("select p_partkey, round(coalesce(case when p_partkey % 3 <> 0 then p_retailprice end, (select avg(p_retailprice) from part where p_partkey % 3 <> 0)), 4) as price from part")
def feat_imputer_mean(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice")).alias("holes"))
    return features.impute(p, "holes", "price", "mean").select("p_partkey", F.round("price", 4).alias("price"))


@query("""
with h as (select p_partkey, case when p_partkey % 3 <> 0 then p_retailprice end as holes from part)
select p_partkey, round(coalesce(holes, (select median(holes) from h)), 6) as price from h
""")
def feat_imputer_median(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice")).alias("holes"))
    return features.impute(p, "holes", "price", "median").select("p_partkey", F.round("price", 6).alias("price"))


@query("""
with h as (select p_partkey, case when p_partkey % 3 <> 0 then (p_size % 7)::double end as a, case when p_partkey % 5 <> 0 then (p_size % 4)::double end as b from part),
m as (select (select a from h where a is not null group by a order by count(*) desc, a limit 1) as ma, (select b from h where b is not null group by b order by count(*) desc, b limit 1) as mb)
select p_partkey, coalesce(a, ma) as a, coalesce(b, mb) as b from h, m
""")
def feat_imputer_mode(spark, sf_dir):
    """Two columns in one model; of equally frequent values the smallest."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, (F.col("p_size") % 7).cast("double")).alias("x"), F.when(F.col("p_partkey") % 5 != 0, (F.col("p_size") % 4).cast("double")).alias("y"))
    return features.impute(p, ["x", "y"], ["a", "b"], "mode").select("p_partkey", "a", "b")


@query("""
select s_suppkey, array_to_string([case when s_nationkey % 5 = i then 1 else 0 end for i in range(4)], ',') as regions from supplier
""")
def feat_one_hot(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") % 5).cast("double").alias("r"))
    coded = features.one_hot(s, "r", "v", fit_on=table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("double").alias("r")))
    return coded.select("s_suppkey", F.concat_ws(",", F.transform(vector_to_array("v"), lambda x: x.cast("int").cast("string"))).alias("regions"))


@query("""
with c as (select distinct (p_size % 4)::double as s, dense_rank() over (order by p_size % 4) - 1 as place from part)
select p_partkey, place::double as category, p_retailprice as price from part join c on (p_size % 4)::double = s
""")
def feat_vector_indexer(spark, sf_dir):
    """The first entry has four values and becomes their places in order (zero stays zero); the second has many and stays."""
    p = table(spark, sf_dir, "part").select("p_partkey", array_to_vector(F.array((F.col("p_size") % 4).cast("double"), "p_retailprice")).alias("v"))
    return features.vector_index(p, "v", "i", 4).select("p_partkey", vector_to_array("i")[0].alias("category"), vector_to_array("i")[1].alias("price"))


@query("select c_custkey, sha256(sha256(c_custkey || chr(1) || c_nationkey) || 'salt') as _id from customer")
def surrogate_id_256(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", privacy.surrogate_id(["c_custkey", "c_nationkey"], "salt", 256).alias("_id"))


@query("select c_custkey, sha256(coalesce(case when c_custkey % 3 <> 0 then c_name end, 'null') || 'salt') as c_name from customer")
def pseudonymize_256(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", privacy.pseudonymize(F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")), "salt", 256).alias("c_name"))


@query("select c_custkey, '****************' as c_name from customer")
def mask_asterisk(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", function("mask-asterisk")(F.col("c_name")).alias("c_name"))


@query("select c_custkey, c_mktsegment, c_name, c_acctbal::varchar as c_acctbal from customer")
def privacy_split_rejoin(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal"))
    split = privacy.split_sensitive(c, ["c_custkey"], ["c_name", "c_acctbal"], None, "salt", "run key", "master key")
    return privacy.rejoin(split, ["c_name", "c_acctbal"], "master key").drop("_id")


@query("select c_custkey, c_name as clear, false as same from customer")
def encrypt_roundtrip(spark, sf_dir):
    c = privacy.with_secrets(table(spark, sf_dir, "customer"), secret="secret").withColumn("e", privacy.encrypt("c_name", F.col("secret")))
    return c.select("c_custkey", privacy.decrypt("e", F.col("secret")).alias("clear"), (F.col("e") == F.col("c_name")).alias("same"))


LINES = DatasetSpec(
    "lines",
    (ColumnSpec("l_orderkey", LONG, primary_key=True), ColumnSpec("l_linenumber", INTEGER, primary_key=True), ColumnSpec("l_suppkey", LONG), ColumnSpec("l_quantity", DOUBLE), ColumnSpec("l_extendedprice", DOUBLE, transform="comma"), ColumnSpec("l_shipdate", DATE, timestamp=True)),
    load_mode="last_changes",
    validation_mode=PERMISSIVE,
    threshold=50,
    threshold_kind="percentage",
)


@query("""
with l as (select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate from lineitem where l_linenumber <> 3 and l_suppkey % 10 <> 0 and l_quantity < 45),
latest as (select * from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_suppkey desc, l_extendedprice desc, l_quantity desc) as n from l) where n = 1)
select c_mktsegment, year(l_shipdate)::int as y, count(l_orderkey) as n, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice), 0) as revenue
from latest join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey group by c_mktsegment, y
""")
def flagship_pipeline(spark, sf_dir):
    """lineitem as text: casts, rules, latest line of each key, then gold stages to revenue by segment and year."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    number = F.when(F.col("l_linenumber") == 3, "N/A").otherwise(F.col("l_quantity").cast("string"))
    text = l.select(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey").cast("string")).alias("l_suppkey"), number.alias("l_quantity"), F.translate(F.format_string("%.2f", "l_extendedprice"), ".", ",").alias("l_extendedprice"), F.date_format("l_shipdate", "dd-MM-yyyy").alias("l_shipdate"))
    batch = prepare(text, LINES)
    ruled = quality.passing(quality.apply_rules(batch.rows, [NotNull(("l_suppkey",)), Integrity(("l_suppkey",), table(spark, sf_dir, "supplier"), ("s_suppkey",)), Expression("l_quantity < 45")]))
    # dealt by order once: the window by line and the join by order both find their rows together
    latest = silver.latest_per_key(ruled.repartition("l_orderkey"), ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_suppkey", "l_extendedprice", "l_quantity"])
    stages = [
        gold.table_stage(table(spark, sf_dir, "orders"), "o", "inner", "current.l_orderkey = o.o_orderkey"),
        gold.table_stage(table(spark, sf_dir, "customer"), "c", "inner", "current.o_custkey = c.c_custkey"),
        gold.column_stage("y", "year(l_shipdate)"),
        gold.agg_stage(["c_mktsegment", "y"], [("n", "count", "l_orderkey"), ("quantity", "sum", "l_quantity"), ("revenue", "sum", "l_extendedprice")]),
        gold.column_stage("quantity", "round(quantity, 2)"),
        gold.column_stage("revenue", "round(revenue, 0)"),
    ]
    return gold.run_stages(latest, stages)
