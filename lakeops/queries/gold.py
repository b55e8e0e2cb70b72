"""Transformation stages, joins, aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import gold
from lakeops.queries.casts import DIRTY, dirty_orders
from lakeops.registry import query, table
from lakeops.scratch import scratch


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders")


@query("select n_nationkey, n_name from nation")
def gold_table_scan(spark, sf_dir):
    path = scratch(spark, "gold")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.parquet(path)
    table(spark, sf_dir, "region").createOrReplaceTempView("gold_scan_region")
    first = gold.table_stage(gold.source(spark, "table", "gold_scan_region"), "region")
    return gold.run_stages(None, [first, gold.table_stage(gold.source(spark, "path", path), "nation")])


@query("select n_regionkey, count(*) as nations from nation group by n_regionkey")
def gold_sql_stage(spark, sf_dir):
    view = gold.stage(gold.select_stage(["n_nationkey", "n_regionkey"]), view="gold_sql_nation")
    view(table(spark, sf_dir, "nation"))
    return gold.source(spark, "sql", "select n_regionkey, count(*) as nations from gold_sql_nation group by n_regionkey")


@query("select c_custkey as id, c_name as customer, c_acctbal from customer")
def gold_select_alias(spark, sf_dir):
    return gold.run_stages(table(spark, sf_dir, "customer"), [gold.select_stage([("c_custkey", "id"), ("c_name", "customer"), "c_acctbal"])])


@query("select o_orderkey, floor(o_totalprice / 100)::bigint as net, case when o_orderstatus = 'F' then 'done' else 'open' end as state from orders")
def gold_calculated_column(spark, sf_dir):
    stages = [gold.column_stage("net", "floor(o_totalprice / 100)"), gold.column_stage("state", "case when o_orderstatus = 'F' then 'done' else 'open' end"), gold.select_stage(["o_orderkey", "net", "state"])]
    return gold.run_stages(orders(spark, sf_dir), stages)


@query("select * from orders where o_orderstatus = 'O' and o_totalprice between 1000 and 200000")
def gold_filter(spark, sf_dir):
    return gold.run_stages(orders(spark, sf_dir), [gold.filter_stage("o_orderstatus = 'O' and o_totalprice between 1000 and 200000")])


@query("select distinct o_orderstatus, o_orderpriority, year(o_orderdate)::int as y from orders")
def gold_drop_distinct(spark, sf_dir):
    step = gold.stage(gold.column_stage("y", "year(o_orderdate)"), drop=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], distinct=True)
    return gold.run_stages(orders(spark, sf_dir), [step])


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'P' and o_totalprice <= 150000")
def gold_param_filter(spark, sf_dir):
    stages = [gold.filter_stage("o_totalprice <= paramMost"), gold.filter_stage("o_orderstatus = paramState"), gold.select_stage(["o_orderkey", "o_totalprice"])]
    return gold.run_stages(orders(spark, sf_dir), gold.with_params(stages, {"paramMost": 150000, "paramState": "P"}))


@query("""
select 'append' as mode, o_orderkey from orders
union all select 'overwrite', o_orderkey from orders where year(o_orderdate) >= 1995
union all select 'truncate', o_orderkey from orders where year(o_orderdate) >= 1995
union all select 'view', o_orderkey from orders
""")
def gold_write_modes(spark, sf_dir):
    """Two batches that make up the table; the modes that replace keep the second."""
    o, out = orders(spark, sf_dir).select("o_orderkey", F.year("o_orderdate").alias("y"), "o_orderstatus"), None
    for mode in ("append", "overwrite", "truncate"):
        path = scratch(spark, mode)
        for batch in ("y < 1995", "y >= 1995"):
            gold.write_table(o.where(batch), mode, path, partition_by="y/o_orderstatus")
        part = spark.read.parquet(path).select(F.lit(mode).alias("mode"), "o_orderkey")
        out = part if out is None else out.unionByName(part)
    gold.write_table(o, "view", name="gold_view_orders")
    return out.unionByName(spark.table("gold_view_orders").select(F.lit("view").alias("mode"), "o_orderkey"))


@query("""
select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderdate < timestamp '1998-01-01'
union all select o_orderkey, o_totalprice, null from orders where o_orderdate >= timestamp '1998-01-01'
""")
def gold_lambda_union(spark, sf_dir):
    o = orders(spark, sf_dir)
    cold, hot = o.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"), o.select("o_orderkey", "o_totalprice", "o_orderdate")
    return gold.run_stages(cold, [gold.lambda_stage(hot, "o_orderdate >= timestamp '1998-01-01'", "o_orderdate < timestamp '1998-01-01'")]).drop("o_orderdate")


HOLES = """(select o_orderkey, case when o_orderkey % 3 = 0 then null else o_custkey end as o_custkey, case when o_orderkey % 4 = 0 then null else o_totalprice end as o_totalprice,
  case when o_orderkey % 5 = 0 then null else o_orderstatus end as o_orderstatus, case when o_orderkey % 6 = 0 then null else o_orderkey % 2 = 0 end as even from orders)"""


@query(f"select o_orderkey, coalesce(o_custkey, 25) as o_custkey, coalesce(o_totalprice, 2.5) as o_totalprice, coalesce(o_orderstatus, 'none') as o_orderstatus, coalesce(even, true) as even from {HOLES}")
def fill_nulls(spark, sf_dir):
    o = orders(spark, sf_dir)
    key = F.col("o_orderkey")
    holes = o.select(key, F.when(key % 3 != 0, F.col("o_custkey")).alias("o_custkey"), F.when(key % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"), F.when(key % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), F.when(key % 6 != 0, key % 2 == 0).alias("even"))
    return gold.run_stages(holes, [gold.fill_stage(25, ["o_custkey"]), gold.fill_stage(2.5, ["o_totalprice"]), gold.fill_stage("none"), gold.fill_stage(True)])


@query(f"select o_custkey from {DIRTY} union select c_custkey from customer")
def set_union_distinct(spark, sf_dir):
    return dirty_orders(spark, sf_dir).select("o_custkey").union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()


@query(f"select o_custkey from {DIRTY} except all select c_custkey from customer")
def set_except(spark, sf_dir):
    return dirty_orders(spark, sf_dir).select("o_custkey").exceptAll(table(spark, sf_dir, "customer").select("c_custkey"))


def joined(spark, sf_dir, kind: str, condition: str = "current.c_custkey = o.o_custkey") -> DataFrame:
    """Customers and orders, some of them without a customer or with an unknown one."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = dirty_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return gold.run_stages(c, [gold.table_stage(o, "o", kind, condition)])


SIDES = f"(select c_custkey, c_nationkey from customer) c {{}} (select o_orderkey, o_custkey, o_totalprice from {DIRTY}) o on c_custkey = o_custkey"


@query("select * from " + SIDES.format("join"))
def gold_join_inner(spark, sf_dir):
    return joined(spark, sf_dir, "inner")


@query("select * from " + SIDES.format("left join"))
def gold_join_left(spark, sf_dir):
    return joined(spark, sf_dir, "leftouter")


@query("select * from " + SIDES.format("right join"))
def gold_join_right(spark, sf_dir):
    return joined(spark, sf_dir, "rightouter")


@query("select * from " + SIDES.format("full join"))
def gold_join_full(spark, sf_dir):
    return joined(spark, sf_dir, "fullouter")


@query("select * from " + SIDES.format("semi join"))
def gold_join_semi(spark, sf_dir):
    return joined(spark, sf_dir, "leftsemi")


@query("select * from " + SIDES.format("anti join"))
def gold_join_anti(spark, sf_dir):
    return joined(spark, sf_dir, "leftanti")


@query("select n_name, r_name from nation cross join region where n_regionkey <> r_regionkey")
def gold_join_cross(spark, sf_dir):
    stages = [gold.table_stage(table(spark, sf_dir, "region"), "r", "cross", "current.n_regionkey <> r.r_regionkey"), gold.select_stage(["n_name", "r_name"])]
    return gold.run_stages(table(spark, sf_dir, "nation"), stages)


@query("select s_suppkey, n_name from supplier join nation on s_nationkey < n_nationkey and s_nationkey + 3 >= n_nationkey")
def gold_join_theta(spark, sf_dir):
    stages = [gold.table_stage(table(spark, sf_dir, "nation"), "n", "inner", "current.s_nationkey < n.n_nationkey and current.s_nationkey + 3 >= n.n_nationkey"), gold.select_stage(["s_suppkey", "n_name"])]
    return gold.run_stages(table(spark, sf_dir, "supplier"), stages)


def lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


@query("""
select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, count(l_quantity) as n, min(l_extendedprice) as low, max(l_extendedprice) as high, round(avg(l_discount), 6) as mean_discount
from lineitem group by l_returnflag, l_linestatus
""")
def agg_basic(spark, sf_dir):
    kinds = [("sum_qty", "sum", "l_quantity"), ("n", "count", "l_quantity"), ("low", "min", "l_extendedprice"), ("high", "max", "l_extendedprice"), ("mean_discount", "mean", "l_discount")]
    return gold.run_stages(lines(spark, sf_dir), [gold.agg_stage(["l_returnflag", "l_linestatus"], kinds), gold.column_stage("mean_discount", "round(mean_discount, 6)")])


@query("select l_returnflag, sum(distinct l_linenumber)::bigint as numbers, count(distinct l_suppkey) as suppliers from lineitem group by l_returnflag")
def agg_distinct(spark, sf_dir):
    return gold.run_stages(lines(spark, sf_dir), [gold.agg_stage(["l_returnflag"], [("numbers", "sumDistinct", "l_linenumber"), ("suppliers", "countDistinct", "l_suppkey")])])


@query("select o_custkey, arg_min(o_totalprice, o_orderkey) as first_price, arg_max(o_totalprice, o_orderkey) as last_price from orders group by o_custkey")
def agg_first_last(spark, sf_dir):
    return gold.run_stages(orders(spark, sf_dir), [gold.agg_stage(["o_custkey"], [("first_price", "first", "o_totalprice", "o_orderkey"), ("last_price", "last", "o_totalprice", "o_orderkey")])])


@query("select l_linenumber, round(stddev_samp(l_quantity), 6) as s, round(stddev_pop(l_quantity), 6) as p from lineitem group by l_linenumber")
def agg_stddev(spark, sf_dir):
    stages = [gold.agg_stage(["l_linenumber"], [("s", "stddev_samp", "l_quantity"), ("p", "stddev_pop", "l_quantity")]), gold.column_stage("s", "round(s, 6)"), gold.column_stage("p", "round(p, 6)")]
    return gold.run_stages(lines(spark, sf_dir), stages)


@query("select count(l_orderkey) as n, max(l_shipdate) as latest, round(avg(l_quantity), 6) as mean_qty from lineitem")
def agg_global(spark, sf_dir):
    stages = [gold.agg_stage([], [("n", "count", "l_orderkey"), ("latest", "max", "l_shipdate"), ("mean_qty", "avg", "l_quantity")]), gold.column_stage("mean_qty", "round(mean_qty, 6)")]
    return gold.run_stages(lines(spark, sf_dir), stages)
