"""Typed casts, structural checks, quality rules and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.casting import BAD, cast_split
from lakeops.operators import quality, validate
from lakeops.operators.quality import Expression, Integrity, NotNull, Unique
from lakeops.queries.scans import ORDER_FIELDS, read_order_lines
from lakeops.registry import query, table
from lakeops.scratch import scratch
from lakeops.sources import sinks
from lakeops.spec import ABSOLUTE, BOOLEAN, DATE, DATETIME, DECIMAL, DOUBLE, FAIL_FAST, FLOAT, INTEGER, LONG, PERCENTAGE, PERMISSIVE, REJECT, SHORT, WARNING, ColumnSpec


def text_lines(spark, sf_dir) -> DataFrame:
    """lineitem as text; quantities of line 3 are N/A, those of line 5 padded; tenth days of shipment are impossible dates."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    quantity = F.when(F.col("l_linenumber") == 3, "N/A").when(F.col("l_linenumber") == 5, F.concat(F.lit("  "), F.col("l_quantity").cast("long").cast("string"), F.lit(" "))).otherwise(F.col("l_quantity").cast("long").cast("string"))
    date = F.when(F.dayofmonth("l_shipdate") == 10, "31-02-2000").otherwise(F.date_format("l_shipdate", "dd-MM-yyyy"))
    return l.select(F.col("l_orderkey").cast("string").alias("l_orderkey"), F.col("l_linenumber").cast("string").alias("l_linenumber"), quantity.alias("l_quantity"), date.alias("l_shipdate"))


LINE = (ColumnSpec("l_orderkey", LONG), ColumnSpec("l_linenumber", INTEGER), ColumnSpec("l_quantity", INTEGER), ColumnSpec("l_shipdate", DATE))
BAD_LINE = "(l_linenumber = 3 or day(l_shipdate) = 10)"


@query(f"select l_orderkey, l_linenumber, l_quantity::int as l_quantity, l_shipdate::date::varchar as l_shipdate from lineitem where not {BAD_LINE}")
def cast_split_valid(spark, sf_dir):
    return cast_split(text_lines(spark, sf_dir), LINE).valid.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query(f"""
select l_orderkey, l_linenumber, case when l_linenumber <> 3 then l_quantity::int end as l_quantity, case when day(l_shipdate) <> 10 then l_shipdate::date::varchar end as l_shipdate,
  concat_ws(',', case when l_linenumber = 3 then 'l_quantity' end, case when day(l_shipdate) = 10 then 'l_shipdate' end) as bad
from lineitem where {BAD_LINE}
""")
def cast_split_invalid(spark, sf_dir):
    return cast_split(text_lines(spark, sf_dir), LINE).invalid.withColumns({"bad": F.concat_ws(",", BAD), "l_shipdate": F.col("l_shipdate").cast("string")}).drop(BAD)


@query("""
select o_orderkey as a_long, (o_custkey % 30000)::smallint as a_short, o_custkey::int as an_integer, o_totalprice as a_double, (o_orderkey % 100)::float as a_float, o_orderkey % 2 = 0 as a_boolean,
  case when o_orderkey % 10 = 0 then null else o_custkey::int end as sometimes
from orders
""")
def cast_numeric(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = o.select(F.concat(F.lit(" "), "o_orderkey").alias("a_long"), (F.col("o_custkey") % 30000).cast("string").alias("a_short"), F.col("o_custkey").cast("string").alias("an_integer"), F.col("o_totalprice").cast("string").alias("a_double"),
                    (F.col("o_orderkey") % 100).cast("string").alias("a_float"), F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("false").alias("a_boolean"), F.when(F.col("o_orderkey") % 10 == 0, F.concat("o_custkey", F.lit("x"))).otherwise(F.col("o_custkey").cast("string")).alias("sometimes"))
    kinds = {"a_long": LONG, "a_short": SHORT, "an_integer": INTEGER, "a_double": DOUBLE, "a_float": FLOAT, "a_boolean": BOOLEAN, "sometimes": INTEGER}
    return cast_split(text, tuple(ColumnSpec(n, k) for n, k in kinds.items())).flagged.drop(BAD)


@query("select o_orderkey, o_totalprice::decimal(12, 2)::varchar as price from orders")
def cast_decimal(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.format_string("%.2f", "o_totalprice").alias("price"))
    return cast_split(o, (ColumnSpec("o_orderkey", LONG), ColumnSpec("price", DECIMAL, precision=12, scale=2))).valid.withColumn("price", F.col("price").cast("string"))


@query("select o_orderkey, case when o_orderkey % 5 = 0 then date '1900-01-01' + ((month(o_orderdate) - 1)::int * interval 1 month) else o_orderdate end::date::varchar as d from orders")
def cast_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("01-"), F.date_format("o_orderdate", "MM"), F.lit("-0001"))).otherwise(F.concat(F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" 23:59:59")))
    return cast_split(o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), text.alias("d")), (ColumnSpec("o_orderkey", LONG), ColumnSpec("d", DATE, lenient=True))).valid.withColumn("d", F.col("d").cast("string"))


@query("select event_id, case when event_id % 4 = 0 then make_timestamp(1900, month(ts), day(ts), 1, 2, 3.0) else date_trunc('second', ts) end as t from events")
def cast_timestamp(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("1753-"), F.date_format("ts", "MM-dd"), F.lit(" 01:02:03"))).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return cast_split(e.select(F.col("event_id").cast("string").alias("event_id"), text.alias("t")), (ColumnSpec("event_id", LONG), ColumnSpec("t", DATETIME))).valid


@query("select event_id, ts as t from events")
def cast_timestamp_micros(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"))
    return cast_split(e, (ColumnSpec("event_id", LONG), ColumnSpec("t", DATETIME, pattern="yyyy-MM-dd HH:mm:ss.SSSSSS"))).valid


def _prices(spark, sf_dir, transform: str) -> DataFrame:
    english = F.format_number("o_totalprice", 2)
    text = english if transform == "comma-eng" else F.translate(english, ",.", ".,")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), text.alias("price"))
    return cast_split(o, (ColumnSpec("o_orderkey", LONG), ColumnSpec("price", DOUBLE, transform=transform))).valid


@query("select o_orderkey, round(o_totalprice, 2) as price from orders")
def normalize_comma(spark, sf_dir):
    return _prices(spark, sf_dir, "comma")


@query("select o_orderkey, round(o_totalprice, 2) as price from orders")
def normalize_comma_eng(spark, sf_dir):
    return _prices(spark, sf_dir, "comma-eng")


WRONG_LINE = "(o_orderkey % 50 = 0 or o_orderkey % 70 = 0)"


@query(f"""
select 'valid' as side, concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) as line from orders where not {WRONG_LINE}
union all
select 'wrong', case when o_orderkey % 50 = 0 then concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'extra') else concat_ws(',', o_orderkey, o_custkey) end from orders where {WRONG_LINE}
""")
def structural_split(spark, sf_dir):
    split = validate.structural_split(read_order_lines(spark, sf_dir))
    valid = split.valid.select(F.lit("valid").alias("side"), F.concat_ws(",", *ORDER_FIELDS.names).alias("line"))
    return valid.unionByName(split.wrong.select(F.lit("wrong").alias("side"), F.col(validate.CORRUPT).alias("line")))


@query(f"""
with c as (select count(*) filter (not {WRONG_LINE}) as valid, count(*) filter ({WRONG_LINE}) as wrong from orders),
m(rule, mode, threshold, kind) as (values ('strict', 'fail_fast', 0, 'absolute'), ('ten', 'permissive', 10, 'absolute'), ('five percent', 'permissive', 5, 'percentage'), ('three percent', 'permissive', 3, 'percentage'))
select rule, valid, wrong, valid > 0 and (wrong = 0 or mode = 'permissive' and case when kind = 'absolute' then wrong <= threshold else 100.0 * wrong / (valid + wrong) <= threshold end) as accepted from c, m
""")
def accept_decision(spark, sf_dir):
    lines = read_order_lines(spark, sf_dir)
    wrong = validate.is_wrong(lines)
    counts = lines.agg(F.count_if(~wrong).alias("valid"), F.count_if(wrong).alias("wrong"))
    modes = [("strict", FAIL_FAST, 0, ABSOLUTE), ("ten", PERMISSIVE, 10, ABSOLUTE), ("five percent", PERMISSIVE, 5, PERCENTAGE), ("three percent", PERMISSIVE, 3, PERCENTAGE)]
    rows = [validate.accept(counts.select(F.lit(name).alias("rule"), "*"), mode, threshold, kind) for name, mode, threshold, kind in modes]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def dirty_orders(spark, sf_dir) -> DataFrame:
    """Orders where every seventh customer is null and every eleventh unknown."""
    key = F.col("o_custkey")
    return table(spark, sf_dir, "orders").withColumn("o_custkey", F.when(key % 7 == 0, None).when(key % 11 == 0, -key).otherwise(key))


DIRTY = "(select * replace (case when o_custkey % 7 = 0 then null when o_custkey % 11 = 0 then -o_custkey else o_custkey end as o_custkey) from orders)"
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_quantity")
ORDERED = ", ".join(LINE_ORDER)


@query(f"""
select l_orderkey, l_linenumber, l_partkey, l_extendedprice from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by {ORDERED}) as n from lineitem) where n > 1
""")
def quality_unique(spark, sf_dir):
    flagged = quality.apply_rules(table(spark, sf_dir, "lineitem"), [Unique(("l_orderkey", "l_linenumber"), LINE_ORDER)])
    return quality.failing(flagged).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(f"select o_orderkey from {DIRTY} where o_custkey is null or o_orderstatus is null")
def quality_not_null(spark, sf_dir):
    return quality.failing(quality.apply_rules(dirty_orders(spark, sf_dir), [NotNull(("o_custkey", "o_orderstatus"))])).select("o_orderkey")


@query(f"select o_orderkey, o_custkey from {DIRTY} o where not exists (select 1 from customer where c_custkey = o_custkey)")
def quality_integrity(spark, sf_dir):
    rule = Integrity(("o_custkey",), table(spark, sf_dir, "customer"), ("c_custkey",))
    return quality.failing(quality.apply_rules(dirty_orders(spark, sf_dir), [rule])).select("o_orderkey", "o_custkey")


@query(f"select o_orderkey from {DIRTY} where not coalesce(o_custkey > 100 and o_totalprice < 400000, false)")
def quality_expression(spark, sf_dir):
    return quality.failing(quality.apply_rules(dirty_orders(spark, sf_dir), [Expression("o_custkey > 100 and o_totalprice < 400000")])).select("o_orderkey")


def all_rules(spark, sf_dir) -> list:
    return [Unique(("o_custkey", "o_orderstatus"), ("o_orderkey",)), NotNull(("o_custkey",)), Integrity(("o_custkey",), table(spark, sf_dir, "customer"), ("c_custkey",)), Expression("o_totalprice < 400000")]


FLAGGED = f"""
with f as (
  select o_orderkey, row_number() over (partition by o_custkey, o_orderstatus order by o_orderkey) > 1 as f1, o_custkey is null as f2,
    not exists (select 1 from customer where c_custkey = o_custkey) as f3, not coalesce(o_totalprice < 400000, false) as f4
  from {DIRTY} o)
"""


@query(FLAGGED + "select o_orderkey, concat_ws(',', case when f1 then 'unique' end, case when f2 then 'not_null' end, case when f3 then 'integrity' end, case when f4 then 'expression' end) as failed from f")
def quality_all_rules(spark, sf_dir):
    return quality.apply_rules(dirty_orders(spark, sf_dir), all_rules(spark, sf_dir)).select("o_orderkey", F.concat_ws(",", quality.FAILED).alias("failed"))


@query(FLAGGED + "select r as rule, count(*) as failures from (select unnest([case when f1 then 'unique' end, case when f2 then 'not_null' end, case when f3 then 'integrity' end, case when f4 then 'expression' end]) as r from f) where r is not null group by r")
def quality_report(spark, sf_dir):
    return quality.report(quality.apply_rules(dirty_orders(spark, sf_dir), all_rules(spark, sf_dir)))


@query(FLAGGED + """
, c as (select count(*) as total, count(*) filter (f1 or f2 or f3 or f4) as failed from f)
select m.mode, total, failed, case when m.mode = 'reject' then 100.0 * failed / total <= 50 else true end as passed from c, (values ('warning'), ('reject')) m(mode)
""")
def quality_mode_gate(spark, sf_dir):
    counts = quality.counts(quality.apply_rules(dirty_orders(spark, sf_dir), all_rules(spark, sf_dir))).drop("passed_rows")
    both = [validate.gate(counts.withColumn("mode", F.lit(m)), PERMISSIVE, 50, PERCENTAGE, m) for m in (WARNING, REJECT)]
    return both[0].unionByName(both[1]).select("mode", "total", "failed", "passed")


@query(f"""
with c as (select count(*) as total, count(*) filter ({BAD_LINE}) as invalid from lineitem)
select total, invalid, false as strict, invalid <= 100 as few, 100.0 * invalid / total <= 20 as share from c
""")
def validation_gate(spark, sf_dir):
    flagged = cast_split(text_lines(spark, sf_dir), LINE).flagged
    counts = flagged.agg(F.count("*").alias("total"), F.count_if(F.size(BAD) > 0).alias("invalid")).withColumn("failed", F.lit(0))
    out = validate.gate(counts, FAIL_FAST).withColumnRenamed("passed", "strict")
    out = validate.gate(out, PERMISSIVE, 100, ABSOLUTE).withColumnRenamed("passed", "few")
    return validate.gate(out, PERMISSIVE, 20, PERCENTAGE).withColumnRenamed("passed", "share").drop("failed")


@query(f"""
select count(*) as total, count(*) filter ({BAD_LINE}) as invalid, count(*) filter (not {BAD_LINE} and l_quantity >= 40) as failed, count(*) filter (not {BAD_LINE} and l_quantity < 40) as passed_rows,
  'INGESTED_WITH_ERRORS' as outcome
from lineitem
""")
def ingest_row_counts(spark, sf_dir):
    flagged = quality.apply_rules(cast_split(text_lines(spark, sf_dir), LINE).flagged, [Expression("l_quantity < 40")])
    counts = quality.counts(flagged, BAD)
    return counts.withColumn("outcome", validate.outcome(F.col("total") > 0, F.col("invalid") < F.col("total"), F.col("invalid") + F.col("failed")))


@query(f"""
select 'invalid' as reason, count(*) as n, sum(l_orderkey)::bigint as keys from lineitem where {BAD_LINE}
union all select 'structure', count(*), sum(o_orderkey)::bigint from orders where {WRONG_LINE}
""")
def reject_split(spark, sf_dir):
    base = scratch(spark, "rejects")
    invalid = sinks.write_rejects(cast_split(text_lines(spark, sf_dir), LINE).invalid, base, "invalid")
    wrong = sinks.write_rejects(validate.structural_split(read_order_lines(spark, sf_dir)).wrong, base, "structure", "text")
    a = spark.read.csv(invalid, header=True).agg(F.lit("invalid").alias("reason"), F.count("*").alias("n"), F.sum(F.col("l_orderkey").cast("long")).alias("keys"))
    b = spark.read.text(wrong).agg(F.lit("structure").alias("reason"), F.count("*").alias("n"), F.sum(F.split("value", ",")[0].cast("long")).alias("keys"))
    return a.unionByName(b)


@query(f"select count(*) as left_rows, count(*) filter (not {BAD_LINE}) as right_rows, count(*) filter ({BAD_LINE}) as only_left, 0::bigint as only_right, false as same from lineitem")
def same_rows_check(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return validate.same_rows(l, l.where("not (l_linenumber = 3 or day(l_shipdate) = 10)"))
