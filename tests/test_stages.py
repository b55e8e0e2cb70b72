import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from lakeops.operators import features, gold, partitions, timeseries


def test_joins_qualify_both_sides_and_a_stage_without_join_replaces(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"), spark.createDataFrame([(1, "z")], "id int, w string")
    got = gold.run_stages(a, [gold.table_stage(b, "b", "leftouter", "current.id = b.id"), gold.filter_stage("w is null"), gold.select_stage([("v", "kept")])])
    assert [r.kept for r in got.collect()] == ["y"]
    assert gold.run_stages(a, [gold.table_stage(b, "b")]).columns == ["id", "w"]
    with pytest.raises(ValueError):
        gold.table_stage(b, "b", "sideways")
    with pytest.raises(ValueError):
        gold.source(spark, "other", "x")


def test_parameters_do_not_hide_columns_and_go_at_the_end(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "p int, x int")
    got = gold.run_stages(df, gold.with_params([gold.filter_stage("x <= limit and p = 1")], {"limit": 5, "p": 9}))
    assert got.columns == ["x"] and got.count() == 1


def test_modifiers_cache_and_views_end_with_the_scope(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    with gold.scope(spark, ("stage_view",)) as cached:
        got = gold.stage(gold.column_stage("c", "a + 1"), drop=["b"], distinct=True, view="stage_view", cache=cached)(df)
        assert got.count() == 1 and spark.table("stage_view").count() == 1 and got.is_cached
    assert not got.is_cached and not spark.catalog.tableExists("stage_view")


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("a", 2, 2)], "k string, v int, t int")
    got = gold.agg_stage(["k"], [("f", "first", "v", "t"), ("l", "last", "v", "t"), ("d", "sumDistinct", "v"), ("n", "countDistinct", "v")])(df).first()
    assert (got.f, got.l, got.d, got.n) == (2, 1, 3, 2)
    assert gold.agg_stage([], [("m", "max", "v")])(df).first().m == 2
    for bad in (("x", "first", "v"), ("x", "median", "v")):
        with pytest.raises(ValueError):
            gold.agg_stage([], [bad])(df)


def test_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "b boolean, i int, l long, d double, s string")
    got = gold.run_stages(df, [gold.fill_stage(True), gold.fill_stage(25, ["i"]), gold.fill_stage(500, ["l"]), gold.fill_stage(2.5), gold.fill_stage("reemplazo")]).first()
    assert tuple(got) == (True, 25, 500, 2.5, "reemplazo")


def test_write_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "b")], "x int, p string, q string")
    path = str(tmp_path / "t")
    gold.write_table(df, "append", path, partition_by="p/q")
    gold.write_table(df, "append", path, partition_by="p/q")
    assert spark.read.parquet(path).count() == 2
    gold.write_table(df, "overwrite", path)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        gold.write_table(df, "sideways", path)


def test_monthly_converter_gives_the_missing_months(spark):
    days = [(1, dt.date(2020, 7, 15)), (1, dt.date(2020, 6, 20)), (1, dt.date(2020, 9, 25))]
    got = timeseries.monthly_converter(spark.createDataFrame(days, "id int, d date"), "id", "d", "bi-monthly", ordered=True)
    assert [r.d for r in got.collect()] == [dt.date(2020, 7, 15), dt.date(2020, 8, 25), dt.date(2020, 9, 25)]
    on = spark.createDataFrame([(1, dt.date(2020, 2, 1)), (1, dt.date(2020, 4, 1))], "id int, d date")
    assert timeseries.monthly_converter(on, "id", "d", "bi-monthly").count() == 4
    several = spark.createDataFrame([("u", dt.date(2020, m, 1)) for m in (2, 4, 5)] + [("v", dt.date(2020, m, 1)) for m in (2, 3)] + [("w", dt.date(2020, 2, 1))], "id string, d date")
    got = timeseries.monthly_converter(several, "id", "d", "bi-monthly").collect()
    assert sorted((r.id, r.d.month) for r in got) == [("u", 1), ("u", 2), ("u", 3), ("u", 4), ("u", 5), ("v", 1), ("v", 2), ("v", 3), ("w", 1), ("w", 2)]
    odd = spark.createDataFrame([(1, dt.date(2020, m, 10)) for m in (1, 3, 6)], "id int, d date")
    assert [r.d.month for r in timeseries.monthly_converter(odd, "id", "d", "bi-monthly", ordered=True).collect()] == [2, 3, 4, 5, 6]


@pytest.mark.parametrize("ranges,periods,carried", [(1, 2, 1000), (3, 2, 1000), (7, 1, 1000), (20, 30, 1000), (7, 2, 1), (None, 5, 1000)])
def test_global_variation_equals_one_window(spark, ranges, periods, carried, monkeypatch):
    """Also with ranges of fewer rows than periods, with null times, and by row numbers beyond what is carried."""
    from pyspark.sql import Window

    monkeypatch.setattr(timeseries, "MOST_CARRIED", carried)
    df = spark.createDataFrame([(i * 7 % 101 if i % 20 else None, i, float(i % 5) if i % 11 else None) for i in range(100)], "t int, i int, x double").repartition(3)
    before = F.coalesce(F.lag("x", periods).over(Window.orderBy("t", "i")), F.lit(0.0))
    want = df.withColumn("v", F.when(before == 0, 0.0).otherwise(F.col("x") - before))
    got = timeseries.variation(df, "x", "t", "v", periods, ranges=ranges, ties=["i"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert timeseries.variation(df.where("i < 0"), "x", "t", "v", periods, ranges=ranges, ties=["i"]).count() == 0


def test_global_order_moves_rows_once(spark):
    df = spark.range(1000).selectExpr("id as t", "id % 7 as x")
    for got in (timeseries.variation(df, "x", "t", "v", 3), timeseries.global_row_number(df, ["t"], "n")):
        plan = got._jdf.queryExecution().executedPlan().toString()
        main = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "_range" in line]
        assert len(main) <= 2 and "SortMergeJoin" not in plan and "SinglePartition" not in plan.replace("Exchange SinglePartition, ENSURE_REQUIREMENTS", "", 1), plan
    assert sorted(r.n for r in timeseries.global_row_number(df, ["t"], "n").collect()) == list(range(1, 1001))


def test_percentages_of_the_current_or_previous_value(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 0.0)], "t int, x double").withColumn("k", F.lit(1))
    values = {b: [r.v for r in timeseries.variation(df, "x", "t", "v", 1, ["k"], True, b).orderBy("t").collect()] for b in ("current", "previous")}
    assert values == {"current": [0.0, 50.0, None], "previous": [0.0, 100.0, -100.0]}


@pytest.mark.parametrize("few", [1, 3, 1000])
@pytest.mark.parametrize(
    "values",
    [[], [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [1.0, 1.0, 1.0, 9.0], [float(i * i % 97) for i in range(200)], [1e300, -1e300, 1e-300, 0.0, 7.0, 7.0], [float("inf"), 1.0, 2.0, 3.0], [float("-inf")] * 3 + [1.0] * 3, [1.7e308, -1.7e308] * 4 + [2.0]],
)
def test_exact_median(spark, values, few):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    got = features.median(df, "x", few, 4)
    assert got == (statistics.median(values) if values else None)


def test_medians_fill_holes(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), None), (4.0, 3.0), (6.0, None)], "x double, y double")
    assert [tuple(r) for r in features.impute(df, ["x", "y"], ["a", "b"], "median").select("a", "b").collect()] == [(5.0, 1.0), (5.0, 2.0), (4.0, 3.0), (6.0, 2.0)]


def test_appends_with_new_columns_need_leave(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2, "x")], "k int, v string")
    spark.sql("CREATE DATABASE IF NOT EXISTS merged")
    for where in ({"path": path}, {"name": "merged.t"}):
        gold.write_table(a, "append", **where)
        with pytest.raises(ValueError, match="lacks: v"):
            gold.write_table(b, "append", **where)
        gold.write_table(b, "append", merge_schema=True, **where)
        gold.write_table(a, "append", **where)
        got = spark.read.option("mergeSchema", "true").parquet(path) if "path" in where else spark.table("merged.t")
        assert sorted((r.k, r.v or "") for r in got.collect()) == [(1, ""), (1, ""), (2, "x")]
    spark.sql("DROP DATABASE merged CASCADE")


def test_features_fit_on_another_frame(spark):
    df, fit = spark.createDataFrame([(None, 1.0), (4.0, 0.0)], "x double, c double"), spark.createDataFrame([(8.0, 2.0), (10.0, 0.0)], "x double, c double")
    assert [r.y for r in features.impute(df, "x", "y", "mean", fit).collect()] == [9.0, 4.0]
    assert [list(r.v.toArray()) for r in features.one_hot(df, "c", "v", fit).collect()] == [[0.0, 1.0], [1.0, 0.0]]
    assert [r.b for r in features.binarize(df.na.fill(0), "x", "b", 3).collect()] == [0.0, 1.0]
    with pytest.raises(Exception):
        features.bucketize(fit, "x", "b", [0.0, 5.0]).collect()


def test_file_names(spark):
    pattern = "<yyyy><mm><dd>_a+b.<x>csv"
    df = spark.createDataFrame([("20200102_a+b.7csv",), ("20200102_aab.7csv",), ("2020_a+b.7csv",)], "f string")
    assert [r.m for r in df.select(partitions.matches_pattern(F.col("f"), pattern).alias("m")).collect()] == [True, False, False]
    one, names = partitions.add(df.limit(1), F.col("f"), pattern)
    assert names == ["yyyy", "mm", "dd", "x"] and tuple(one.select(*names).first()) == ("2020", "01", "02", "7")
    _, names = partitions.add(df, loaded=dt.datetime(2020, 1, 2, 3))
    assert names == ["load_yyyy", "load_mm", "load_dd", "load_hh"]
    with pytest.raises(ValueError):
        partitions.add(df)
