import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import quality, validate
from lakeops.operators.quality import Expression, Integrity, NotNull, Unique

PEOPLE = "Salarios int, Edad int, Pais string"


def passing(spark, rows, rules):
    flagged = quality.apply_rules(spark.createDataFrame(rows, PEOPLE), rules)
    assert flagged.count() == len(rows)
    return {r.Pais for r in quality.passing(flagged).collect()}, flagged


def test_not_null(spark):
    ok, _ = passing(spark, [(4000, 50, "ES"), (4000, 50, "AR"), (4000, 50, "PE"), (300, 30, "MX"), (None, 70, "CO")], [NotNull(("Salarios", "Edad"))])
    assert ok == {"ES", "AR", "PE", "MX"}


def test_unique_rules_keep_the_first(spark):
    rows = [(4000, 50, "ES"), (4000, 50, "AR"), (4000, 50, "PE"), (300, None, "MX"), (None, 70, "CO")]
    flagged = quality.apply_rules(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + PEOPLE), [Unique(("Salarios", "Edad"), ("i",)), Unique(("Pais",), ("i",))])
    assert {r.Pais for r in quality.passing(flagged).collect()} == {"ES", "MX", "CO"}


@pytest.mark.parametrize("hot", [0.0, 0.5, 0.97])
def test_hot_keys_are_spread_and_rows_are_the_same(spark, hot):
    n = 8000
    df = spark.range(n).select(F.when(F.col("id") < n * hot, F.lit(None)).otherwise(F.col("id") % 3000).alias("k"), F.lit("x").alias("j"), (F.col("id") * 7919 % 101).cast("int").alias("t"), F.col("id").alias("v")).repartition(4)
    df = df.unionByName(df.where("v % 1000 = 1"))  # some rows twice
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        flagged = quality.apply_rules(df, [Unique(("k", "j"), ("t",))])
        sizes = [r[1] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2] and len(sizes) == 8, sizes
        got = sorted((r.k is None, r.k or 0, r.t, r.v) for r in quality.passing(flagged).collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    row = F.xxhash64("k", "j", "t", "v")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k", "j").orderBy("t", row))).where("n = 1").collect()
    assert got == sorted((r.k is None, r.k or 0, r.t, r.v) for r in want)


def test_copies_of_one_row_keep_one(spark):
    df = spark.createDataFrame([(None, None, float("nan"))] * 50 + [(1, None, 1.0)] * 50, "k int, t timestamp, x double")
    assert quality.passing(quality.apply_rules(df, [Unique(("k",), ("t", "x"))])).count() == 2
    assert quality.passing(quality.apply_rules(df.where("k > 1"), [Unique(("k",))])).count() == 0


def test_integrity_and_expression_with_nulls(spark):
    reference = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "name string, id int")
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1)], "n string, k int")
    flagged = quality.apply_rules(df, [Integrity(("n", "k"), reference, ("name", "id")), Expression("k > 1", "large")])
    assert sorted((r.n or "", r.k, ",".join(r[quality.FAILED])) for r in flagged.collect()) == [("", 1, "integrity,large"), ("a", 1, "large"), ("b", 1, "integrity,large"), ("b", 2, "")]
    assert {(r.rule, r.failures) for r in quality.report(flagged).collect()} == {("integrity", 2), ("large", 3)}
    assert quality.passing(quality.apply_rules(df, [Expression("k > null")])).count() == 0
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert quality.passing(quality.apply_rules(nan, [NotNull(("x",), nan_is_null=True)])).count() == 1
    assert quality.passing(quality.apply_rules(df, [])).count() == 4


def test_thresholds_gates_and_outcomes(spark):
    counts = spark.createDataFrame([(10, 0), (9, 1), (0, 3), (0, 0)], "valid long, wrong long")
    assert [r.accepted for r in validate.accept(counts, "fail_fast").collect()] == [True, False, False, False]
    assert [r.accepted for r in validate.accept(counts, "permissive", 10, "percentage").collect()] == [True, True, False, False]
    totals = spark.createDataFrame([(10, 1, 5)], "total long, invalid long, failed long")
    assert [validate.gate(totals, "permissive", 3, "absolute", m).first().passed for m in ("warning", "reject")] == [True, False]
    with pytest.raises(ValueError):
        validate.under_threshold(F.lit(1), F.lit(1), 1, "other")
    label = validate.outcome(F.lit(True), F.lit(True), F.lit(2), readable=F.lit(True), known=F.lit(True))
    assert counts.select(label.alias("o")).first().o == validate.INGESTED_WITH_ERRORS
    assert counts.select(validate.outcome(F.lit(True), F.lit(True), F.lit(0), readable=F.lit(False)).alias("o")).first().o == validate.REJECTED_CORRUPTED


def test_headers_schemas_and_columns(spark):
    assert validate.header_matches(["A", " b"], ["a", "B"]) and not validate.header_matches(["b", "a"], ["a", "b"]) and not validate.header_matches(["a"], ["a", "b"])
    a, b = T.StructType().add("x", "integer").add("y", "string"), T.StructType().add("y", "string").add("x", "integer")
    assert validate.schema_matches(a, b) and not validate.schema_matches(a, T.StructType().add("x", "integer")) and not validate.schema_matches(a, T.StructType().add("x", "long").add("y", "string"))
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert validate.columns_present(df, ["A"]) and not validate.columns_present(df, ["a"], exactly=True)
    assert validate.for_format("csv") is validate.structural_split and validate.for_format("orc") is validate.schema_matches
    with pytest.raises(ValueError):
        validate.for_format("fixed")


def test_same_rows_counts_duplicates(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (2,), (2,)], "x int")
    r = validate.same_rows(a, b).first()
    assert (r.left_rows, r.right_rows, r.only_left, r.only_right, r.same) == (3, 3, 1, 1, False) and validate.same_rows(a, a).first().same
