import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import gold, silver, stats
from lakeops.operators.quality import Expression, Unique
from lakeops.plans.ingest import AlreadyRunning, Lake, Run, Secrets, run_batch
from lakeops.plans.transform import transform
from lakeops.spec import INCREMENTAL, PERMISSIVE, ColumnSpec, DatasetSpec
from lakeops.streaming import topics

AT = dt.datetime(2024, 3, 5, 6, 7, 8)
SPEC = DatasetSpec("d", (ColumnSpec("k", "long", primary_key=True), ColumnSpec("v", "double")), INCREMENTAL, PERMISSIVE, 50, "percentage", rules=(Expression("v < 10", "small"), Unique(("k",))))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_the_source_is_read_once_and_nothing_is_cached(spark, tmp_path):
    """Each row of the source adds to a counter when it is read; rules, counts, rejects and the load read what was written."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    source = spark.createDataFrame([(str(i), "x" if i == 3 else str(i)) for i in range(20)] + [("7", "7")], "k string, v string").mapInArrow(count, "k string, v string")
    lake = Lake(str(tmp_path / "t"), str(tmp_path / "rejects"), str(tmp_path / "history"))
    result = run_batch(spark, source, SPEC, lake, Run("r", AT))
    assert tuple(result) == ("INGESTED_WITH_ERRORS", True, 21, 0, 1, 11)
    assert read.value == 21
    assert not spark._jsparkSession.sharedState().cacheManager().isEmpty() or spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    assert silver.read(spark, lake.table).count() == 20
    invalid = spark.read.csv(f"{lake.rejects}/invalid", header=True).first()
    assert (invalid.k, invalid.v, invalid.bad_columns) == ("3", "x", "v")
    assert spark.read.schema("row string, failed_rules array<string>").json(f"{lake.rejects}/quality").count() == 11
    last = stats.latest_state(spark.read.schema(stats.RUN).parquet(lake.history)).first()
    assert (last.state, last.result, tuple(last["rows"])) == ("DONE", "INGESTED_WITH_ERRORS", (21, 0, 20, 1, 9, 11))


def test_empty_batches_and_rejected_ones(spark, tmp_path):
    lake = Lake(str(tmp_path / "t"), str(tmp_path / "rejects"), str(tmp_path / "history"))
    empty = spark.createDataFrame([], "k string, v string")
    assert tuple(run_batch(spark, empty, SPEC, lake, Run("a", AT))) == ("REJECTED_SCHEMA_MISMATCH", False, 0, 0, 0, 0)
    bad = spark.createDataFrame([("x", "y"), ("1", "z"), ("2", "2")], "k string, v string")
    assert tuple(run_batch(spark, bad, SPEC, lake, Run("b", AT))) == ("REJECTED_INVALID", False, 3, 0, 2, 0)
    assert not (tmp_path / "t").exists() and spark.read.csv(f"{lake.rejects}/invalid", header=True).count() == 2
    with pytest.raises(ValueError, match="sensitive"):
        run_batch(spark, bad, DatasetSpec("s", (ColumnSpec("k", "long", primary_key=True), ColumnSpec("v", sensitive=True))), lake)
    assert "master" not in repr(Lake("t", secrets=Secrets("salt", "data", "master")))


def test_one_run_at_a_time_and_failures_in_the_history(spark, tmp_path):
    lake = Lake(str(tmp_path / "t"), history=str(tmp_path / "history"))
    good = spark.createDataFrame([("1", "1")], "k string, v string")
    assert stats.acquire(spark, f"{lake.history}/_leases/d", "other")
    with pytest.raises(AlreadyRunning):
        run_batch(spark, good, SPEC, lake, Run("a", AT))
    assert stats.release(spark, f"{lake.history}/_leases/d", "other")
    broken = good.select("k", F.expr("if(k = '1', raise_error('no'), v)").alias("v"))
    with pytest.raises(Exception):
        run_batch(spark, broken, SPEC, lake, Run("b", AT))
    assert run_batch(spark, good, SPEC, lake, Run("c", AT)).loaded
    states = {r.run_id: (r.state, r.result, bool(r.messages)) for r in stats.latest_state(spark.read.schema(stats.RUN).parquet(lake.history)).collect()}
    assert states == {"b": ("DONE", "REJECTED_CORRUPTED", True), "c": ("DONE", "INGESTED_WITHOUT_ERRORS", False)}


def test_a_streamed_batch_that_fails_after_its_append_comes_again_without_copies(spark, tmp_path, monkeypatch):
    schema = "k string, v string"
    lake = Lake(str(tmp_path / "t"), str(tmp_path / "rejects"), str(tmp_path / "history"))
    spark.createDataFrame([(str(i), str(i % 20)) for i in range(30)], schema).write.parquet(str(tmp_path / "in"))
    real = stats.append_run

    def breaks(spark, path, record, attempts=3):
        if record["state"] == stats.DONE:
            raise OSError("lost")
        real(spark, path, record, attempts)

    def drain():
        topics.ingest_dataset(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), SPEC, lake, str(tmp_path / "mark"), clock=lambda: AT)

    monkeypatch.setattr(stats, "append_run", breaks)
    with pytest.raises(Exception):
        drain()
    monkeypatch.undo()
    assert silver.read(spark, lake.table).count() == 30
    drain()
    drain()
    table = silver.read(spark, lake.table)
    assert table.count() == 30 and rows(table.select("load_yyyy", "load_hh").distinct(), "load_yyyy", "load_hh") == [(2024, 6)]
    key = topics.batch_key(str(tmp_path / "mark"), 0)
    assert spark.read.json(f"{lake.rejects}/{key}/quality").count() == 10


def test_gold_runs_report_and_record_failures(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, v int")
    target, history = {"mode": "overwrite", "path": str(tmp_path / "t")}, str(tmp_path / "h")
    messages = transform(spark, "g", df, [gold.column_stage("w", "v + p")], target, [Expression("v < 10", "small"), Expression("k < 9", "few")], {"p": 2}, history=history, run_id="1", at=AT)
    assert messages == ["small: 2 of 3 rows"] and rows(spark.read.parquet(target["path"]).na.fill(-1), "k", "w") == [(1, 7), (2, -1), (3, 52)]
    assert transform(spark, "g", df, [], target, history=history, run_id="2", at=AT) == []
    with pytest.raises(Exception):
        transform(spark, "g", df, [gold.column_stage("w", "raise_error('no')")], target, history=history, run_id="3", at=AT)
    runs = {r.run_id: (r.result, r.messages, r["rows"] and tuple(r["rows"])) for r in spark.read.schema(stats.RUN).parquet(history).collect()}
    assert runs["1"] == ("INGESTED_WITH_ERRORS", ["small: 2 of 3 rows"], (3, 0, 3, 0, 1, 2)) and runs["2"][0] == "INGESTED_WITHOUT_ERRORS" and runs["3"][1]
