import datetime as dt
import threading

import pytest

from lakeops.operators import bronze, published, silver, stats, versions
from lakeops.plans.ingest import ingest
from lakeops.plans.sqlsync import delete_where
from lakeops.scratch import folders
from lakeops.spec import ColumnSpec, DatasetSpec


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_last_changes_with_moving_and_locked_partitions(spark, tmp_path):
    a = spark.createDataFrame([("A", "01"), ("B", "01")], "col1 string, dd string")
    b = spark.createDataFrame([("B", "02"), ("C", "02")], "col1 string, dd string")
    for locked, want in ((False, [("A", "01"), ("B", "02"), ("C", "02")]), (True, [("A", "01"), ("B", "01"), ("B", "02"), ("C", "02")])):
        path = str(tmp_path / f"t{locked}")
        for batch in (a, b):
            silver.write(spark, path, batch, silver.LAST_CHANGES, ["col1"], "dd", ["dd"], allow_partition_change=not locked)
        assert [(r[0], f"{int(r[1]):02d}") for r in rows(silver.read(spark, path), "col1", "dd")] == want


def test_a_partition_that_loses_its_last_row_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    for p, t in ((1, "2020-01-01"), (2, "2020-01-02")):
        silver.write(spark, path, spark.createDataFrame([("k", p, t)], "k string, p int, t string"), silver.LAST_CHANGES, ["k"], "t", ["p"])
    assert rows(silver.read(spark, path), "k", "p") == [("k", 2)]


def test_upsert_guards_by_time_and_matches_null_keys(spark):
    old = spark.createDataFrame([(1, 5, "o"), (None, 5, "o"), (3, None, "o")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 4, "n"), (None, 6, "n"), (3, 1, "n"), (4, None, "n")], "k int, t int, v string")
    got = {(r.k, r.v) for r in silver.upsert(old, new, ["k"], "t").collect()}
    assert got == {(1, "o"), (None, "n"), (3, "n"), (4, "n")}
    again = silver.upsert(silver.upsert(old, new, ["k"], "t"), new, ["k"], "t")
    assert {(r.k, r.v) for r in again.collect()} == got
    assert {(r.k, r.v) for r in silver.upsert_union(old, new, ["k"]).collect()} >= {(1, "n"), (3, "n"), (4, "n")}


def test_latest_per_key_keeps_keys_without_time(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, 4)], "k int, t int")
    assert {tuple(r) for r in silver.latest_per_key(df, ["k"], "t").collect()} == {(1, None), (2, 4)}
    with pytest.raises(ValueError):
        silver.latest_per_key(df, [], "t")


def test_evolution_adds_typed_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    silver.append(spark.createDataFrame([(1,)], "a int"), path)
    silver.append(spark.createDataFrame([(2, 3)], "a int, b long"), path)
    assert silver.read(spark, path).where("b is null").first().a == 1
    old, new = silver.evolve(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(3.0,)], "b double"))
    assert old.dtypes == new.dtypes == [("a", "int"), ("b", "double")]


def test_reprocessing_and_bronze_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b = spark.createDataFrame([(1, 1), (2, 2)], "k int, p int"), spark.createDataFrame([(9, 2)], "k int, p int")
    silver.write(spark, path, a, silver.INCREMENTAL, partition_by=["p"])
    silver.write(spark, path, b, silver.INCREMENTAL, partition_by=["p"], reprocess=silver.FULL)
    assert rows(silver.read(spark, path), "k", "p") == [(1, 1), (9, 2)]
    silver.write(spark, path, b, silver.FULL_SNAPSHOT, reprocess=silver.PARTIAL, partition_by=["p"])
    assert silver.read(spark, path).count() == 3
    with pytest.raises(ValueError):
        silver.write(spark, path, a, "unknown")
    assert [bronze.write_versioned(d, str(tmp_path / "b")) for d in (a, b)] == [1, 2]
    assert bronze.read_version(spark, str(tmp_path / "b")).count() == 1 and bronze.read_version(spark, str(tmp_path / "b"), 1).count() == 2
    assert silver.read_or_empty(spark, str(tmp_path / "none"), a.schema).count() == 0


def test_register_and_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    silver.full_snapshot(spark.createDataFrame([(1, 1)], "k int, p int"), path, ["p"])
    with pytest.raises(ValueError):
        silver.register(spark, "nowhere", "t", path)
    silver.register(spark, "lake", "t", path, create_database=True, refresh=True)
    silver.full_snapshot(spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "k int, v string, p int"), path, ["p"])
    silver.register(spark, "lake", "t", path, refresh=True)
    assert spark.table("lake.t").count() == 2 and "v" in spark.table("lake.t").columns
    spark.sql("DROP DATABASE lake CASCADE")


CITIES = DatasetSpec(
    "cities",
    (ColumnSpec("name"), ColumnSpec("country"), ColumnSpec("subcountry"), ColumnSpec("geonameid", "long", primary_key=True), ColumnSpec("timeStamp", "datetime", timestamp=True)),
    load_mode="last_changes", keep_history=True,
)


def test_two_batches_of_cities_and_their_history(spark, tmp_path):
    path = str(tmp_path / "cities")
    schema = "name string, country string, subcountry string, geonameid string, timeStamp string"
    first = [("Alicante", "Spain", "Valencia", "2521978", "2020-01-01 01:00:00"), ("Cáceres", "Spain", "Extremadura", "2520611", "2020-01-01 01:00:00"), ("Ciudad Real", "Spain", "Castille-La Mancha", "2519402", "2020-01-01 01:00:00")]
    second = [("Alicante", "Spain", "Comunidad Valenciana", "2521978", "2020-01-02 01:00:00"), ("Ciudad Real", "Spain", "Castilla La Mancha", "2519402", "2020-01-02 01:00:00"), ("Tomelloso", "Spain", "Castilla La Mancha", "2510392", "2020-01-02 01:00:00")]
    assert [ingest(spark, spark.createDataFrame(b, schema), CITIES, path) for b in (first, second)] == ["INGESTED_WITHOUT_ERRORS"] * 2
    day = dt.datetime(2020, 1, 2, 1)
    assert rows(silver.read(spark, path), "name", "subcountry", "geonameid", "timeStamp") == [
        ("Alicante", "Comunidad Valenciana", 2521978, day), ("Ciudad Real", "Castilla La Mancha", 2519402, day), ("Cáceres", "Extremadura", 2520611, dt.datetime(2020, 1, 1, 1)), ("Tomelloso", "Castilla La Mancha", 2510392, day),
    ]
    assert silver.read(spark, f"{path}_historical").count() == 6
    bad = spark.createDataFrame([("x", "y", "z", "N/A", "2020-01-03 01:00:00")], schema)
    assert ingest(spark, bad, CITIES, path) == "REJECTED_INVALID" and silver.read(spark, path).count() == 4


def test_runs_and_versions(spark, tmp_path):
    path = str(tmp_path / "runs")
    at = dt.datetime(2024, 1, 1, 10)
    stats.append_run(spark, path, {"run_id": "1", "dataset": "d", "state": stats.RUNNING, "at": at, "rows": (1, 0, 1, 0, 1, 0)})
    stats.append_run(spark, path, {"run_id": "1", "dataset": "d", "state": stats.DONE, "at": at + dt.timedelta(minutes=2), "messages": ["ok"]})
    stats.append_run(spark, path, {"run_id": "2", "dataset": "e", "state": stats.RUNNING, "at": at})
    runs = spark.read.schema(stats.RUN).parquet(path)
    assert {(r.run_id, r.state, r.seconds) for r in stats.latest_state(runs).collect()} == {("1", "DONE", 120), ("2", "RUNNING", 0)}
    assert [r.dataset for r in stats.running_within(runs, "2024-01-01 12:00:00").collect()] == ["e"] and stats.running_within(runs, "2024-01-02 12:00:00").isEmpty()
    v = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 9, True), ("b", 3, True)], "k string, t int, on boolean")
    assert rows(versions.current_as_of(v, ["k"], "t", 5, "on"), "k", "t") == [("a", 1), ("b", 3)]
    assert versions.ambiguous(spark.createDataFrame([("f", "x"), ("f", "y"), ("g", "x")], "file string, name string"), "file", "name").first().file == "f"


def test_delete_where_keeps_unknown_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,), (2,), (None,)], "a int").write.parquet(path)
    delete_where(spark, path, "a = 1")
    assert {r.a for r in silver.read(spark, path).collect()} == {2, None}


def test_delete_where_keeps_columns_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    silver.append(spark.createDataFrame([(1, "01"), (2, "02"), (5, None)], "id int, p string"), path, ["p"])
    silver.append(spark.createDataFrame([(3, "x", "01"), (4, "y", "a/b")], "id int, extra string, p string"), path, ["p"])
    delete_where(spark, path, "id = 1")
    like = spark.createDataFrame([], "p string")
    assert rows(silver.read(spark, path, like).na.fill("-"), "id", "extra", "p") == [(2, "-", "02"), (3, "x", "01"), (4, "y", "a/b"), (5, "-", "-")]
    assert sorted(f for f in folders(spark, published.current(spark, path)) if not f.startswith("_")) == ["p=01", "p=02", "p=__HIVE_DEFAULT_PARTITION__", "p=a%2Fb"]
    delete_where(spark, path, "p = '01' or id > 4")
    assert rows(silver.read(spark, path, like), "id", "p") == [(2, "02"), (4, "a/b")]


def test_readers_find_a_table_while_snapshots_are_published(spark, tmp_path):
    path, seen, stop = str(tmp_path / "t"), [], threading.Event()
    silver.full_snapshot(spark.range(10, numPartitions=2), path)
    silver.register(spark, "published", "t", path, create_database=True, refresh=True)

    def read():
        while not stop.is_set():
            try:
                seen.append((silver.read(spark, path).count(), spark.table("published.t").count()))
            except Exception as failed:
                seen.append(failed)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(20):
        silver.full_snapshot(silver.read(spark, path).selectExpr("id + 1 as id"), path)
        silver.register(spark, "published", "t", path, refresh=True)
    stop.set()
    reader.join()
    assert len(seen) > 3 and all(s == (10, 10) for s in seen), [s for s in seen if s != (10, 10)][:1]
    assert silver.read(spark, path).agg({"id": "min"}).first()[0] == 20 == spark.table("published.t").agg({"id": "min"}).first()[0]
    assert len(published.states(spark, path)) == published.KEEP
    spark.sql("DROP DATABASE published CASCADE")


def test_states_that_were_not_finished_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not published.is_table(spark, path)
    silver.full_snapshot(spark.range(3), path)
    broken = tmp_path / "t" / "v00000002-abc"
    spark.range(9).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert silver.read(spark, path).count() == 3
    silver.full_snapshot(spark.range(4), path)
    assert silver.read(spark, path).count() == 4 and published.current(spark, path).split("/")[-1].startswith("v00000003-")
    plain = str(tmp_path / "plain")
    spark.createDataFrame([(1, 1), (2, 2)], "k int, p int").write.partitionBy("p").parquet(plain)
    assert published.is_table(spark, plain) and published.partition_columns(spark, plain) == ["p"]
    silver.full_snapshot(spark.createDataFrame([(3, 3)], "k int, p int"), plain, ["p"])
    assert rows(silver.read(spark, plain), "k", "p") == [(3, 3)] and not (tmp_path / "plain" / "p=1").exists()
    old = tmp_path / "bronze"
    bronze.write_versioned(spark.range(2), str(old))
    (old / "v2").mkdir()
    assert bronze.versions(spark, str(old)) == [1] and bronze.read_version(spark, str(old)).count() == 2
    assert bronze.write_versioned(spark.range(5), str(old)) == 3 and bronze.read_version(spark, str(old)).count() == 5
    with pytest.raises(ValueError):
        bronze.read_version(spark, str(old), 2)


def test_registered_partitions_follow_the_state(spark, tmp_path):
    path = str(tmp_path / "t")
    silver.full_snapshot(spark.createDataFrame([(1, "a'b"), (2, "c"), (3, None)], "k int, p string"), path, ["p"])
    silver.register(spark, "pointed", "t", path, create_database=True, refresh=True)
    assert spark.table("pointed.t").count() == 3
    silver.full_snapshot(spark.createDataFrame([(1, "a'b"), (4, "d"), (5, "d"), (6, None)], "k int, p string"), path, ["p"])
    silver.register(spark, "pointed", "t", path, refresh=True)
    assert {tuple(r) for r in spark.table("pointed.t").collect()} == {(1, "a'b"), (4, "d"), (5, "d"), (6, None)}
    spark.sql("DROP DATABASE pointed CASCADE")


@pytest.mark.parametrize("at", ["overwrite", "delete"])
def test_an_interrupted_upsert_is_finished_by_the_next_writer(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    schema = "k string, p int, t int"
    silver.write(spark, path, spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], schema), silver.LAST_CHANGES, ["k"], "t", ["p"])
    moved = spark.createDataFrame([("a", 2, 2)], schema)

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(silver, "_overwrite" if at == "overwrite" else "delete", broken)
    with pytest.raises(OSError):
        silver.write(spark, path, moved, silver.LAST_CHANGES, ["k"], "t", ["p"])
    monkeypatch.undo()
    silver.write(spark, path, spark.createDataFrame([("c", 3, 1)], schema), silver.LAST_CHANGES, ["k"], "t", ["p"])
    assert rows(silver.read(spark, path), "k", "p") == [("a", 2), ("b", 2), ("c", 3)]
    assert published.intended(spark, published.current(spark, path)) is None


@pytest.mark.parametrize("partition_by", [None, ["p"]])
def test_a_batch_that_comes_again_leaves_no_second_copy(spark, tmp_path, monkeypatch, partition_by):
    path = str(tmp_path / "t")
    silver.append(spark.createDataFrame([(0, 0)], "k int, p int"), path, partition_by)
    batch = spark.createDataFrame([(i, i % 3) for i in range(20)], "k int, p int").repartition(4)
    real, moves = published.rename, []

    def breaks(spark, source, target):
        if len(moves) == 2:
            raise OSError("lost")
        moves.append(target)
        real(spark, source, target)

    monkeypatch.setattr(published, "rename", breaks)
    with pytest.raises(OSError):
        silver.append(batch, path, partition_by, batch="stream-7")
    monkeypatch.undo()
    for _ in range(3):
        silver.append(batch, path, partition_by, batch="stream-7")
    silver.append(batch.where("k = 1"), path, partition_by, batch="stream-8")
    assert rows(silver.read(spark, path), "k") == sorted([(0,), (1,)] + [(i,) for i in range(20)])
    with pytest.raises(ValueError):
        silver.append(batch, path, partition_by, batch="a/b")


def test_of_two_starters_one_wins(spark, tmp_path):
    path = str(tmp_path / "locks" / "cities")
    for round_ in range(5):
        won, gate = [], threading.Barrier(4)

        def start(n):
            gate.wait()
            won.append((stats.acquire(spark, path, f"run-{n}"), f"run-{n}"))

        starters = [threading.Thread(target=start, args=(n,)) for n in range(4)]
        [t.start() for t in starters]
        [t.join() for t in starters]
        (owner,) = [o for ok, o in won if ok]
        assert not stats.release(spark, path, "someone") and stats.release(spark, path, owner)
    assert stats.acquire(spark, path, "a", 100, now=1000) and not stats.acquire(spark, path, "b", 100, now=1100)
    assert stats.acquire(spark, path, "b", 100, now=1101) and not stats.release(spark, path, "a") and stats.release(spark, path, "b")


def test_a_snapshot_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    silver.full_snapshot(spark.range(3), path)
    with pytest.raises(Exception):
        silver.full_snapshot(spark.range(5).selectExpr("raise_error('no') as id"), path)
    assert silver.read(spark, path).count() == 3
    silver.full_snapshot(silver.read(spark, path).where("id > 0"), path)  # a table may be made from itself
    assert silver.read(spark, path).count() == 2
