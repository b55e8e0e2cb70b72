"""Load semantics of stored tables: full snapshot, incremental append and latest changes (upsert), with schema evolution.

Tables are Parquet folders with published states (``published``): a snapshot or an upsert of an unpartitioned table is a new state. Partitioned tables are
changed within their state, by dynamic overwrites of the partitions that a batch touches; what is about to be done is noted before, and finished by the next
writer if it was interrupted.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import published
from lakeops.scratch import beside, delete, exists, scratch
from lakeops.spec import FULL_SNAPSHOT, INCREMENTAL, LAST_CHANGES

NONE, PARTIAL, FULL = "none", "partial", "full"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its declared schema (new columns are null in old files), or no rows."""
    return spark.read.schema(schema).parquet(published.current(spark, path)) if published.is_table(spark, path) else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """The table with all its columns. Partition values have the types of ``like``'s columns where it is given ("01" stays text), else inferred ones."""
    path = published.current(spark, path)
    table = spark.read.option("mergeSchema", "true").parquet(path)
    if like is None:
        return table
    kinds = {f.name: f.dataType for f in like.schema.fields}
    return spark.read.schema(T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in table.schema.fields])).parquet(path)


def _partition_folder(spark: SparkSession, names: list[str], row) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    values = [row[f"_{p}"] for p in names]
    return "/".join(f"{p}={'__HIVE_DEFAULT_PARTITION__' if v is None else escape(str(v))}" for p, v in zip(names, values, strict=True))


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))


def latest_per_key(df: DataFrame, keys: list[str], timestamp: str, ties: list[str] | None = None) -> DataFrame:
    """One row a key: the latest, null timestamps last, ties by ``ties`` (descending) and then by a hash of the row."""
    if not keys or not timestamp:
        raise ValueError("latest changes need a primary key and a timestamp")
    order = [F.col(timestamp).desc_nulls_last(), *(F.col(t).desc_nulls_last() for t in ties or []), _row_hash(df)]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def evolve(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of both, missing ones as typed nulls; old columns keep their order, new ones follow."""
    kinds = {f.name: f.dataType for f in old.schema.fields}
    kinds |= {f.name: f.dataType for f in new.schema.fields if f.name not in kinds}

    def fill(df: DataFrame) -> DataFrame:
        there = set(df.columns)
        return df.select(*(F.col(f"`{n}`") if n in there else F.lit(None).cast(k).alias(n) for n, k in kinds.items()))

    return fill(old), fill(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], timestamp: str | None, partition_keys: list[str] | None = None, guard: bool = True) -> DataFrame:
    """``old`` with the rows of ``new``: one null-safe full outer join. A new row wins unless the old one is later (``guard``).

    ``new`` should have one row a key (``latest_per_key``). With ``partition_keys`` a row whose partition moved counts as another row and is added."""
    old, new = evolve(old, new)
    on = [*keys, *(partition_keys or [])]
    a = old.select(F.struct(*(F.col(f"`{c}`") for c in old.columns)).alias("o"))
    b = new.select(F.struct(*(F.col(f"`{c}`") for c in new.columns)).alias("n"))
    both = a.join(b, [F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`")) for k in on], "fullouter")
    newer = F.col("o").isNull()
    if guard and timestamp:
        newer = newer | ~F.coalesce(F.col(f"o.`{timestamp}`") > F.col(f"n.`{timestamp}`"), F.col(f"n.`{timestamp}`").isNull() & F.col(f"o.`{timestamp}`").isNotNull())
    else:
        newer = F.lit(True)
    return both.select(F.when(F.col("n").isNotNull() & newer, F.col("n")).otherwise(F.col("o")).alias("r")).select("r.*")


def upsert_union(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The unguarded form: the new row always wins. Rows with a null key never match."""
    old, new = evolve(old, new)
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(new)


def full_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """The table's next state; a job that fails leaves the one before."""
    published.publish(df, path, partition_by)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, batch: str | None = None) -> None:
    """Adds rows to the table's state; with the key of a ``batch`` at most once."""
    finish(df.sparkSession, path)
    if not published.is_table(df.sparkSession, path):
        published.publish(df if batch is None else df.limit(0), path, partition_by)
        if batch is None:
            return
    if batch is None:
        df.write.mode("append").partitionBy(*(partition_by or [])).parquet(published.current(df.sparkSession, path))
    else:
        published.append_once(df, path, batch, partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replaces the partitions that ``df`` has rows for, others stay; an unpartitioned table is replaced whole."""
    if not partition_by or not published.is_table(df.sparkSession, path):
        return full_snapshot(df, path, partition_by)
    finish(df.sparkSession, path)
    _overwrite(df, published.current(df.sparkSession, path), partition_by)


def _overwrite(df: DataFrame, place: str, partition_by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(place)


def finish(spark: SparkSession, path: str) -> None:
    """Does what an interrupted upsert had noted: its partitions are written again, those that lost their last row go. Doing it twice changes nothing."""
    place = published.current(spark, path)
    what = published.intended(spark, place)
    if what is None:
        return
    _overwrite(spark.read.schema(T.StructType.fromJson(what["schema"])).parquet(what["staged"]), place, what["partition_by"])
    for folder in what["emptied"]:
        delete(spark, f"{place}/{folder}")
    published.fulfilled(spark, place)
    delete(spark, what["staged"])


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], timestamp: str, partition_by: list[str] | None = None, allow_partition_change: bool = True) -> None:
    """Upserts a batch into a stored table. Of a partitioned table only partitions with rows of the batch's keys, and the batch's own, are read and
    written; finding the first takes a scan of the table's keys, unless rows can't change their partition."""
    new = latest_per_key(new, keys, timestamp)
    if not published.is_table(spark, path):
        return full_snapshot(new, path, partition_by)
    finish(spark, path)
    old = read(spark, path, new)
    locked = None if allow_partition_change else partition_by
    if not partition_by:
        return full_snapshot(upsert(old, new, keys, timestamp), path)
    place = published.current(spark, path)
    staged, batch = beside(path), scratch(spark, "batch")
    new.write.parquet(batch)
    new = spark.read.schema(new.schema).parquet(batch)
    touched = new.select(*partition_by).distinct()
    if locked is None:
        same = [old[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
        moved = old.select(*{*keys, *partition_by}).join(new.select(*(F.col(k).alias(f"_{k}") for k in keys)), same, "left_semi")
        touched = touched.unionByName(moved.select(*partition_by)).distinct()
    listed = scratch(spark, "touched")
    touched.write.parquet(listed)
    touched = spark.read.schema(touched.schema).parquet(listed).select(*(F.col(p).alias(f"_{p}") for p in partition_by))
    near = old.join(touched, [old[p].eqNullSafe(F.col(f"_{p}")) for p in partition_by], "left_semi")
    upsert(near, new, keys, timestamp, locked).write.parquet(staged)
    result = spark.read.parquet(staged)
    left = result.select(*partition_by).distinct()
    # partitions that lose their last row: a dynamic overwrite does not remove them
    emptied = touched.join(left, [F.col(f"_{p}").eqNullSafe(left[p]) for p in partition_by], "left_anti")
    gone = [_partition_folder(spark, partition_by, row) for row in emptied.toLocalIterator()]
    published.intend(spark, place, {"staged": staged, "schema": json.loads(result.schema.json()), "partition_by": partition_by, "emptied": gone})
    finish(spark, path)


def write(spark: SparkSession, path: str, df: DataFrame, mode: str, keys: list[str] | None = None, timestamp: str | None = None, partition_by: list[str] | None = None, reprocess: str = NONE, allow_partition_change: bool = True, keep_history: bool = False, batch: str | None = None) -> None:
    """Dispatch on the load mode. Reprocessing: a partial file is appended to a snapshot; a full one replaces its partitions of an incremental table.
    With the key of a ``batch`` appends happen once, however often the batch comes; the other modes give the same table each time."""
    if mode == FULL_SNAPSHOT and reprocess == PARTIAL:
        append(df, path, partition_by, batch)
    elif mode == FULL_SNAPSHOT:
        full_snapshot(df, path, partition_by)
    elif mode == INCREMENTAL and reprocess == FULL:
        replace_partitions(df, path, partition_by or [])
    elif mode == INCREMENTAL:
        append(df, path, partition_by, batch)
    elif mode == LAST_CHANGES:
        upsert_table(spark, path, df, keys or [], timestamp or "", partition_by, allow_partition_change)
    else:
        raise ValueError(f"unknown load mode {mode}")
    if keep_history:
        append(df, f"{path}_historical", partition_by, batch)


def reprocess_kind(files: DataFrame, history: DataFrame) -> DataFrame:
    """Adds ``reprocess`` to (file) rows: ``.fix`` files are partial, names in the history of ingested files full, others none."""
    seen = history.select(F.col("file").alias("_file")).distinct().withColumn("_seen", F.lit(True))
    kind = F.when(F.col("file").contains(".fix"), PARTIAL).when(F.col("_seen"), FULL).otherwise(NONE)
    return files.join(seen, files["file"] == F.col("_file"), "left").withColumn("reprocess", kind).drop("_file", "_seen")


def register(spark: SparkSession, database: str, table: str, path: str, create_database: bool = False, refresh: bool = False) -> None:
    """Puts a stored table into the catalog, where it points to the table's current state. ``refresh`` points it to the state of now, with new columns and partitions;
    readers always find a table, though of a partitioned one some partitions may be newer than others while this runs."""
    if create_database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    elif not spark.catalog.databaseExists(database):
        raise ValueError(f"database {database} does not exist")
    name, place = f"`{database}`.`{table}`", published.current(spark, path)
    there = spark.catalog.tableExists(f"{database}.{table}")
    if there and refresh:
        stored = read(spark, path).schema
        known = {c.name: c.dataType for c in spark.catalog.listColumns(f"{database}.{table}")}
        new = [f for f in stored.fields if f.name not in known]
        if any(known.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString() for f in stored.fields) or set(known) - set(stored.names):
            spark.sql(f"DROP TABLE {name}")  # a column that is gone or has another type takes a new table
            there = False
        elif new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    if not there:
        # files of different ages have different columns: without merging, one of them would give the schema
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{place}'")
    if refresh:
        if there:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{table}")):
            _point_partitions(spark, name, place)
        spark.sql(f"REFRESH TABLE {name}")


def _point_partitions(spark: SparkSession, name: str, place: str) -> None:
    """New partitions are found; those that the catalog knows are pointed to their folder in the state, or go with it."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for row in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator():
        folder = row["partition"]
        spec = ", ".join(f"`{k}` = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else "'" + unescape(v).replace("\\", "\\\\").replace("'", "\\'") + "'") for k, v in (level.split("=", 1) for level in folder.split("/")))
        if exists(spark, f"{place}/{folder}"):
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{place}/{folder}'")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
