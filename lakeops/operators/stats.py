"""Run history: appended records, the latest state of every run, what is pending and what is running."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.timeseries import global_row_number
from lakeops.scratch import create, delete, exists, read_text, rename, unique

ROWS = T.StructType([T.StructField(n, T.LongType()) for n in ("read_valid", "read_invalid", "cast_valid", "cast_invalid", "quality_valid", "quality_invalid")])
RUN = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("dataset", T.StringType()), T.StructField("state", T.StringType()), T.StructField("at", T.TimestampType()),
    T.StructField("result", T.StringType()), T.StructField("rows", ROWS), T.StructField("messages", T.ArrayType(T.StringType())), T.StructField("file", T.StringType()), T.StructField("day", T.StringType()),
])
RUNNING, PENDING, DONE = "RUNNING", "PENDING", "DONE"


def append_run(spark: SparkSession, path: str, record: dict, attempts: int = 3) -> None:
    """Appends one record; createDataFrame checks it against the schema. Tried again if the write fails."""
    record = {**record, "day": record["at"].strftime("%Y-%m-%d")}
    row = spark.createDataFrame([tuple(record.get(f.name) for f in RUN.fields)], RUN)
    for left in range(attempts - 1, -1, -1):
        try:
            return row.write.mode("append").partitionBy("day").parquet(path)
        except Exception:
            if not left:
                raise


def latest_state(runs: DataFrame) -> DataFrame:
    """One row a run: its newest record, with start, end and duration in seconds."""
    whole = Window.partitionBy("run_id")
    newest = F.row_number().over(whole.orderBy(F.col("at").desc(), F.col("state")))
    started, ended = F.min("at").over(whole), F.max("at").over(whole)
    runs = runs.withColumns({"_n": newest, "started": started, "ended": ended})
    return runs.where("_n = 1").drop("_n").withColumn("seconds", F.unix_timestamp("ended") - F.unix_timestamp("started"))


def pending(batches: DataFrame, flag: str, order: list[str]) -> DataFrame:
    """Batches that wait, numbered in the order of completion; the order is global, but no task holds all of them."""
    return global_row_number(batches.where(F.col(flag)), order, "place")


def running_within(runs: DataFrame, now, seconds: int = 21_600) -> DataFrame:
    """Datasets with a run that started within the window and has not ended: a new run of them must wait."""
    state = latest_state(runs)
    return state.where((F.col("state") == RUNNING) & (F.unix_timestamp("started") >= F.unix_timestamp(F.lit(now).cast("timestamp")) - seconds)).groupBy("dataset").agg(F.count("*").alias("running"))


def acquire(spark: SparkSession, path: str, owner: str, seconds: float = 21_600, now: float | None = None) -> bool:
    """Takes the lease of a run: a file that only one of several starters can make. One that has run out is moved aside first, which again only one can do.
    ``now``: the clock, for tests."""
    now = time.time() if now is None else now
    text = json.dumps({"owner": owner, "until": now + seconds})
    if create(spark, path, text):
        return True
    try:
        held = json.loads(read_text(spark, path) or "{}")
    except Exception:  # it went meanwhile: someone else is faster
        return False
    if held.get("until", now) >= now:  # an empty file is one that is being written
        return False
    try:
        rename(spark, path, f"{path}-expired-{unique()}")
    except Exception:
        return False
    return create(spark, path, text)


def release(spark: SparkSession, path: str, owner: str) -> bool:
    """Gives the lease back, if ``owner`` has it."""
    if not exists(spark, path) or json.loads(read_text(spark, path) or "{}").get("owner") != owner:
        return False
    delete(spark, path)
    return True
