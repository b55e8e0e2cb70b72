"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one of our own only where that is unset under a local master (tests)."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        known = tempfile.mkdtemp(prefix="lakeops-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and its size is then known to the planner.
    The table goes when the driver ends, as the frames that are read from it may live as long."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, order: str, most: int) -> DataFrame:
    """The ``most`` rows with the smallest ``order``, a column of uniform 64-bit hashes.

    A sort with a limit alone would send ``most`` rows of every partition to one task. So rows that are surely not among them
    (six standard deviations beyond the share that is needed) are dropped first, and the sort sees about ``most`` rows in all."""
    n = df.select(order).count()
    needed = int(most + 6 * most**0.5 + 36)
    if n > needed:
        df = df.where(F.col(order) <= -(1 << 63) + ((1 << 64) - 1) * needed // n)
    return df.orderBy(order).limit(most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
