"""Places for intermediate tables, and files and folders on Spark's file systems."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the folder that all executors share; a temporary folder only where that is unset under a local master.
    What is written there goes when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="lakeops-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    files, place = _file_system(spark, path)
    files.deleteOnExit(place)
    return path


def beside(path: str) -> str:
    """A place on the file system of a table for its next version."""
    return f"{path.rstrip('/')}_new-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def unique(letters: int = 32) -> str:
    return uuid.uuid4().hex[:letters]


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Moves a file; folders on the way are made."""
    files, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with a text unless there is one; of several that try at once one succeeds, as far as the file system can tell (a local disk, HDFS)."""
    files, place = _file_system(spark, path)
    files.mkdirs(place.getParent())
    if files.getUri().getScheme() == "file":
        try:
            with open(place.toUri().getPath(), "x", encoding="utf-8") as file:
                file.write(text)
            return True
        except FileExistsError:
            return False
    try:
        out = files.create(place, False)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def leaf_files(spark: SparkSession, path: str, deep: bool = True) -> list[str]:
    """The names of the files in a folder, with the folders below it if ``deep``."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    root, found = files.resolvePath(place).toUri().getPath(), []
    listed = files.listFiles(place, deep)
    while listed.hasNext():
        found.append(listed.next().getPath().toUri().getPath()[len(root) :].lstrip("/"))
    return sorted(found)


def folders(spark: SparkSession, path: str) -> list[str]:
    files, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()) if files.exists(place) else []
