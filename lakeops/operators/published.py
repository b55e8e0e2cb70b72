"""Tables whose states are folders of their own: ``<table>/v00000007-ab12cd34``. The newest whole one is current.

A state is whole when the job that wrote it has left its ``_SUCCESS`` file, so publishing is that one file: readers find the state before or the new one, never
none and never half of one, on any file system. A failed write leaves a folder that nobody looks at. ``KEEP`` states stay for readers that have
found them already; older ones go with the next publication. A plain folder (written by others) is a table's state until a first one is published in it.

Batches that may come twice are appended under a key: their files are staged, renamed into the table under names that contain the key, and the key is
written into the table's ledger. Whatever was interrupted is finished by the next attempt with the same key, from the staged files.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from lakeops.scratch import create, delete, exists, folders, leaf_files, read_text, rename, unique

KEEP = 3
_VERSION = re.compile(r"v(\d+)(?:-[0-9a-f]+)?")
LEDGER, STAGED, INTENT = "_ledger", "_staged", "_intent.json"


def states(spark: SparkSession, path: str) -> list[str]:
    """The folders of whole states, oldest first."""
    named = sorted(((int(m[1]), f) for f in folders(spark, path) if (m := _VERSION.fullmatch(f))))
    return [f for _, f in named if exists(spark, f"{path}/{f}/_SUCCESS")]


def current(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are."""
    whole = states(spark, path)
    return f"{path}/{whole[-1]}" if whole else path


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether there is a whole state, or a plain folder with data."""
    if states(spark, path):
        return True
    return exists(spark, path) and not all(_VERSION.fullmatch(f) or f.startswith("_") for f in folders(spark, path)) or bool(leaf_files(spark, path, deep=False))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The names of a stored folder's partition levels."""
    found, place = [], path
    while level := next((f for f in folders(spark, place) if "=" in f and not f.startswith(("_", "."))), None):
        found.append(level.split("=", 1)[0])
        place = f"{place}/{level}"
    return found


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, keep: int = KEEP) -> str:
    """Writes the next state of a table. ``df`` may be made from the table itself."""
    spark = df.sparkSession
    before, plain = folders(spark, path), not states(spark, path)
    number = max((int(m[1]) for f in before if (m := _VERSION.fullmatch(f))), default=0) + 1
    place = f"{path}/v{number:08d}-{unique(8)}"
    df.write.partitionBy(*(partition_by or [])).parquet(place)
    whole = states(spark, path)
    oldest = int(_VERSION.fullmatch(whole[max(0, len(whole) - keep)])[1])
    for f in before:
        m = _VERSION.fullmatch(f)
        if m and int(m[1]) < oldest or plain and not m and not f.startswith("_"):  # what came before the first state is not a state any more
            delete(spark, f"{path}/{f}")
    for f in leaf_files(spark, path, deep=False) if plain else ():
        if not f.startswith("_"):
            delete(spark, f"{path}/{f}")
    return place


def append_once(df: DataFrame, path: str, key: str, partition_by: list[str] | None = None) -> bool:
    """Appends a batch unless its key is in the ledger; gives whether it was appended now. Every file has the key in its name, so a second attempt moves what the first one left."""
    spark = df.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9.-]+", key):
        raise ValueError(f"not a key of a batch: {key}")
    entry = f"{path}/{LEDGER}/{key}"
    if exists(spark, entry):
        return False
    staged = f"{path}/{STAGED}/{key}"
    if not exists(spark, f"{staged}/_SUCCESS"):
        df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(staged)
    place = current(spark, path)
    for file in leaf_files(spark, staged):
        folder, _, name = file.rpartition("/")
        if not name.startswith("_"):
            rename(spark, f"{staged}/{file}", "/".join(x for x in (place, folder, f"{key}-{name}") if x))
    create(spark, entry, "")
    delete(spark, staged)
    return True


def intend(spark: SparkSession, place: str, what: dict) -> None:
    """Notes what is about to be done to a state in place, so that it can be finished after a failure."""
    create(spark, f"{place}/{INTENT}", json.dumps(what))


def intended(spark: SparkSession, place: str) -> dict | None:
    return json.loads(read_text(spark, f"{place}/{INTENT}")) if exists(spark, f"{place}/{INTENT}") else None


def fulfilled(spark: SparkSession, place: str) -> None:
    delete(spark, f"{place}/{INTENT}")
