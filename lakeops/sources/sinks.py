"""File writers: compressed by format, and rejected rows by reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Codec of each format (fixed values).
CODECS = {"csv": "bzip2", "json": "bzip2", "text": "bzip2", "avro": "bzip2", "orc": "zlib", "parquet": "gzip"}
#: Rejects are written in every batch, and bzip2 takes ten times as long. Readers can't split gzip, so files are bounded.
REJECT_CODEC, REJECT_ROWS = "gzip", 1_000_000


def binary_to_base64(df: DataFrame) -> DataFrame:
    """Binary columns as text, for formats that have none."""
    return df.withColumns({f.name: F.base64(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)})


def write_compressed(df: DataFrame, path: str, fmt: str, mode: str = "overwrite", codec: str | None = None, **options) -> None:
    """As many files as the plan has partitions: nothing is pulled into one task. ``codec``: else the format's usual one."""
    if fmt in ("csv", "json", "text"):
        df = binary_to_base64(df)
    df.write.mode(mode).format(fmt).option("compression", codec or CODECS[fmt]).options(**options).save(path)


def write_rejects(df: DataFrame, base: str, reason: str, fmt: str = "csv", mode: str = "append", codec: str = REJECT_CODEC) -> str:
    """Rejected rows under ``base/reason``; arrays of names become one text in CSV."""
    if fmt == "csv":
        df = df.withColumns({f.name: F.concat_ws("|", f.name) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)})
    path = f"{base}/{reason}"
    write_compressed(df, path, fmt, mode, codec, maxRecordsPerFile=REJECT_ROWS, **({"header": "true"} if fmt == "csv" else {}))
    return path
