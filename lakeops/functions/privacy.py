"""Surrogate ids, pseudonyms, masks, column encryption, and the split of sensitive columns into a table of their own."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.catalog import MASK

SEPARATOR = "\u0001"


class SensitiveSplit(NamedTuple):
    main: DataFrame
    sensitive: DataFrame


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _salt(salt: str | Column) -> Column:
    return F.lit(salt) if isinstance(salt, str) else salt


def surrogate_id(keys: list[str], salt: str | Column, bits: int = 512) -> Column:
    """sha2(sha2(keys, separated) || salt); null parts count as empty, and the separator keeps (a, bc) apart from (ab, c)."""
    joined = F.concat_ws(SEPARATOR, *(F.coalesce(_text(k), F.lit("")) for k in keys))
    return F.sha2(F.concat(F.sha2(joined, bits), _salt(salt)), bits)


def pseudonymize(column: str | Column, salt: str | Column, bits: int = 512) -> Column:
    return F.sha2(F.concat(F.coalesce(_text(column), F.lit("null")), _salt(salt)), bits)


def mask(column: str | Column) -> Column:
    """Sixteen asterisks, for nulls as well."""
    return F.lit(MASK)


def with_secrets(df: DataFrame, **secrets: str) -> DataFrame:
    """Adds a text column for each secret, from a frame of one row: a plan's text, and so the UI and the event log, has their names alone."""
    row = df.sparkSession.createDataFrame([tuple(secrets.values())], ", ".join(f"{name} string" for name in secrets))
    return df.crossJoin(F.broadcast(row))


def _key(secret: Column) -> Column:
    return F.unhex(F.sha2(secret, 256))


def encrypt(column: str | Column, secret: Column) -> Column:
    """Base64 of AES-GCM with a fresh nonce; the key is the SHA-256 of the secret, a column of ``with_secrets``; nulls stay null."""
    return F.base64(F.aes_encrypt(_text(column).cast("binary"), _key(secret), F.lit("GCM"), F.lit("DEFAULT")))


def decrypt(column: str | Column, secret: Column) -> Column:
    return F.aes_decrypt(F.unbase64(_text(column)), _key(secret), F.lit("GCM"), F.lit("DEFAULT")).cast("string")


def split_sensitive(df: DataFrame, keys: list[str], hidden: list[str], timestamp: str | None, salt: str, data_key: str, master_key: str, bits: int = 512) -> SensitiveSplit:
    """main: ``_id``, ``_row``, pseudonyms of the hidden columns, the rest; sensitive: ``_id``, ``_row``, encrypted columns, the data key wrapped by the master
    key, timestamp. ``_row`` is a salted digest of the whole row, which keeps rows of one key apart (a history has many).
    Keys that are hidden are dropped from main's plain columns like the others."""
    rows = with_secrets(df, _salt=salt, _data=data_key, _master=master_key)
    row = F.sha2(F.concat(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))), F.col("_salt")), 256)
    with_id = rows.withColumns({"_id": surrogate_id(keys, F.col("_salt"), bits), "_row": row})
    main = with_id.select("_id", "_row", *(pseudonymize(c, F.col("_salt"), bits).alias(c) if c in hidden else F.col(c) for c in df.columns))
    sensitive = with_id.select("_id", "_row", *(encrypt(c, F.col("_data")).alias(c) for c in hidden), encrypt("_data", F.col("_master")).alias("data_key"), *([timestamp] if timestamp else []))
    return SensitiveSplit(main, sensitive)


def rejoin(split: SensitiveSplit, hidden: list[str], master_key: str) -> DataFrame:
    """The rows with their hidden columns in the clear again."""
    opened = with_secrets(split.sensitive.dropDuplicates(["_id", "_row"]), _master=master_key)
    opened = opened.withColumn("_data", decrypt("data_key", F.col("_master")))
    clear = opened.select("_id", "_row", *(decrypt(c, F.col("_data")).alias(c) for c in hidden))
    return split.main.drop(*hidden).join(clear, ["_id", "_row"]).drop("_row")
