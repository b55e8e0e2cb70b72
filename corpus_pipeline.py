"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mixing, tokens.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of ``documents``.
``run`` writes each stage's rows as Parquet to the shared folder and reads them for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.bpe import encode_documents
from lakeops.llm.mixing import mix
from lakeops.llm.near_dedup import near_duplicate_classes
from lakeops.llm.quality import keep_good
from lakeops.llm.storage import stored, table
from lakeops.llm.substring_dedup import remove_repeated_windows

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id."""
    gone = near_duplicate_classes(docs).where("not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows are cut out; a text that loses nothing stays as it is, another becomes its kept words joined by one space."""
    cut = remove_repeated_windows(docs, carry=COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes once for each epoch that takes it, and once more if the last, partial one does; at the border of a budget a document stays whole."""
    taken = mix(docs, carry=COLUMNS).where("taken > 0").withColumn("copies", F.ceil(F.col("taken") / F.col("size")).cast("int"))
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The robust estimates of the first stage are iterative, so no SQL expresses the whole; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
