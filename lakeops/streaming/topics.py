"""Event topics: payload decoding, run-once drains with a checkpoint, and streamed batches through a batch pipeline."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.validate import CORRUPT
from lakeops.plans.ingest import Lake, Run, run_batch
from lakeops.sources.sinks import CODECS
from lakeops.spec import DatasetSpec


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", per_batch: int = 5000, **security) -> DataFrame:
    """The stream of a Kafka topic (needs Spark's Kafka package); ``security``: further options, such as SASL settings. Records that are gone before they were read are an error;
    whoever can do without them says so (``failOnDataLoss="false"``)."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": per_batch} | security
    return spark.readStream.format("kafka").options(**options).load()


def decode_json_events(df: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON payloads as typed columns; a payload that does not parse has its text in ``_corrupt_record``."""
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    event = F.from_json(F.col(value).cast("string"), fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select(*(keep or []), event.alias("event")).select(*(keep or []), "event.*")


def decode_avro_events(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Avro payloads; the schema is a JSON text that the caller has (needs Spark's Avro package)."""
    from pyspark.sql.avro.functions import from_avro

    return df.select(from_avro(F.col(value), schema).alias("event")).select("event.*")


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", compression: str | None = None) -> None:
    """Writes what has arrived since the last drain and stops; the checkpoint remembers where. ``compression``: else the format's usual codec."""
    writer = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).option("compression", compression or CODECS[fmt])
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def ingest(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Every micro-batch through ``batch(frame, id)``; an empty one is skipped. A batch may come twice after a failure, so
    ``batch`` should be idempotent: an upsert, or an append whose path holds the id."""

    def run(df: DataFrame, number: int) -> None:
        if not df.isEmpty():
            batch(df, number)

    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batch_key(checkpoint: str, number: int) -> str:
    """The name of a stream's batch, the same one whenever it comes."""
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{number}"


def ingest_dataset(stream: DataFrame, spec: DatasetSpec, lake: Lake, checkpoint: str, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc), typed: bool = False) -> None:
    """Every micro-batch through the batch pipeline, partitioned by the load's hour unless the dataset says otherwise. A batch that comes again after a failure leaves no second copy:
    appends go by its key, the other loads give the same table."""

    def load(df: DataFrame, number: int) -> None:
        key = batch_key(checkpoint, number)
        run_batch(df.sparkSession, df, spec, lake, Run(key, clock(), batch=key, by_hour=True), typed)

    ingest(stream, load, checkpoint)
