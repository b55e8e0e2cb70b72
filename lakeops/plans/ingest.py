"""A batch from text to the stored table: structure, casts, rules, gate, rejects, stamps, partitions, sensitive columns, load, run history.

The source is read once. Its typed and flagged rows are written beside the table while they are counted (``observe``), and so are the rows with the rules they fail; the gate
looks at the counts, and only then is anything published. Nothing is cached, and a value is cast once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.casting import BAD, cast_split
from lakeops.functions.privacy import split_sensitive
from lakeops.operators import partitions, quality, silver, stats
from lakeops.operators.validate import CORRUPT, REJECTED_CORRUPTED, gate, is_wrong, outcome
from lakeops.schema import persisted_view, resolve_roles, stamp
from lakeops.scratch import delete, exists, scratch
from lakeops.sources import sinks
from lakeops.spec import LAST_CHANGES, PERMISSIVE, DatasetSpec

WRONG, TEXT = "_wrong", "_text"
SENSITIVE = "_sensitive"


class Ingested(NamedTuple):
    rows: DataFrame
    structural_rejects: DataFrame
    cast_rejects: DataFrame
    quality_rejects: DataFrame
    summary: DataFrame


@dataclass(frozen=True)
class Secrets:
    """What the sensitive columns are hidden with."""

    salt: str = field(repr=False)
    data_key: str = field(repr=False)
    master_key: str = field(repr=False)
    bits: int = 512


@dataclass(frozen=True)
class Lake:
    """Where a dataset's rows, rejects (by reason) and run history go, and the catalog name of its table. Without ``secrets`` sensitive columns are an error."""

    table: str
    rejects: str | None = None
    history: str | None = None
    secrets: Secrets | None = None
    catalog: tuple[str, str] | None = None
    write_failed: bool = True


@dataclass(frozen=True)
class Run:
    """A run of the pipeline. ``file``: the name of the landing file; ``batch``: the key of a batch that may come again; ``reprocess``: else told from the file's name and the history;
    ``by_hour``: partitions by the load's hour where neither file name nor date gives any."""

    run_id: str
    at: datetime
    file: str | None = None
    batch: str | None = None
    reprocess: str | None = None
    by_hour: bool = False


class Result(NamedTuple):
    outcome: str
    loaded: bool
    read: int
    wrong: int
    invalid: int
    failed: int


class AlreadyRunning(RuntimeError):
    """Another run of the dataset holds its lease."""


def flag(df: DataFrame, spec: DatasetSpec, typed: bool = False, text: str | None = None) -> DataFrame:
    """Every row with its typed values, what could not be cast, and whether the reader could take it apart: one select over the source."""
    wrong = is_wrong(df) if CORRUPT in df.columns else F.lit(False)
    return cast_split(df.withColumn(WRONG, wrong), spec.columns, typed, text).flagged


def judge(counts: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows of (read, wrong, total, invalid, failed) counts with the gate's verdict and the outcome's label."""
    gated = gate(counts, spec.validation_mode, spec.threshold, spec.threshold_kind, spec.quality_mode)
    structured = (F.col("read") > F.col("wrong")) & ((F.col("wrong") == 0) | F.lit(spec.validation_mode == PERMISSIVE))
    return gated.withColumn("outcome", outcome(structured, F.col("passed"), F.col("wrong") + F.col("invalid") + F.col("failed")))


def prepare(df: DataFrame, spec: DatasetSpec, typed: bool = False, write_failed: bool = True) -> Ingested:
    """The frames of a batch as plans, for callers that load by themselves; each use of one evaluates the source. ``summary``: one row of counts with verdict and label.

    ``write_failed``: rows that fail a quality rule are stored all the same (they count at the gate in reject mode)."""
    cast = flag(df, spec, typed)
    columns = [c for c in cast.columns if c not in (WRONG, BAD, CORRUPT)]
    good = cast.where(~F.col(WRONG) & (F.size(BAD) == 0)).select(*(F.col(f"`{c}`") for c in columns))
    flagged = quality.apply_rules(good, list(spec.rules))
    kept = flagged.drop(quality.FAILED) if write_failed else quality.passing(flagged)
    counts = cast.agg(F.count("*").alias("read"), F.count_if(WRONG).alias("wrong"), F.count_if(~F.col(WRONG)).alias("total"), F.count_if(~F.col(WRONG) & (F.size(BAD) > 0)).alias("invalid"))
    # two frames of one row; without rules the batch is counted once
    counts = counts.crossJoin(flagged.agg(F.count_if(F.size(quality.FAILED) > 0).alias("failed"))) if spec.rules else counts.withColumn("failed", F.lit(0).cast("long"))
    wrong = cast.where(WRONG).select(CORRUPT) if CORRUPT in cast.columns else cast.where(F.lit(False)).select(F.lit(None).cast("string").alias(CORRUPT))
    invalid = cast.where(~F.col(WRONG) & (F.size(BAD) > 0)).select(*(F.col(f"`{c}`") for c in columns), BAD)
    return Ingested(kept, wrong, invalid, quality.failing(flagged), judge(counts, spec))


def _written(df: DataFrame, path: str, **metrics) -> tuple[DataFrame, dict]:
    """``df`` as stored, and the metrics that were taken on the way."""
    seen = Observation()
    df.observe(seen, *(m.alias(n) for n, m in metrics.items())).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def reprocess_of(spark: SparkSession, spec: DatasetSpec, lake: Lake, run: Run) -> str:
    """Partial for ``.fix`` files, full for a file that the history has as ingested, else none."""
    if run.reprocess or not run.file:
        return run.reprocess or silver.NONE
    if ".fix" in run.file:
        return silver.PARTIAL
    if not lake.history or not exists(spark, lake.history):
        return silver.NONE
    runs = spark.read.schema(stats.RUN).parquet(lake.history)
    seen = runs.where((F.col("dataset") == spec.name) & (F.col("file") == run.file) & F.col("result").startswith("INGESTED") & (F.col("run_id") != run.run_id))
    return silver.NONE if seen.isEmpty() else silver.FULL


def run_batch(spark: SparkSession, df: DataFrame, spec: DatasetSpec, lake: Lake, run: Run | None = None, typed: bool = False) -> Result:
    """The whole lifecycle of a batch. With a history one run of a dataset works at a time (``AlreadyRunning`` otherwise), and its start, end, counts and outcome are recorded."""
    if spec.role("sensitive") and lake.secrets is None:
        raise ValueError(f"{spec.name} has sensitive columns and no secrets to hide them with")
    if run is None or lake.history is None:
        return _ingested(spark, df, spec, lake, run, typed)
    lease = f"{lake.history}/_leases/{spec.name}"
    if not stats.acquire(spark, lease, run.run_id):
        raise AlreadyRunning(spec.name)
    record = {"run_id": run.run_id, "dataset": spec.name, "file": run.file}
    try:
        stats.append_run(spark, lake.history, {**record, "state": stats.RUNNING, "at": run.at})
        try:
            result = _ingested(spark, df, spec, lake, run, typed)
        except Exception as failed:
            stats.append_run(spark, lake.history, {**record, "state": stats.DONE, "at": run.at, "result": REJECTED_CORRUPTED, "messages": [f"{type(failed).__name__}: {failed}"[:2000]]})
            raise
        structured = result.read - result.wrong
        cast = structured - result.invalid
        rows = (structured, result.wrong, cast, result.invalid, cast - result.failed, result.failed)
        stats.append_run(spark, lake.history, {**record, "state": stats.DONE, "at": run.at, "result": result.outcome, "rows": rows})
        return result
    finally:
        stats.release(spark, lease, run.run_id)


def _ingested(spark: SparkSession, df: DataFrame, spec: DatasetSpec, lake: Lake, run: Run | None, typed: bool) -> Result:
    where = scratch(spark, "ingest")
    bad = F.size(BAD) > 0
    cast, seen = _written(flag(df, spec, typed, TEXT), f"{where}/cast", read=F.count(F.lit(1)), wrong=F.count_if(WRONG), invalid=F.count_if(~F.col(WRONG) & bad))
    columns = [c for c in cast.columns if c not in (WRONG, BAD, TEXT, CORRUPT)]
    rows, failed = cast.where(~F.col(WRONG) & ~bad).select(*(F.col(f"`{c}`") for c in columns)), 0
    if spec.rules:
        flagged, checked = _written(quality.apply_rules(rows, list(spec.rules)), f"{where}/rules", failed=F.count_if(F.size(quality.FAILED) > 0))
        failed, rows = checked["failed"], flagged.drop(quality.FAILED) if lake.write_failed else quality.passing(flagged)
    counts = spark.createDataFrame([(seen["read"], seen["wrong"], seen["read"] - seen["wrong"], seen["invalid"], failed)], "read long, wrong long, total long, invalid long, failed long")
    verdict = judge(counts, spec).first()
    loads = verdict["passed"] and verdict["outcome"].startswith("INGESTED")
    if lake.rejects:
        mode = "append" if run is None or run.batch is None else "overwrite"
        base = lake.rejects if run is None or run.batch is None else f"{lake.rejects}/{run.batch}"
        if seen["wrong"]:
            sinks.write_rejects(cast.where(WRONG).select(CORRUPT), base, "schema_mismatch", "text", mode)
        if seen["invalid"]:
            fields = T.StructType([T.StructField(c.name, T.StringType()) for c in spec.columns if c.parent is None])
            sinks.write_rejects(cast.where(~F.col(WRONG) & bad).select(F.from_json(TEXT, fields).alias("t"), BAD).select("t.*", BAD), base, "invalid", mode=mode)
        if failed:
            sinks.write_rejects(quality.failing(flagged).select(F.to_json(F.struct(*columns)).alias("row"), quality.FAILED), base, "quality", "json", mode)
    if loads:
        _load(spark, rows, spec, lake, run)
    delete(spark, where)
    return Result(verdict["outcome"], loads, seen["read"], seen["wrong"], seen["invalid"], failed)


def _load(spark: SparkSession, rows: DataFrame, spec: DatasetSpec, lake: Lake, run: Run | None) -> None:
    roles = resolve_roles(spec)
    keys, timestamp = roles["primary_key"], next(iter(roles["timestamp"]), None)
    rows, levels = persisted_view(rows, spec), list(spec.partition_by)
    if run is not None:
        rows = stamp(rows, run.at, run.run_id)
        date = next((c.stored_name for c in spec.columns if c.partitionable and not c.ignore_persistence), None)
        by_file = bool(spec.file_pattern and run.file)
        if not levels and (by_file or date or run.by_hour):
            rows, levels = partitions.add(rows, F.lit(run.file) if by_file else None, spec.file_pattern if by_file else None, date, loaded=run.at)
    how = {"reprocess": silver.NONE if run is None else reprocess_of(spark, spec, lake, run), "allow_partition_change": spec.allow_partition_change, "batch": run and run.batch}
    if roles["sensitive"]:
        # one row a key before the split: both tables then have the same one
        rows = silver.latest_per_key(rows, keys, timestamp) if spec.load_mode == LAST_CHANGES else rows
        split = split_sensitive(rows, keys, roles["sensitive"], timestamp, lake.secrets.salt, lake.secrets.data_key, lake.secrets.master_key, lake.secrets.bits)
        silver.write(spark, lake.table + SENSITIVE, split.sensitive, spec.load_mode, ["_id"], timestamp, **how)
        rows = split.main
    silver.write(spark, lake.table, rows, spec.load_mode, keys, timestamp, levels, keep_history=spec.keep_history, **how)
    if lake.catalog:
        silver.register(spark, *lake.catalog, lake.table, create_database=True, refresh=True)


def ingest(spark: SparkSession, df: DataFrame, spec: DatasetSpec, path: str, typed: bool = False) -> str:
    """Loads a batch into a table, if the gate lets it pass, and gives the outcome's label."""
    return run_batch(spark, df, spec, Lake(path), typed=typed).outcome
