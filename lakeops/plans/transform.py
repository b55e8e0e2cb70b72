"""A gold run: stages, a quality report, the write, statistics, in one pass over the result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import quality, stats
from lakeops.operators.gold import Stage, run_stages, scope, with_params, write_table
from lakeops.operators.validate import INGESTED_WITH_ERRORS, INGESTED_WITHOUT_ERRORS


def transform(
    spark: SparkSession, name: str, source: DataFrame | None, stages: list[Stage], target: dict, rules: list | None = None, params: dict[str, object] | None = None, views: tuple[str, ...] = (),
    history: str | None = None, run_id: str = "", at: datetime | None = None, attempts: int = 3,
) -> list[str]:
    """Runs the stages and writes their result to ``target`` (the arguments of ``write_table``). Rows that fail a rule are written like the others, but each rule that some
    rows fail gives a message, counted while the result is written. With a ``history`` the run's counts and messages are appended to it; also those of a run that fails."""
    record = {"run_id": run_id, "dataset": name, "state": stats.DONE, "at": at}
    try:
        with scope(spark, views):
            result = run_stages(source, with_params(stages, params) if params else stages)
            seen, rules = Observation(), list(rules or [])
            flagged = quality.apply_rules(result, rules)
            counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(quality.FAILED) > 0).alias("failed"), *(F.count_if(F.array_contains(quality.FAILED, r.name)).alias(f"rule {r.name}") for r in rules)]
            write_table(flagged.observe(seen, *counts).drop(quality.FAILED), **target)
            found = seen.get
    except Exception as failed:
        if history:
            stats.append_run(spark, history, {**record, "result": type(failed).__name__, "messages": [str(failed)[:2000]]}, attempts)
        raise
    messages = [f"{r.name}: {found[f'rule {r.name}']} of {found['rows']} rows" for r in rules if found[f"rule {r.name}"]]
    if history:
        rows = (found["rows"], 0, found["rows"], 0, found["rows"] - found["failed"], found["failed"])
        stats.append_run(spark, history, {**record, "result": INGESTED_WITH_ERRORS if messages else INGESTED_WITHOUT_ERRORS, "rows": rows, "messages": messages}, attempts)
    return messages
