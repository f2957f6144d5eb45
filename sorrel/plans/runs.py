"""Runs in stages that go on where they stopped: every stage's result as a table, and a manifest of what is done.

A run is a folder. A stage's result is written under its attempt, and counts once a record of it is in the manifest, so a
run that ends at any moment repeats at most one stage. Records are only added; the newest of a stage says how it stands.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

RECORD = "stage string, position int, attempt int, status string, n_rows long, message string, settings string"
DONE, FAILED = "done", "failed"

Results = Mapping[str, DataFrame]
Stage = tuple[str, Callable[[Results], DataFrame]]


def status(spark: SparkSession, path: str) -> DataFrame:
    """One row per stage that was started: stage, position, status, attempts, n_rows, message."""
    try:
        records = spark.read.schema(RECORD).json(f"{path}/manifest")
    except AnalysisException:
        records = spark.createDataFrame([], RECORD)
    newest = F.max_by(F.struct("position", "status", "n_rows", "message", "settings"), "attempt")
    rows = records.groupBy("stage").agg(newest.alias("r"), F.max("attempt").alias("attempts"))
    return rows.select("stage", "r.position", "r.status", "attempts", "r.n_rows", "r.message", "r.settings")


def _record(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], RECORD).coalesce(1).write.mode("append").json(f"{path}/manifest")


def run_stages(spark: SparkSession, path: str, stages: Sequence[Stage], settings: Mapping = {}) -> dict[str, DataFrame]:
    """Results of all stages, each a function of the results before it.

    Stages that are done are read back and not run again. A failing stage is recorded with its message and raises; a later
    call goes on with it. A run keeps its settings: a call with others is refused.
    """
    wanted = json.dumps(dict(settings), sort_keys=True, default=str)
    # one row per stage
    known: dict[str, Row] = {r.stage: r for r in status(spark, path).collect()}
    changed = sorted(name for name, r in known.items() if r.settings != wanted)
    if changed:
        raise ValueError(f"the run at {path} was started with other settings (stages {', '.join(changed)})")
    results: dict[str, DataFrame] = {}
    for position, (name, stage) in enumerate(stages):
        row = known.get(name)
        attempt = row.attempts if row and row.status == DONE else (row.attempts if row else 0) + 1
        target = f"{path}/results/{name}/attempt-{attempt}"
        if not (row and row.status == DONE):
            try:
                stage(results).write.mode("overwrite").parquet(target)
                n_rows = spark.read.parquet(target).count()
            except Exception as e:
                _record(spark, path, (name, position, attempt, FAILED, None, str(e).splitlines()[0][:500] if str(e) else type(e).__name__, wanted))
                raise
            _record(spark, path, (name, position, attempt, DONE, n_rows, None, wanted))
        results[name] = spark.read.parquet(target)
    return results
