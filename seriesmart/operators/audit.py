"""The run table, written from a frame of run events instead of row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import has_label
from ..schemas import RUN_COMPLETION_COLUMNS, RUN_CRASH_COLUMNS, RUNS_KEY
from .aggregates import error_messages, outcome, run_rollup
from .merge import upsert_columns


def record_started(runs: DataFrame, started: DataFrame) -> DataFrame:
    """Insert 'running' rows; a run already present is left as it is."""
    return upsert_columns(runs, started.withColumn("status", F.lit("running")), RUNS_KEY)


def record_completed(runs: DataFrame, completed: DataFrame) -> DataFrame:
    """Complete runs, or insert them whole where the start was never recorded."""
    return upsert_columns(runs, completed, RUNS_KEY, RUN_COMPLETION_COLUMNS)


def record_crashed(runs: DataFrame, crashed: DataFrame) -> DataFrame:
    """Mark runs as crashed; their counts stay as they were."""
    return upsert_columns(
        runs, crashed.withColumn("status", F.lit("crashed")), RUNS_KEY, RUN_CRASH_COLUMNS
    )


def fold_events(events: DataFrame) -> DataFrame:
    """Final state of every run from its (run_id, event_time, status, ...) events.

    The latest event decides; on equal times a final status beats 'running',
    and 'running' beats 'unknown'. Keeps one row of state per run.
    """
    rank = F.when(F.col("status") == "unknown", 0).when(F.col("status") == "running", 1).otherwise(2)
    order = F.struct(F.col("event_time"), rank, F.col("status"))
    rest = [c for c in events.columns if c != "run_id"]
    folded = events.groupBy("run_id").agg(
        F.min("event_time").alias("started_at"), F.max_by(F.struct(*rest), order).alias("_last")
    )
    return folded.select("run_id", "started_at", *[F.col("_last")[c].alias(c) for c in rest])


def step_report(runs: DataFrame, results: DataFrame) -> DataFrame:
    """One compact row per run; retries summed over its results."""
    retries = results.groupBy("run_id").agg(
        F.sum(F.coalesce("retries", F.lit(0))).cast("long").alias("api_retries")
    )
    return (
        runs.join(retries, "run_id", "left")
        .withColumn("api_retries", F.coalesce("api_retries", F.lit(0).cast("long")))
        .withColumn("duration_seconds", F.timestamp_diff("SECOND", "started_at", "completed_at"))
        .select(
            "run_id",
            "pipeline",
            "status",
            "exit_code",
            "rows_changed",
            "duration_seconds",
            "parent_run_id",
            "api_retries",
        )
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Rollup, error message and exit code of every run from its series results."""
    return (
        run_rollup(results)
        .join(error_messages(results), "run_id", "left")
        .join(outcome(results), "run_id", "left")
    )


def jobs_with_label(jobs: DataFrame, key: str, pattern: str, labels: str = "labels") -> DataFrame:
    return jobs.filter(has_label(labels, key, pattern))
