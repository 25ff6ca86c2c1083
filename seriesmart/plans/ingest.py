"""Raw rows into the warehouse: validate, gate, canonicalise, merge, prune.

All series run in one plan; a series that fails its checks leaves the others
alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import timestamp_run_id
from ..operators.aggregates import first_seen_runs
from ..operators.canonical import canonical_observations
from ..operators.merge import backfill, evolve, merge_plan, register_runs, unconfigured
from ..operators.validate import checks, gate, profile, stage_counts
from ..schemas import OBSERVATIONS, OBSERVATIONS_KEY
from ..sources import tables


@dataclass(frozen=True)
class Ingested:
    """Frames of one ingestion: merge plan, rejected rows, checks, stage counts."""

    plan: DataFrame
    rejected: DataFrame
    checked: DataFrame
    counts: DataFrame


def ingest_observations(
    target: DataFrame,
    long: DataFrame,
    config: DataFrame,
    start: date,
    end: date,
    extracted_at: Column,
    ingested_at: Column,
    run_id: Column,
    source: str,
    explicit_window: bool = False,
) -> Ingested:
    checked = checks(profile(long, config, start, end), explicit_window)
    accepted, rejected = gate(long, checked, config)
    rows = canonical_observations(accepted, config, extracted_at, ingested_at, run_id, source)
    plan = merge_plan(target, rows, OBSERVATIONS_KEY)
    return Ingested(plan, rejected, checked, stage_counts(checked))


def ingest_into_table(
    spark: SparkSession,
    path: str,
    checks_path: str,
    long: DataFrame,
    config: DataFrame,
    start: date,
    end: date,
    extracted_at: Column,
    ingested_at: Column,
    run_id: Column,
    source: str,
    explicit_window: bool = False,
    prune: bool = False,
) -> dict[str, int]:
    """Ingest into a stored observation table; return its change counts.

    The checks of all series are kept at ``checks_path``: evidence for the
    rejected ones, and what the gate reads instead of profiling again. With
    ``prune``, rows of series not in ``config`` are deleted afterwards.
    """
    checks(profile(long, config, start, end), explicit_window).write.mode("overwrite").parquet(checks_path)
    accepted, _ = gate(long, spark.read.parquet(checks_path), config)
    rows = canonical_observations(accepted, config, extracted_at, ingested_at, run_id, source)
    counts = tables.merge_into_path(spark, path, rows, OBSERVATIONS_KEY)
    if prune:
        doomed = unconfigured(tables.stored(spark, path), config)
        pruned = tables.delete_from_path(spark, path, doomed, OBSERVATIONS_KEY)
        counts["deleted"] += pruned
        counts["rows_changed"] += pruned
    return counts


def backfill_windows(
    config: DataFrame,
    observations: DataFrame,
    start: date,
    end: date,
    key: str = "series_code",
) -> DataFrame:
    """Rows per series and calendar month, months without any included.

    Month membership is an equality on the month start, so all months run as
    one join instead of one job each.
    """
    first = F.trunc(F.lit(start), "month")
    months = F.sequence(first, F.lit(end), F.expr("INTERVAL 1 MONTH"))
    windows = config.select(key, F.explode(months).alias("window_start"))
    held = (
        observations.filter(F.col("observation_date").between(first, F.last_day(F.lit(end))))
        .groupBy(key, F.trunc("observation_date", "month").alias("window_start"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return windows.join(held, [key, "window_start"], "left").select(
        key,
        "window_start",
        F.last_day("window_start").alias("window_end"),
        F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
    )


def migrate(
    rows: DataFrame,
    runs: DataFrame,
    source: str,
    pipeline: str,
    target_table: str,
) -> tuple[DataFrame, DataFrame]:
    """(rows, runs) brought up to the current observation schema.

    Columns the rows lack are added and, only then, filled from what the rows
    recorded; runs thereby named are registered as unknown.
    """
    evolved, added = evolve(rows, OBSERVATIONS)
    legacy = {
        "ingested_at": F.col("extracted_at"),
        "ingestion_run_id": timestamp_run_id("extracted_at"),
    }
    fills = {c: expr for c, expr in legacy.items() if c in added}
    if not fills:
        return evolved, runs
    filled = backfill(evolved, fills)
    if "ingestion_run_id" in fills:
        runs = register_runs(runs, first_seen_runs(filled, runs), source, pipeline, target_table)
    return filled, runs
