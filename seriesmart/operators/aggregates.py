"""Rollups. All of them combine before the shuffle; none collects a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import MESSAGE_LIMIT, short_message

# Process outcomes.
OUTCOME_SUCCESS, OUTCOME_FAILURE, OUTCOME_RETRY = 0, 1, 75
EPOCH = "1900-01-01 00:00:00"


def bounds(rows: DataFrame, day: str = "observation_date") -> DataFrame:
    """First and last date over all rows, those without a value included."""
    return rows.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def latest_per_series(
    observations: DataFrame,
    by: Sequence[str] = ("series_code", "series_name", "frequency"),
    day: str = "observation_date",
    value: str = "value",
) -> DataFrame:
    return (
        observations.filter(F.col(value).isNotNull())
        .groupBy(*by)
        .agg(F.max(day).alias("latest_observation_date"))
    )


def high_water_mark(table: DataFrame, column: str = "extracted_at") -> DataFrame:
    """One row: the latest instant, or an instant before all data if the table is empty."""
    return table.agg(
        F.coalesce(F.max(column), F.lit(EPOCH).cast("timestamp")).alias("high_water_mark")
    )


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def run_rollup(results: DataFrame, by: str = "run_id") -> DataFrame:
    """One row per run: summed stage counts, results per status, overall status."""

    def total(column: str, name: str) -> Column:
        return F.sum(F.coalesce(F.col(column), F.lit(0))).cast("long").alias(name)

    def of_status(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(f"{status}_count")

    rolled = results.groupBy(by).agg(
        total("row_count", "extracted_rows"),
        total("valid_rows", "valid_rows"),
        total("rejected_rows", "rejected_rows"),
        total("loaded_rows", "loaded_rows"),
        total("rows_changed", "rows_changed"),
        F.count(F.lit(1)).alias("total_series"),
        of_status("success"),
        of_status("quality_failed"),
        of_status("technical_failed"),
    )
    clean = (F.col("quality_failed_count") == 0) & (F.col("technical_failed_count") == 0)
    return rolled.withColumn("status", F.when(clean, "success").otherwise("failed"))


def failure_text() -> Column:
    """``series: status (reason)`` of one failed result."""
    reason = F.coalesce(
        F.nullif("error", F.lit("")),
        F.nullif(F.concat_ws(", ", "failed_checks"), F.lit("")),
        F.lit("no detail"),
    )
    return F.concat(
        F.coalesce(F.col("series_name"), F.lit("None")),
        F.lit(": "),
        F.coalesce(F.col("status"), F.lit("None")),
        F.lit(" ("),
        reason,
        F.lit(")"),
    )


def error_messages(results: DataFrame, by: str = "run_id", position: str = "position") -> DataFrame:
    """One capped message per run naming its failed series in order.

    The cap makes this a top-k: an entry takes at least six characters and its
    separator two, so the first MESSAGE_LIMIT / 8 + 1 failures of a run already
    fill the message, and later ones cannot change it. Ranking goes by salted
    groups first, so a run with very many failures is not sorted in one task.
    """
    enough = MESSAGE_LIMIT // 8 + 1
    failed = results.filter(~F.col("status").eqNullSafe("success")).select(
        by,
        position,
        failure_text().alias("_text"),
        F.pmod(F.xxhash64(position, "series_name"), F.lit(64)).alias("_salt"),
    )
    salted = Window.partitionBy(by, "_salt").orderBy(position, "_text")
    whole = Window.partitionBy(by).orderBy(position, "_text")
    first = failed.withColumn("_rank", F.row_number().over(salted)).filter(F.col("_rank") <= enough)
    first = first.withColumn("_rank", F.row_number().over(whole)).filter(F.col("_rank") <= enough)
    joined = first.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_text"))).alias("_entries")
    )
    message = F.array_join(F.transform("_entries", lambda e: e["_text"]), "; ")
    return joined.select(by, short_message(message).alias("error_message"))


def outcome(results: DataFrame, by: str | None = "run_id") -> DataFrame:
    """Exit code per run: 0, 75 if every failure may be retried, else 1. A NULL
    status is a failure."""
    failed = ~F.col("status").eqNullSafe("success")
    code = (
        F.when(F.count_if(failed) == 0, OUTCOME_SUCCESS)
        .when(
            F.count_if(failed & ~F.coalesce(F.col("retryable"), F.lit(False))) == 0,
            OUTCOME_RETRY,
        )
        .otherwise(OUTCOME_FAILURE)
        .cast("long")
        .alias("exit_code")
    )
    return results.groupBy(*([by] if by else [])).agg(code)


def combined_outcome(steps: DataFrame, by: str, code: str = "exit_code") -> DataFrame:
    """The worst code of several steps: permanent, then transient, then success. A
    step without a code failed for good."""
    known = F.coalesce(F.col(code), F.lit(OUTCOME_FAILURE))
    combined = (
        F.when(F.count_if(known != OUTCOME_SUCCESS) == 0, OUTCOME_SUCCESS)
        .when(F.count_if(~known.isin(OUTCOME_SUCCESS, OUTCOME_RETRY)) == 0, OUTCOME_RETRY)
        .otherwise(OUTCOME_FAILURE)
        .cast("long")
        .alias(code)
    )
    return steps.groupBy(by).agg(combined)


def strict_sum(column: str) -> Column:
    """Sum that is NULL as soon as one summand is."""
    return F.when(F.count_if(F.col(column).isNull()) == 0, F.sum(column).cast("long"))


def status_counts(
    results: DataFrame,
    by: str,
    statuses: Sequence[str] = ("pass", "warn", "error"),
    status: str = "status",
) -> DataFrame:
    """One row per group and status with its count: every status that occurs, NULL
    included, and zero rows for those of ``statuses`` that do not."""
    counted = results.groupBy(by, status).agg(F.count(F.lit(1)).alias("n"))
    expected = F.explode(F.array(*[F.lit(s) for s in statuses])).alias("_status")
    zeros = results.select(by).distinct().select(F.col(by).alias("_by"), expected)
    missing = zeros.join(
        counted.select(F.col(by).alias("_known"), F.col(status).alias("_seen")),
        F.col("_by").eqNullSafe(F.col("_known")) & (F.col("_status") == F.col("_seen")), "left_anti",
    )
    return counted.unionByName(
        missing.select(F.col("_by").alias(by), F.col("_status").alias(status), F.lit(0).cast("long").alias("n"))
    )


def first_seen_runs(
    rows: DataFrame,
    registered: DataFrame,
    run_id: str = "ingestion_run_id",
    at: str = "extracted_at",
) -> DataFrame:
    """First instant of every run id in the rows that the run table lacks."""
    seen = rows.filter(F.col(run_id).isNotNull()).groupBy(run_id).agg(F.min(at).alias("started_at"))
    known = registered.select(F.col("run_id").alias(run_id))
    return seen.join(known, run_id, "left_anti").withColumnRenamed(run_id, "run_id")


def catalog_matches(config: DataFrame, catalog: DataFrame, key: str = "series_code") -> DataFrame:
    """Catalog rows per configured series: 0, 1 or more."""
    counted = catalog.groupBy(key).agg(F.count(F.lit(1)).alias("match_count"))
    return config.join(counted, key, "left").withColumn(
        "match_count", F.coalesce(F.col("match_count"), F.lit(0).cast("long"))
    )


def history(runs: DataFrame, source: str) -> DataFrame:
    """Audit rows of a source with their duration, newest first."""
    return (
        runs.filter(F.col("source") == source)
        .withColumn("duration_seconds", F.timestamp_diff("SECOND", "started_at", "completed_at"))
        .orderBy(F.col("started_at").desc(), "run_id")
    )
