"""Star schema: series and calendar dimensions, observation fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import date_key, day_name, is_weekend, month_name
from ..functions.text import surrogate_key
from ..operators.aggregates import bounds, high_water_mark
from ..operators.joins import fact_with_dims
from ..operators.merge import delete_stale, differing_months, merge_apply, merge_plan, stale_rows
from ..session import folder_names
from ..sources import tables

FACT_KEY = ("series_key", "observation_date")
# Beside the month folders; readers pass over names that start with an underscore.
MARK = "_mark"


def dim_series(staging_series: DataFrame) -> DataFrame:
    return staging_series.select(
        surrogate_key("series_code").alias("series_key"),
        "series_code",
        "series_name",
        "series_description",
        "category",
        "frequency",
        "unit",
        "source",
        "first_observation_date",
        "last_observation_date",
    )


def dim_date(staging_observations: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last observation."""
    span = bounds(staging_observations).filter(F.col("min_date").isNotNull())
    days = span.select(F.explode(F.sequence("min_date", "max_date")).alias("date_day"))
    day = F.col("date_day")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        month_name(day).alias("month_name"),
        day_name(day).alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    )


def fact_rows(staging_observations: DataFrame, series: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows of the given observations; those without a value are none."""
    present = staging_observations.filter(F.col("value").isNotNull())
    return fact_with_dims(present, series, dates).select(
        "series_key", "date_key", "observation_date", "value", "extracted_at", "ingestion_run_id"
    )


def since_high_water_mark(staging_observations: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows that arrived after everything the fact holds, at any observation date."""
    mark = high_water_mark(fact).scalar()
    return staging_observations.filter(F.col("extracted_at") > mark)


def incremental_fact(
    fact: DataFrame,
    staging_observations: DataFrame,
    series: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """The fact after one incremental build: drop stale rows, merge the new ones.

    Equals full_fact as long as every change arrives with a later extracted_at.
    New rows are never stale, so the stale delete runs first: its semi join and
    the merge share one partitioning of the fact. Rows without a series are
    dropped at once, as the stale delete would do.
    """
    news = fact_rows(since_high_water_mark(staging_observations, fact), series, dates)
    news = news.filter(F.col("series_key").isNotNull())
    survivors = delete_stale(fact, staging_observations, series)
    return merge_apply(merge_plan(survivors, news, FACT_KEY, audit_columns=(), update="always"))


def build_fact_table(
    spark: SparkSession,
    path: str,
    staging_observations: DataFrame,
    series: DataFrame,
    dates: DataFrame,
) -> dict[str, int]:
    """One incremental build of a stored fact; return its change counts.

    What is news is told by a mark kept beside the table's months, the latest
    arrival of the last build that was finished. It moves after the merge and the
    delete, so a build that was broken off at any point is made good by the next
    one. Without a mark everything is compared in one plan, which finds stale rows too.
    Months without news or stale rows are neither rewritten nor, for the merge, read;
    stale rows are looked for in months whose keys differ from staging's.
    """
    mark = _mark(spark, path)
    latest = high_water_mark(staging_observations).head()[0]
    if mark is None:
        every = fact_rows(staging_observations, series, dates).filter(F.col("series_key").isNotNull())
        counts = tables.sync_into_path(spark, path, every, FACT_KEY, audit_columns=(), cluster="series_key")
    else:
        recent = staging_observations.filter(F.col("extracted_at") > F.lit(mark))
        counts = _merge_recent(spark, path, recent, staging_observations, series, dates)
    spark.createDataFrame([(latest,)], "mark timestamp").coalesce(1).write.mode("overwrite").parquet(f"{path}/{MARK}")
    return counts


def _merge_recent(
    spark: SparkSession, path: str, recent: DataFrame, staging_observations: DataFrame, series: DataFrame, dates: DataFrame
) -> dict[str, int]:
    """Merge what is news, then delete what is stale."""
    news = fact_rows(recent, series, dates).filter(F.col("series_key").isNotNull())
    counts = tables.merge_into_path(
        spark, path, news, FACT_KEY, audit_columns=(), update="changed", cluster="series_key"
    )
    merged = tables.stored(spark, path, news.schema)
    months = [r[0] for r in differing_months(merged.drop(tables.MONTH), staging_observations, series).collect()]
    touched = merged.filter(F.col(tables.MONTH).isin(months)).drop(tables.MONTH)
    live = staging_observations.filter(F.date_format("observation_date", "yyyy-MM").isin(months))
    stale = stale_rows(touched, live, series)
    counts["deleted"] = tables.delete_from_path(spark, path, stale, FACT_KEY, cluster="series_key")
    counts["rows_changed"] += counts["deleted"]
    return counts


def _mark(spark: SparkSession, path: str):
    """The mark of the last finished build; None if there is none to be read."""
    if "_SUCCESS" not in folder_names(spark, f"{path}/{MARK}"):
        return None
    return spark.read.schema("mark timestamp").parquet(f"{path}/{MARK}").head()[0]


def full_fact(staging_observations: DataFrame, series: DataFrame, dates: DataFrame) -> DataFrame:
    rows = fact_rows(staging_observations, series, dates)
    return rows.filter(F.col("series_key").isNotNull())
