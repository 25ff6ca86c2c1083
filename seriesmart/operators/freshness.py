"""Is the data recent enough, per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import by_frequency, hours_since, period_start
from .aggregates import latest_per_series
from .joins import lookup_join


def stale_series(observations: DataFrame, series: DataFrame, today: Column) -> DataFrame:
    """Series whose latest non-null date is too old for their frequency.

    Seven days for daily series; three and six months and two years from the
    start of the current period for the others. Other frequencies never go stale.
    """
    latest = latest_per_series(observations, by=["series_code"])
    named = lookup_join(
        latest, series.select("series_code", "series_name", "frequency"), "series_code", "inner"
    )
    threshold = by_frequency(
        "frequency",
        {
            "daily": F.date_sub(today, 7),
            "monthly": F.add_months(period_start(today, "month"), -3),
            "quarterly": F.add_months(period_start(today, "quarter"), -6),
            "annual": F.add_months(period_start(today, "year"), -24),
        },
    )
    return (
        named.withColumn("stale_before", threshold)
        .filter(F.col("latest_observation_date") < F.col("stale_before"))
        .select("series_code", "series_name", "frequency", "latest_observation_date", "stale_before")
    )


def cadence_rules(series: DataFrame) -> DataFrame:
    """Warn and error ages in hours by frequency; other frequencies get no rule."""
    # 72 / 120 hours for daily, 35 / 45 days for monthly series.
    warn = by_frequency("frequency", {"daily": F.lit(72), "monthly": F.lit(35 * 24)})
    error = by_frequency("frequency", {"daily": F.lit(120), "monthly": F.lit(45 * 24)})
    return series.select(
        "series_code", warn.alias("warn_after_hours"), error.alias("error_after_hours")
    ).filter(F.col("warn_after_hours").isNotNull())


def freshness(
    observations: DataFrame,
    rules: DataFrame,
    as_of: Column,
    loaded_at: str = "ingested_at",
) -> DataFrame:
    """Status of every rule: pass, warn or error by the age of the last load.

    A series that never loaded is an error. One pass for all series.
    """
    as_of = as_of.cast("timestamp")
    loaded = observations.groupBy("series_code").agg(F.max(loaded_at).alias("max_loaded_at"))
    joined = rules.join(loaded, "series_code", "left")
    hours = hours_since(as_of, "max_loaded_at")
    seconds = (F.unix_micros(as_of) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(1e6)
    status = (
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(seconds > F.col("error_after_hours") * 3600, "error")
        .when(seconds > F.col("warn_after_hours") * 3600, "warn")
        .otherwise("pass")
    )
    return joined.select(
        "series_code",
        "max_loaded_at",
        hours.alias("hours_since_loaded"),
        status.alias("status"),
    )
