"""Raw rows to the canonical observation and series tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import lenient_date
from ..schemas import OBSERVATIONS, SERIES, conform
from .joins import lookup_join


def unpivot_wide(
    wide: DataFrame,
    ids: Sequence[str],
    series: Sequence[str],
    name: str = "series_name",
    value: str = "value",
) -> DataFrame:
    """One row per (ids, series) from one column per series."""
    return wide.unpivot(list(ids), list(series), name, value)


def canonical_observations(
    long: DataFrame,
    config: DataFrame,
    extracted_at: Column,
    ingested_at: Column,
    run_id: Column,
    source: str,
) -> DataFrame:
    """The eleven observation columns in their fixed order.

    ``long`` has series_name, observation_date and value; ``config`` has
    series_name, series_code, frequency and unit. The times and the run id may
    be literals or columns of ``long``.
    """
    stamped = long.select(
        "series_name",
        lenient_date("observation_date").alias("observation_date"),
        "value",
        F.to_date(extracted_at).alias("extraction_date"),
        extracted_at.alias("extracted_at"),
        ingested_at.alias("ingested_at"),
        run_id.alias("ingestion_run_id"),
        F.lit(source).alias("source"),
    )
    attributes = config.select("series_name", "series_code", "frequency", "unit")
    return conform(lookup_join(stamped, attributes, "series_name", "inner"), OBSERVATIONS)


def canonical_series(
    catalog: DataFrame,
    curated: DataFrame,
    extracted_at: Column,
    run_id: Column,
    source: str,
) -> DataFrame:
    """The fifteen series columns: source catalog joined to curated metadata.

    A code that the catalog repeats, or that has no curated entry, fails the
    job; unreadable dates become NULL.
    """
    # Grouping on the code combines before the shuffle, however often one repeats.
    fields = [c for c in catalog.columns if c != "series_code"]
    single = catalog.groupBy("series_code").agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in fields]
    )
    entries = curated.withColumn("_curated", F.lit(True))
    joined = single.join(entries, "series_code", "left")
    problem = F.when(
        F.col("_n") > 1, F.concat(F.lit("duplicate series code in catalog: "), F.col("series_code"))
    ).when(
        F.col("_curated").isNull(), F.concat(F.lit("no curated metadata for "), F.col("series_code"))
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(True)
    shaped = joined.filter(checked).select(
        "series_code",
        "series_name",
        "description",
        "category",
        F.lower("frequency_code").alias("frequency"),
        "unit",
        F.col("spanish_title").alias("source_title_es"),
        F.col("english_title").alias("source_title_en"),
        lenient_date("first_observation").alias("first_observation_date"),
        lenient_date("last_observation").alias("last_observation_date"),
        lenient_date("updated_at").alias("source_updated_date"),
        F.to_date(extracted_at).alias("extraction_date"),
        extracted_at.alias("extracted_at"),
        F.lit(source).alias("source"),
        run_id.alias("ingestion_run_id"),
    )
    return conform(shaped, SERIES)
