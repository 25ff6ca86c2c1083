"""Row predicates that do not move data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from .joins import lookup_join


def non_null(observations: DataFrame, value: str = "value") -> DataFrame:
    return observations.filter(F.col(value).isNotNull())


def configured_only(rows: DataFrame, config: DataFrame, key: str = "series_code") -> DataFrame:
    return lookup_join(rows, config.select(key).distinct(), key, "left_semi")


def resolve_end(end: date | None, as_of: date) -> date:
    return end or as_of


def in_window(rows: DataFrame, start: date, end: date, day: str = "observation_date") -> DataFrame:
    """Rows dated within the inclusive window; a plain comparison with
    literals, so partitions and row groups outside it are not read."""
    if start > end:
        raise ValueError(f"start date {start} is after end date {end}")
    return rows.filter(F.col(day).between(F.lit(start), F.lit(end)))


def out_of_range(
    rows: DataFrame,
    rules: DataFrame,
    key: str = "series_code",
    value: str = "value",
) -> DataFrame:
    """Values outside their series' bounds, all series in one pass.

    Rules: (key, lo, hi, lo_inclusive, hi_inclusive); a NULL bound is open.
    ``*_inclusive`` says whether the bound itself is allowed. NULL and NaN pass:
    no comparison with NaN holds, and finite values are another rule's matter.
    """
    v = F.col(value)
    below = F.when(F.col("lo_inclusive"), v < F.col("lo")).otherwise(v <= F.col("lo"))
    above = F.when(F.col("hi_inclusive"), v > F.col("hi")).otherwise(v >= F.col("hi"))
    violated = ~F.isnan(v) & (F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False)))
    ruled = lookup_join(rows.filter(v.isNotNull()), rules, key, "inner")
    return ruled.filter(violated).select(*rows.columns)


def differs(left: Column | str, right: Column | str) -> Column:
    """NULL-safe inequality."""
    left = F.col(left) if isinstance(left, str) else left
    right = F.col(right) if isinstance(right, str) else right
    return ~left.eqNullSafe(right)


def not_in_list(rows: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """Rows whose key is not in a list held by a DataFrame; a NULL in the list excludes nothing."""
    listed = excluded.select(key).filter(F.col(key).isNotNull()).distinct()
    return lookup_join(rows, listed, key, "left_anti")
