"""Joins of a large row set against lookups, history and other large row sets.

Lookup joins are plain equi-joins: adaptive execution broadcasts a lookup that was
measured to be small and splits skewed keys of the large side. What it cannot do is
spread rows whose key is NULL, as they match nothing; they get a number of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str] | str,
    how: str = "left",
    condition: Column | None = None,
) -> DataFrame:
    """Join ``rows`` to a lookup keyed by ``on``.

    ``how`` is inner, left, left_semi or left_anti. ``condition`` is a residual
    predicate over both sides' columns, on top of the equal keys. The large side
    is read once. For left and left_anti, rows with a NULL key are dealt out by
    their other columns instead of meeting in one task.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported lookup join: {how}")
    added = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in on]
    keys = on
    left, right = rows, lookup
    types = [{f.name: f.dataType for f in frame.schema.fields} for frame in (rows, lookup)]
    others = [c for c in rows.columns if c not in on]
    # Both sides hash their keys, so the optimizer cannot fold the extra key away.
    if how in ("left", "left_anti") and others and all(types[0][c] == types[1][c] for c in on):
        unkeyed = F.lit(False)
        for c in on:
            unkeyed = unkeyed | F.col(c).isNull()
        left = rows.withColumn("_spread", F.when(unkeyed, F.xxhash64(*others)).otherwise(F.xxhash64(*on)))
        right = lookup.withColumn("_spread", F.xxhash64(*on))
        keys = [*on, "_spread"]
    return _join(left, right, keys, how, condition).select(*rows.columns, *added)


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, condition: Column | None) -> DataFrame:
    if condition is None:
        return left.join(right, on, how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    predicate = condition
    for c in on:
        predicate = predicate & (F.col(c) == F.col(f"_r_{c}"))
    joined = left.join(renamed, predicate, how)
    return joined.drop(*[f"_r_{c}" for c in on])


def fact_with_dims(
    observations: DataFrame,
    dim_series: DataFrame,
    dim_date: DataFrame,
    code: str = "series_code",
    day: str = "observation_date",
) -> DataFrame:
    """Add series_key and date_key; a row without a match keeps NULL keys."""
    series = dim_series.select(code, "series_key")
    dates = dim_date.select(F.col("date_day").alias(day), "date_key")
    return lookup_join(lookup_join(observations, series, code), dates, day)


def missing_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents no child refers to. Child keys are reduced before they move."""
    present = children.filter(F.col(key).isNotNull()).select(key).distinct()
    return parents.join(present, key, "left_anti")


def orphans(
    children: DataFrame,
    parents: DataFrame,
    child_key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Children whose key has no parent. A NULL key is not an orphan."""
    known = (
        parents.select(F.col(parent_key or child_key).alias(child_key))
        .filter(F.col(child_key).isNotNull())
        .distinct()
    )
    return lookup_join(children.filter(F.col(child_key).isNotNull()), known, child_key, "left_anti")


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    value: str,
    lineage: str,
) -> DataFrame:
    """Rows where two relations disagree on (keys), with the kind of difference.

    Markers, not NULL keys, tell which side is present. NaN equals NaN.
    """
    keys = list(keys)
    left = expected.select(
        *keys,
        F.col(value).alias("expected_value"),
        F.col(lineage).alias("expected_lineage"),
        F.lit(True).alias("_expected"),
    )
    right = actual.select(
        *keys,
        F.col(value).alias("actual_value"),
        F.col(lineage).alias("actual_lineage"),
        F.lit(True).alias("_actual"),
    )
    value_differs = F.col("expected_value") != F.col("actual_value")
    lineage_differs = ~F.col("expected_lineage").eqNullSafe(F.col("actual_lineage"))
    issue = (
        F.when(F.col("_actual").isNull(), "missing from fact")
        .when(F.col("_expected").isNull(), "not in staging")
        .when(value_differs, "value differs")
        .when(lineage_differs, "ingestion run differs")
    )
    return (
        left.join(right, keys, "full_outer")
        .withColumn("issue", issue)
        .filter(F.col("issue").isNotNull())
        .drop("_expected", "_actual")
    )


def with_run(rows: DataFrame, runs: DataFrame, run_id: str = "ingestion_run_id") -> DataFrame:
    """Attach the run record that wrote each row."""
    return lookup_join(rows, runs.withColumnRenamed("run_id", run_id), run_id)
