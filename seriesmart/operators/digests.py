"""Reconciliation of two large relations by a tree of digests.

Rows are counted and their hashes summed per month and key range, in partial aggregates
before anything moves. Month sums come from the sums of their ranges. Ranges that agree
hold the same rows, so only rows of differing ranges are looked at, and joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Key ranges a month: leaves of the tree under each of its months.
RANGES = 256


def _leaf(keys: Sequence[str], day: str | None, ranges: int) -> list[Column]:
    """The leaf a row belongs to: the month of its day, and a range of hashed keys."""
    month = F.date_format(day, "yyyy-MM") if day else F.lit("all")
    return [month.alias("_month"), F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int").alias("_range")]


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def tree(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], columns: Sequence[str],
    day: str | None = None, ranges: int = RANGES,
) -> DataFrame:
    """One row a leaf: _month, _range, n_expected, n_actual, differs and month_differs.

    A leaf agrees if both sides have as many rows with the same sum of hashes over
    ``keys`` and ``columns``; sums, not exclusive ors, so repeated rows count. Rows with a
    NULL key are in no leaf.
    """
    def side(rows: DataFrame, mark: int) -> DataFrame:
        return rows.filter(~_any_null(keys)).select(
            *_leaf(keys, day, ranges), F.xxhash64(*keys, *columns).cast("decimal(20,0)").alias("_h"), F.lit(mark).alias("_side")
        )

    def sums(mark: int) -> list[Column]:
        name = ("expected", "actual")[mark]
        of = F.col("_side") == mark
        return [F.count_if(of).alias(f"n_{name}"), F.coalesce(F.sum(F.when(of, F.col("_h"))), F.lit(0)).alias(f"_h_{name}")]

    leaves = side(expected, 0).unionAll(side(actual, 1)).groupBy("_month", "_range").agg(*sums(0), *sums(1))
    differs = (F.col("n_expected") != F.col("n_actual")) | (F.col("_h_expected") != F.col("_h_actual"))
    # A month has as many leaves as there are ranges.
    whole = F.max("differs").over(Window.partitionBy("_month"))
    return leaves.withColumn("differs", differs).select(
        "_month", "_range", "n_expected", "n_actual", "differs", whole.alias("month_differs")
    )


def narrowed(rows: DataFrame, leaves: DataFrame, keys: Sequence[str], day: str | None = None, ranges: int = RANGES) -> DataFrame:
    """The rows of the differing ``leaves``. Rows with a NULL key are in none.

    Differing leaves are few where relations mostly agree; adaptive execution then
    broadcasts them, and no row moves to find out that it is not needed.
    """
    doubtful = leaves.filter("differs").select("_month", "_range")
    placed = rows.filter(~_any_null(keys)).select("*", *_leaf(keys, day, ranges))
    return placed.join(doubtful, ["_month", "_range"], "left_semi").select(*rows.columns)


def reconcile(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str, lineage: str,
    day: str | None = None, ranges: int = RANGES, leaves: DataFrame | None = None,
) -> DataFrame:
    """Rows where two relations disagree on (keys), with the kind of difference.

    Both relations are read twice: for the digests, reading only their columns, and for
    the rows of differing leaves. ``leaves`` is a stored ``tree`` of the same arguments.
    A row with a NULL key has no counterpart and is an issue without meeting the other
    side. NULL equals NULL and NaN equals NaN. Repeated keys are compared each with each.
    """
    keys = list(keys)
    columns = [value, lineage]
    leaves = tree(expected, actual, keys, columns, day, ranges) if leaves is None else leaves

    def named(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*keys, F.col(value).alias(f"{side}_value"), F.col(lineage).alias(f"{side}_lineage"), F.lit(True).alias(f"_{side}"))

    left = named(narrowed(expected, leaves, keys, day, ranges), "expected")
    right = named(narrowed(actual, leaves, keys, day, ranges), "actual")
    issue = (
        F.when(F.col("_actual").isNull(), "missing from fact")
        .when(F.col("_expected").isNull(), "not in staging")
        .when(~F.col("expected_value").eqNullSafe(F.col("actual_value")), "value differs")
        .when(~F.col("expected_lineage").eqNullSafe(F.col("actual_lineage")), "ingestion run differs")
    )
    compared = left.join(right, keys, "full_outer")
    alone = named(expected.filter(_any_null(keys)), "expected").unionByName(
        named(actual.filter(_any_null(keys)), "actual"), allowMissingColumns=True
    )
    return (
        compared.unionByName(alone).withColumn("issue", issue).filter(F.col("issue").isNotNull()).drop("_expected", "_actual")
    )


def month_summary(leaves: DataFrame) -> DataFrame:
    """Per month: rows on either side, leaves, leaves that differ."""
    return leaves.groupBy(F.col("_month").alias("month")).agg(
        F.sum("n_expected").alias("n_expected"), F.sum("n_actual").alias("n_actual"), F.max("differs").alias("differs")
    )


def symmetric_difference(left: DataFrame, right: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """Values of ``key`` on one side only, with ``side`` left or right; NULL is a value.

    Both sides are made distinct first, and only ranges of values that differ are joined.
    """
    a, b = (rows.select(key).distinct() for rows in (left, right))
    leaves = tree(a, b, [key], [], ranges=ranges)
    x = narrowed(a, leaves, [key], ranges=ranges).withColumn("_left", F.lit(True))
    y = narrowed(b, leaves, [key], ranges=ranges).withColumn("_right", F.lit(True))
    joined = x.join(y, [key], "full_outer").filter("_left IS NULL OR _right IS NULL")
    # At most one NULL a side after the distinct.
    unset = a.filter(F.col(key).isNull()).withColumn("side", F.lit("left")).unionByName(
        b.filter(F.col(key).isNull()).withColumn("side", F.lit("right"))
    )
    alone = unset.groupBy(key).agg(F.min("side").alias("side"), F.count("*").alias("_n")).filter("_n = 1")
    return joined.select(key, F.when(F.col("_left"), "left").otherwise("right").alias("side")).unionByName(alone.select(key, "side"))
