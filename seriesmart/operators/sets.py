"""Set operations over relations and column lists."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def except_codes(left: DataFrame, right: DataFrame, key: str = "series_code") -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def unmonitored(series: DataFrame, rules: DataFrame, key: str = "series_code") -> DataFrame:
    """Series without a freshness rule; with no rules at all, every series."""
    return series.join(rules.select(key).distinct(), key, "left_anti")


def column_differences(actual: Iterable[str], expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """(missing, unexpected) column names, both sorted; metadata only."""
    actual, expected = set(actual), set(expected)
    return sorted(expected - actual), sorted(actual - expected)


def sorted_codes(rows: DataFrame, key: str = "series_code") -> DataFrame:
    """Distinct codes in order, as rows: a list of any length stays distributed."""
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key)
