"""Monthly summaries kept beside a stored table, true after every merge and delete.

A summary is a function of the rows of whole months that gives rows of the same months;
it is stored like its table, one folder a month. A batch makes only the months it
touches anew. Before the table changes, those months are written down beside it, and
struck off when the summaries are done: a job broken off in between is made good by the
next merge, delete or ``settle``. One writer at a time per table, as for the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import folder_names, remove_folder, staged
from . import tables
from .tables import MONTH

PENDING, BUILT = "_pending-", "_built-"


@dataclass(frozen=True)
class Summary:
    """``build`` takes rows with their month and returns rows with their month, lazily."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    cluster: str = "series_code"


def _home(path: str) -> str:
    return f"{path}_summaries"


def merge(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], summaries: Sequence[Summary],
    day: str = "observation_date", **options,
) -> dict[str, int]:
    """``tables.merge_into_path``, and the summaries after it; returns its counts."""
    with staged(tables.with_month(source, keys, day)) as batch:
        mark = _announced(spark, path, batch)
        counts = tables.merge_batch(spark, path, batch, keys, **options)
        if not counts["rows_changed"]:
            remove_folder(spark, mark)
        settle(spark, path, summaries)
    return counts


def delete(
    spark: SparkSession, path: str, doomed: DataFrame, keys: Sequence[str], summaries: Sequence[Summary],
    day: str = "observation_date", **options,
) -> int:
    """``tables.delete_from_path``, and the summaries after it; returns the rows deleted."""
    with staged(doomed.select(*keys).withColumn(MONTH, tables.month_of(day))) as gone:
        mark = _announced(spark, path, gone)
        deleted = tables.delete_batch(spark, path, gone, keys, **options)
        if not deleted:
            remove_folder(spark, mark)
        settle(spark, path, summaries)
    return deleted


def _announced(spark: SparkSession, path: str, batch: DataFrame) -> str:
    """Write down the months a batch is about to touch; where that was written."""
    mark = f"{_home(path)}/{PENDING}{uuid.uuid4().hex}"
    batch.select(MONTH).distinct().coalesce(1).write.parquet(mark)
    return mark


def settle(spark: SparkSession, path: str, summaries: Sequence[Summary]) -> list[str]:
    """Make the summaries of all months written down anew, and whole summaries that were
    never built. Returns the months that were written down."""
    names = folder_names(spark, _home(path))
    marks = [f"{_home(path)}/{n}" for n in names if n.startswith(PENDING)]
    # A mark that was broken off while it was written has touched nothing yet.
    whole = [m for m in marks if "_SUCCESS" in folder_names(spark, m)]
    months = sorted({m for mark in whole for m in tables._months(spark.read.schema(f"{MONTH} string").parquet(mark))})
    for summary in summaries:
        if f"{BUILT}{summary.name}" in names:
            refresh(spark, path, summary, months)
        else:
            remove_folder(spark, f"{_home(path)}/{summary.name}")
            refresh(spark, path, summary, sorted(_present(spark, path)))
            spark.range(1).write.mode("overwrite").parquet(f"{_home(path)}/{BUILT}{summary.name}")
    for mark in marks:
        remove_folder(spark, mark)
    return months


def _present(spark: SparkSession, path: str) -> set[str]:
    return {n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{MONTH}=")}


def refresh(spark: SparkSession, path: str, summary: Summary, months: Sequence[str]) -> None:
    """Make the summary of these months anew; only they are read and written."""
    target = f"{_home(path)}/{summary.name}"
    present, held = sorted(set(months) & _present(spark, path)), []
    if present:
        rows = tables.stored(spark, path)
        with staged(summary.build(rows.filter(rows[MONTH].isin(present)))) as built:
            held = tables._months(built)
            if held:
                tables._replace_months(built, target, summary.cluster)
    for month in set(months) - set(held):
        remove_folder(spark, f"{target}/{MONTH}={month}")


def read(spark: SparkSession, path: str, summary: Summary) -> DataFrame:
    """The rows of a summary, with their month; none where no month has any."""
    schema = summary.build(tables.stored(spark, path)).schema
    return tables.stored(spark, f"{_home(path)}/{summary.name}", schema).select(*schema.names)
