"""Previous / next row per key, without putting one key's rows into one task.

A plain ``lag`` over PARTITION BY key sends all rows of a key to one task. Here
rows are windowed per (key, time bucket); each bucket's first and last rows are
aggregated to one small row per bucket, shifted across buckets, and handed to
the rows at the bucket edges. The answer equals the plain window's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import by_frequency, periods_between
from ..functions.text import safe_divide


def shifted(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: dict[str, str],
    bucket: Column | None = None,
    forward: bool = False,
) -> DataFrame:
    """Add ``columns`` (source -> output name) of the previous row, or of the
    next one if ``forward``, per ``keys`` in ``order``.

    ``bucket`` must not decrease along ``order``; the default is its year.
    ``order`` is required, and (keys, order) is the grain: with ties, which row
    comes first is as open as in any window.
    """
    keys = list(keys)
    others = [c for c in rows.columns if c not in keys]
    bucket = F.year(order) if bucket is None else bucket
    part = F.struct(*keys, bucket.alias("_bucket")).alias("_part")
    # One exchange, read by both branches below. The join on the struct keeps
    # rows with a NULL key and adds no null filter that would set the branches
    # apart; sorting starts with a hash because structs sort slowly. Exchange, window
    # and join share hash and part, so rows are sorted once and not again for the join.
    spread = rows.select(part, *others).repartition(F.xxhash64("_part"), "_part").withColumn("_hash", F.xxhash64("_part"))

    within = Window.partitionBy("_hash", "_part").orderBy(order)
    shift, opposite = (F.lead, F.lag) if forward else (F.lag, F.lead)
    carried = F.struct(*[F.col(source).alias(name) for source, name in columns.items()])
    inside = spread.withColumn("_inside", shift(carried).over(within))

    # The edge row of each part, whole: both branches read the same columns.
    edges = (
        spread.withColumn("_edge", opposite(F.lit(1)).over(within).isNull())
        .filter("_edge")
        .select("_hash", "_part", F.struct(*others).alias("_row"))
    )
    # One row per part: per key, as many rows as the calendar has buckets.
    across = Window.partitionBy(*[F.col("_part")[k] for k in keys]).orderBy(F.col("_part")["_bucket"])
    neighbours = edges.select("_hash", "_part", shift("_row").over(across).alias("_neighbour"))

    outputs = [
        F.when(F.col("_inside").isNotNull(), F.col("_inside")[name])
        .otherwise(F.col("_neighbour")[source])
        .alias(name)
        for source, name in columns.items()
    ]
    originals = [F.col("_part")[c].alias(c) if c in keys else F.col(c) for c in rows.columns]
    return inside.join(neighbours, ["_hash", "_part"], "left").select(*originals, *outputs)


def percent_change(
    observations: DataFrame,
    key: str = "series_code",
    day: str = "observation_date",
    value: str = "value",
) -> DataFrame:
    """Each non-null value with its predecessor and the relative change."""
    present = observations.filter(F.col(value).isNotNull()).select(key, day, value)
    previous = shifted(present, [key], day, {day: "previous_date", value: "previous_value"})
    change = safe_divide(F.col(value) - F.col("previous_value"), F.col("previous_value"))
    return previous.withColumn("change", change).withColumn("change_pct", F.round(change * 100, 2))


def change_over_limit(observations: DataFrame, limit: float = 0.10, **columns: str) -> DataFrame:
    """Changes larger than ``limit`` either way. A zero predecessor and NaN pass."""
    size = F.abs("change")
    return percent_change(observations, **columns).filter(~F.isnan(size) & (size > limit))


def too_wide(frequency: str, day: str, previous: str, daily_limit: int = 7) -> Column:
    """Whether the period of ``day`` lies further behind ``previous`` than its frequency allows."""
    return by_frequency(
        frequency,
        {
            "daily": periods_between(day, previous, "day") > daily_limit,
            "monthly": periods_between(day, previous, "month") > 1,
            "quarterly": periods_between(day, previous, "quarter") > 1,
            "annual": periods_between(day, previous, "year") > 1,
        },
    )


def gaps(
    observations: DataFrame,
    key: str = "series_code",
    day: str = "observation_date",
    frequency: str = "frequency",
    daily_limit: int = 7,
) -> DataFrame:
    """Non-null observations preceded by a hole too wide for their frequency."""
    dates = observations.filter(F.col("value").isNotNull()).select(key, frequency, day)
    previous = shifted(dates, [key], day, {day: "previous_date"})
    return previous.filter(too_wide(frequency, day, "previous_date", daily_limit)).withColumn(
        "gap_days", periods_between(day, "previous_date", "day")
    )


def version_overlaps(
    history: DataFrame,
    key: str = "series_code",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Versions that end before they start, or run into their successor."""
    following = shifted(
        history.select(key, valid_from, valid_to),
        [key],
        valid_from,
        {valid_from: "next_valid_from"},
        bucket=F.trunc(valid_from, "month"),
        forward=True,
    )
    issue = (
        F.when(F.col(valid_to) <= F.col(valid_from), "ends before it starts")
        .when(
            F.col("next_valid_from").isNotNull() & F.col(valid_to).isNull(),
            "superseded version still current",
        )
        .when(F.col(valid_to) > F.col("next_valid_from"), "overlaps next version")
    )
    return following.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def not_sequential(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Dates that do not follow their predecessor by exactly one day."""
    previous = shifted(days.select(day), [], day, {day: "previous_day"})
    return previous.filter(F.col(day) != F.date_add("previous_day", 1))


def duplicate_ordinals(
    rows: DataFrame, key: str, day: str = "observation_date"
) -> DataFrame:
    """Occurrences after the first per (key, date), unreadable dates counted as one value."""
    distinct = F.count_distinct(F.coalesce(F.col(day).cast("string"), F.lit("")))
    return rows.groupBy(key).agg((F.count(F.lit(1)) - distinct).alias("duplicate_count"))
