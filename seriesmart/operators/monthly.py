"""Partial results per series and month that merge into whole ones.

Profiles, ages and neighbour rules of a table follow from one row per series and month,
so a batch has to look at the months it touches only (``sources.summaries`` stores
them). Rows carry their month in ``observation_month``; (series_code, observation_date) is unique.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import safe_divide
from .joins import lookup_join
from .windows import too_wide

SERIES, DAY, MONTH = "series_code", "observation_date", "observation_month"


# -- profiles --------------------------------------------------------------------


def profile_partials(config: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Builds one row per series and month: counts, latest value and latest load.

    ``config`` has one row per series with ``min_value``, which is kept with the counts
    made by it: see ``outdated``. Distinct dates of a month are counted as bits of one
    number, in the same pass over the rows.
    """
    least = config.select(SERIES, "min_value")

    def build(rows: DataFrame) -> DataFrame:
        missing = F.col("value").isNull() | F.isnan("value")
        slim = rows.select(SERIES, MONTH, DAY, "value", "ingested_at")
        return lookup_join(slim, least, SERIES).groupBy(SERIES, MONTH).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(missing).alias("null_count"),
            F.expr(f"bit_count(coalesce(bit_or(shiftleft(1L, dayofmonth({DAY}) - 1)), 0L))").cast("long").alias("dates"),
            F.count_if(~missing & (F.col("value") < F.col("min_value"))).alias("below_minimum_count"),
            F.first("min_value").alias("min_value"),
            F.max(F.when(F.col("value").isNotNull(), F.col(DAY))).alias("latest_observation_date"),
            F.max("ingested_at").alias("max_loaded_at"),
        )

    return build


def outdated(partials: DataFrame, config: DataFrame) -> DataFrame:
    """Months with partials made by another minimum than the configured one."""
    now = config.select(SERIES, F.col("min_value").alias("_now"))
    return lookup_join(partials, now, SERIES).filter(~F.col("min_value").eqNullSafe(F.col("_now"))).select(MONTH).distinct()


def profile(partials: DataFrame, config: DataFrame, start: date, end: date, rows: DataFrame) -> DataFrame:
    """``validate.profile`` by series of a stored table, merged from its partials.

    Of ``rows``, the table itself, only the months are read that the window cuts:
    those of ``start`` and ``end``. Dates are dates here, so none is unreadable, and
    values are numbers.
    """
    first, last = f"{start:%Y-%m}", f"{end:%Y-%m}"
    cut = rows.filter(F.col(MONTH).isin(sorted({first, last})))
    beyond = cut.groupBy(SERIES).agg(F.count_if(~F.col(DAY).between(F.lit(start), F.lit(end))).alias("_cut"))
    whole = F.when((F.col(MONTH) < first) | (F.col(MONTH) > last), F.col("row_count")).otherwise(0)
    merged = partials.groupBy(SERIES).agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("dates").alias("_dates"),
        F.sum(whole).alias("_outside"), F.sum("below_minimum_count").alias("below_minimum_count"),
    )
    none = F.lit(0).cast("long")
    metrics = merged.join(beyond, SERIES, "left").select(
        SERIES, "row_count", "null_count", (F.col("null_count") / F.col("row_count")).alias("null_ratio"),
        (F.col("row_count") - F.col("_dates")).alias("duplicate_date_count"), none.alias("invalid_date_count"),
        (F.col("_outside") + F.coalesce("_cut", none)).alias("out_of_range_count"), none.alias("non_numeric_count"),
        "below_minimum_count",
    )
    return config.join(metrics, SERIES, "left").withColumn("row_count", F.coalesce("row_count", none))


def latest(partials: DataFrame) -> DataFrame:
    """Per series the last date with a value and the last load, as freshness rules want them."""
    return partials.groupBy(SERIES).agg(
        F.max("latest_observation_date").alias(DAY), F.max("max_loaded_at").alias("ingested_at")
    ).withColumn("value", F.when(F.col(DAY).isNotNull(), F.lit(1.0)))


# -- neighbour rules ---------------------------------------------------------------

# A rule is a condition over observation_date, value, frequency, previous_date and previous_value.
PAIR = (SERIES, "frequency", "previous_date", "previous_value", DAY, "value")


def gap(daily_limit: int = 7) -> Column:
    """A hole between neighbours that is too wide for the frequency."""
    return too_wide("frequency", DAY, "previous_date", daily_limit)


def jump(limit: float = 0.10) -> Column:
    """A relative change larger than ``limit`` either way; a zero predecessor and NaN pass."""
    size = F.abs(safe_divide(F.col("value") - F.col("previous_value"), F.col("previous_value")))
    return ~F.isnan(size) & (size > limit)


def _present(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("value").isNotNull()).select(SERIES, MONTH, "frequency", DAY, "value")


def pairs_inside(found: Column) -> Callable[[DataFrame], DataFrame]:
    """Builds the neighbours within a month that break a rule."""

    def build(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(SERIES, MONTH).orderBy(DAY)
        previous = F.lag(F.struct(DAY, "value")).over(order)
        pairs = _present(rows).withColumn("_p", previous).filter("_p IS NOT NULL").select(
            SERIES, "frequency", F.col("_p")[DAY].alias("previous_date"), F.col("_p.value").alias("previous_value"), DAY, "value", MONTH
        )
        return pairs.filter(found)

    return build


def edges(rows: DataFrame) -> DataFrame:
    """The first and the last row with a value of every series and month."""
    row = F.struct(DAY, "value", "frequency")
    return _present(rows).groupBy(SERIES, MONTH).agg(F.min_by(row, DAY).alias("first_row"), F.max_by(row, DAY).alias("last_row"))


def broken_pairs(inside: DataFrame, edge_rows: DataFrame, found: Column) -> DataFrame:
    """All neighbours that break a rule: those within months, as stored, and those across
    months, from the edges. A series has as many edges as the calendar has months."""
    order = Window.partitionBy(SERIES).orderBy(MONTH)
    across = edge_rows.withColumn("_p", F.lag("last_row").over(order)).filter("_p IS NOT NULL").select(
        SERIES, F.col("first_row.frequency").alias("frequency"), F.col("_p")[DAY].alias("previous_date"),
        F.col("_p.value").alias("previous_value"), F.col("first_row")[DAY].alias(DAY), F.col("first_row.value").alias("value"),
    )
    return inside.select(*PAIR).unionByName(across.filter(found).select(*PAIR))
