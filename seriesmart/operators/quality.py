"""Declarative data quality: a rule yields the rows that break it.

Row rules on one table are fused into one aggregate pass; grouped and join
rules run on their own. The result is one row per rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import by_frequency, date_key, day_name, is_weekend, period_start, zone_date
from ..functions.text import MESSAGE_LIMIT, not_finite
from .aggregates import duplicate_keys
from .joins import lookup_join
from .sets import union_all

# Fixed value: the zone whose calendar decides what a date means.
ZONE = "America/Santiago"


# -- row predicates: true where a row breaks the rule, NULL passes -----------


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(list(values))


def not_true(expression: Column, where: Column | None = None) -> Column:
    return ~expression if where is None else where & ~expression


def outside(column: str, low=None, high=None) -> Column:
    """Outside the inclusive range."""
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(column) < low)
    if high is not None:
        broken = broken | (F.col(column) > high)
    return broken


def off_grid(value: str = "value", steps_per_unit: int = 4, tolerance: float = 1e-9) -> Column:
    """Not a multiple of 1 / steps_per_unit, up to float noise."""
    scaled = F.col(value) * steps_per_unit
    distance = F.abs(scaled - F.round(scaled))
    # NaN, and the NaN distance of an infinity, pass: no comparison with NaN holds.
    return ~F.isnan(distance) & (distance > tolerance)


# -- rules as rows ----------------------------------------------------------


def unique(rows: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Values seen more than once; NULL is ignored."""
    kept = rows.filter(F.col(column).isNotNull())
    return duplicate_keys(kept if where is None else kept.filter(where), [column])


def with_frequency(observations: DataFrame, series: DataFrame) -> DataFrame:
    return lookup_join(observations, series.select("series_code", "frequency"), "series_code", "inner")


def not_first_of_month(observations: DataFrame, series: DataFrame) -> DataFrame:
    """Monthly observations dated other than the first of the month."""
    late = observations.filter(F.dayofmonth("observation_date") != 1)
    monthly = series.filter(F.col("frequency") == "monthly")
    return with_frequency(late, monthly).select("series_code", "observation_date", "value")


def infinite_values(observations: DataFrame) -> DataFrame:
    return observations.filter(not_finite("value"))


def weekend_values(observations: DataFrame, series: DataFrame) -> DataFrame:
    """Weekend values of daily series."""
    weekend = observations.filter(F.col("value").isNotNull() & is_weekend("observation_date"))
    daily = series.filter(F.col("frequency") == "daily")
    return with_frequency(weekend, daily).select(
        "series_code", "observation_date", day_name("observation_date").alias("day_name"), "value"
    )


def future_dates(
    observations: DataFrame,
    series: DataFrame,
    as_of: Column,
    zone: str = ZONE,
    daily_slack: int = 4,
) -> DataFrame:
    """Observations dated after they could have been published.

    Judged against the extraction date in ``zone``: a daily value may be
    ``daily_slack`` days ahead, a monthly one must be for a closed month, any
    other may not be later than the extraction itself.
    """
    day = F.col("observation_date")
    extracted = zone_date("extracted_at", zone)
    late_clock = F.col("extracted_at") > as_of
    too_early = by_frequency(
        "frequency",
        {
            "daily": day > F.date_add(extracted, daily_slack),
            "monthly": day >= period_start(extracted, "month"),
        },
        otherwise=day > extracted,
    )
    issue = F.when(late_clock, "extracted_at in the future").otherwise(
        "observation_date after it could be published"
    )
    return (
        with_frequency(observations, series)
        .filter(late_clock | too_early)
        .select("series_code", "frequency", "observation_date", "value", "extracted_at", issue.alias("issue"))
    )


def before_coverage(observations: DataFrame, series: DataFrame) -> DataFrame:
    """Observations older than their series is said to be."""
    starts = series.select("series_code", "first_observation_date")
    return lookup_join(
        observations,
        starts,
        "series_code",
        "inner",
        condition=F.col("observation_date") < F.col("first_observation_date"),
    ).select("series_code", "observation_date", "value", "first_observation_date")


def stuck_runs(runs: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    limit = as_of.cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return runs.filter((F.col("status") == "running") & (F.col("started_at") < limit))


def run_invariants() -> dict[str, Column]:
    """What must hold for every run row, as broken-row predicates."""
    finished = ~F.col("status").isin("running", "unknown")
    # A finished run without an end is a violation, not an unknown.
    ended = F.coalesce(F.col("completed_at") >= F.col("started_at"), F.lit(False))
    counts = (F.col("valid_rows") + F.col("rejected_rows") <= F.col("extracted_rows")) & (
        F.col("loaded_rows") <= F.col("valid_rows")
    )
    explained = F.col("status").isin("failed", "crashed") == F.col("error_message").isNotNull()
    return {
        "completed_iff_finished": F.when(finished, ~ended).otherwise(
            F.col("completed_at").isNotNull()
        ),
        "stage_counts_shrink": not_true(counts, F.col("status").isin("success", "failed")),
        "error_iff_failed": not_true(explained, finished),
        "error_is_short": F.length("error_message") > MESSAGE_LIMIT,
    }


def calendar_invariants() -> dict[str, Column]:
    return {
        "weekend_agrees_with_date": F.col("is_weekend") != is_weekend("date_day"),
        "key_agrees_with_date": F.col("date_key") != date_key("date_day"),
    }


# -- registry ---------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named rule on a table: a row predicate, or a function to violating rows."""

    name: str
    table: str
    broken: Column | Callable[[], DataFrame]
    tag: str = "generic"
    severity: str = "error"


@dataclass
class RuleSet:
    """Rules over named tables."""

    tables: dict[str, DataFrame]
    rules: list[Rule] = field(default_factory=list)

    def add(self, name: str, table: str, broken, tag: str = "generic", severity: str = "error") -> RuleSet:
        if severity not in ("warn", "error"):
            raise ValueError(f"unknown severity: {severity}")
        self.rules.append(Rule(name, table, broken, tag, severity))
        return self

    def tagged(self, *tags: str) -> RuleSet:
        return RuleSet(self.tables, [r for r in self.rules if r.tag in tags])

    def violations(self, name: str) -> DataFrame:
        """The rows that break one rule, computed only when asked for."""
        rule = next(r for r in self.rules if r.name == name)
        if isinstance(rule.broken, Column):
            return self.tables[rule.table].filter(rule.broken)
        return rule.broken()

    def results(self) -> DataFrame:
        """(rule, table_name, tag, severity, failures, status) of every rule."""
        return union_all([*self._fused(), *self._separate()])

    def _fused(self) -> Iterable[DataFrame]:
        for table, rows in self.tables.items():
            rules = [r for r in self.rules if r.table == table and isinstance(r.broken, Column)]
            if not rules:
                continue
            counts = rows.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(rules)])
            listed = F.array(*[_result(r, F.col(f"r{i}")) for i, r in enumerate(rules)])
            yield counts.select(F.inline(listed))

    def _separate(self) -> Iterable[DataFrame]:
        for rule in self.rules:
            if isinstance(rule.broken, Column):
                continue
            counted = rule.broken().agg(F.count(F.lit(1)).alias("n"))
            yield counted.select(F.inline(F.array(_result(rule, F.col("n")))))


def _result(rule: Rule, failures: Column) -> Column:
    failed = "warn" if rule.severity == "warn" else "error"
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.tag).alias("tag"),
        F.lit(rule.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures > 0, failed).otherwise("pass").alias("status"),
    )
