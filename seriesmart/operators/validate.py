"""Gates before loading: one pass over all series, one row of checks each.

A series passes or fails as a whole. The profile is a single grouped
aggregate; checks are expressions over its row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fixed_decimals, lenient_number, lenient_timestamp
from .joins import lookup_join

# What curated metadata must fill in.
CURATED_REQUIRED = ("series_name", "category", "unit")


def profile(
    long: DataFrame,
    config: DataFrame,
    start: date | Column,
    end: date | Column,
    by: str = "series_name",
    day: str = "observation_date",
    value: str = "value",
    delivered: str | None = None,
) -> DataFrame:
    """Quality metrics of each configured series, empty ones included.

    ``config`` may carry max_null_ratio (default 1.0), require_numeric (true),
    allow_duplicate_dates (false) and min_value (none).

    An extraction may hand over other columns than the one asked for. ``delivered``
    names the column of ``long`` that says which column a row came in; NULL is the
    expected one. Then ``delivered_columns`` lists them, the metrics are those of the
    expected column, and ``row_count`` is that of all rows where it is missing.
    """
    lower = (start if isinstance(start, Column) else F.lit(start)).cast("timestamp")
    upper = (end if isinstance(end, Column) else F.lit(end)).cast("timestamp")
    text = F.col(value).cast("string")
    raw_null = F.col(value).isNull()
    if dict(long.dtypes)[value] in ("double", "float"):
        raw_null = raw_null | F.isnan(value)
        number = F.when(~F.isnan(value), F.col(value).cast("double"))
    else:
        number = lenient_number(text)
    came_in = F.coalesce(F.col(delivered).cast("string"), F.col(by)) if delivered else F.col(by)
    rows = lookup_join(long, config.select(by, "min_value"), by, "left").select(
        by,
        came_in.alias("_came_in"),
        lenient_timestamp(day).alias("_at"),
        raw_null.alias("_null"),
        number.alias("_number"),
        "min_value",
    )
    if delivered:
        # A frame has few columns, so the names that came for one series are few.
        names = rows.groupBy(by).agg(
            F.array_sort(F.collect_set("_came_in")).alias("delivered_columns"), F.count(F.lit(1)).alias("_all_rows")
        )
        rows = rows.filter(F.col("_came_in") == F.col(by))
    counted = {
        "row_count": F.count(F.lit(1)),
        "null_count": F.count_if("_null"),
        "invalid_date_count": F.count_if(F.col("_at").isNull()),
        "_outside": F.count_if((F.col("_at") < lower) | (F.col("_at") > upper)),
        "non_numeric_count": F.count_if(~F.col("_null") & F.col("_number").isNull()),
        "below_minimum_count": F.count_if(F.col("_number") < F.col("min_value")),
    }
    counts = [c.alias(name) for name, c in counted.items()]
    # unreadable dates count as one more distinct value
    if dict(long.dtypes)[day] == "date":
        # Days of a month are bits of one number: no grouping by every date.
        days = F.expr("bit_or(shiftleft(1L, dayofmonth(_at) - 1))").alias("_days")
        months = rows.groupBy(by, F.trunc("_at", "month").alias("_month")).agg(*counts, days)
        whole_days = F.coalesce(F.sum(F.bit_count("_days").cast("long")), F.lit(0).cast("long"))
        measured = months.groupBy(by).agg(*[F.sum(name).alias(name) for name in counted], whole_days.alias("_distinct"))
    else:
        measured = rows.groupBy(by).agg(*counts, F.count_distinct("_at").alias("_distinct"))
    unreadable = F.when(F.col("invalid_date_count") > 0, 1).otherwise(0)
    no_date = F.col("invalid_date_count") == F.col("row_count")
    metrics = measured.select(
        by,
        "row_count",
        "null_count",
        (F.col("null_count") / F.col("row_count")).alias("null_ratio"),
        (F.col("row_count") - F.col("_distinct") - unreadable).alias("duplicate_date_count"),
        "invalid_date_count",
        F.when(no_date, F.col("row_count")).otherwise(F.col("_outside")).alias("out_of_range_count"),
        "non_numeric_count",
        "below_minimum_count",
    )
    whole = config.join(metrics, by, "left")
    if delivered:
        whole = whole.join(names, by, "left").withColumn("row_count", F.coalesce("row_count", "_all_rows")).drop("_all_rows")
    return whole.withColumn("row_count", F.coalesce(F.col("row_count"), F.lit(0).cast("long")))


def _check(name: str, passed: Column, message: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), passed.alias("passed"), message.alias("message"))


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}="), F.coalesce(value.cast("string"), F.lit("None")))


def _setting(profiled: DataFrame, name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in profiled.columns else F.lit(default)


def _quoted(names: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "), F.lit("]"))


def checks(profiled: DataFrame, explicit_window: bool = False, by: str = "series_name") -> DataFrame:
    """Add ``checks`` (array of name, passed, message) and ``passed``.

    An empty series has only the not_empty check; with an explicit window an
    empty series is a valid answer and passes without any check. Of a profile that
    knows the delivered columns, two checks look at them, and a series whose column
    was not delivered has no further ones.
    """
    counted = lambda name: _labelled(name, F.col(name))
    max_ratio = _setting(profiled, "max_null_ratio", 1.0)
    not_empty = _check("not_empty", F.col("row_count") > 0, counted("row_count"))
    full = [
        not_empty,
        _check(
            "valid_dates", F.col("invalid_date_count") == 0, counted("invalid_date_count")
        ),
        _check(
            "duplicate_dates",
            _setting(profiled, "allow_duplicate_dates", False)
            | (F.col("duplicate_date_count") == 0),
            _labelled("duplicate_count", F.col("duplicate_date_count")),
        ),
        _check(
            "dates_within_requested_range",
            F.col("out_of_range_count") == 0,
            counted("out_of_range_count"),
        ),
        _check(
            "null_ratio",
            F.col("null_ratio") <= max_ratio,
            F.concat(
                F.lit("null_ratio="), fixed_decimals("null_ratio", 4), F.lit(", max_allowed="), fixed_decimals(max_ratio, 4)
            ),
        ),
        _check(
            "numeric_values",
            ~_setting(profiled, "require_numeric", True) | (F.col("non_numeric_count") == 0),
            counted("non_numeric_count"),
        ),
        F.when(
            F.col("min_value").isNotNull(),
            _check(
                "minimum_value",
                F.col("below_minimum_count") == 0,
                F.concat(counted("below_minimum_count"), F.lit(", "), _labelled("minimum", F.col("min_value"))),
            ),
        ),
    ]
    present = F.lit(True)
    if "delivered_columns" in profiled.columns:
        held = F.col("delivered_columns")
        present = F.array_contains(held, F.col(by))
        others = F.filter(held, lambda n: n != F.col(by))
        full[1:1] = [
            _check("expected_column_present", present, F.concat(F.lit("expected="), F.col(by), F.lit(", actual="), _quoted(held))),
            _check("no_unexpected_columns", F.size(others) == 0, F.concat(F.lit("unexpected_columns="), _quoted(others))),
        ]
    some = F.when(present, F.array_compact(F.array(*full))).otherwise(F.array_compact(F.array(*full[:3])))
    listed = F.when(F.col("row_count") > 0, some).otherwise(
        F.array_compact(F.array(F.when(F.lit(not explicit_window), not_empty)))
    )
    return profiled.withColumn("checks", listed).withColumn(
        "passed", F.forall("checks", lambda c: c["passed"])
    )


def check_rows(checked: DataFrame, by: str = "series_name") -> DataFrame:
    """Long form: one row per series and check."""
    return checked.select(by, F.explode("checks").alias("_c")).select(
        by, F.col("_c.name").alias("check_name"), F.col("_c.passed").alias("passed"), F.col("_c.message").alias("message")
    )


def failed_checks(column: str = "checks") -> Column:
    return F.transform(F.filter(column, lambda c: ~c["passed"]), lambda c: c["name"])


def column_checks(actual: Sequence[str], expected: str) -> list[tuple[str, bool, str]]:
    """The two checks on an extracted frame's columns; metadata only."""
    unexpected = sorted(set(actual) - {expected})
    return [
        ("expected_column_present", expected in actual, f"expected={expected}, actual={list(actual)}"),
        ("no_unexpected_columns", not unexpected, f"unexpected_columns={unexpected}"),
    ]


def series_columns(long: DataFrame, config: DataFrame, by: str = "series_name") -> DataFrame:
    """The same rule on the long form: which names are expected, which are present."""
    present = long.select(by).distinct().withColumn("_present", F.lit(True))
    expected = config.select(by).distinct().withColumn("_expected", F.lit(True))
    return present.join(expected, by, "full_outer").select(
        by,
        F.coalesce("_present", F.lit(False)).alias("expected_column_present"),
        F.coalesce("_expected", F.lit(False)).alias("no_unexpected_columns"),
    )


def gate(
    long: DataFrame, checked: DataFrame, config: DataFrame, by: str = "series_name"
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows; a series without checks is rejected."""
    passed = checked.filter("passed").select(by)
    return (
        lookup_join(long, passed, by, "left_semi"),
        lookup_join(long, passed, by, "left_anti"),
    )


def stage_counts(checked: DataFrame, by: str = "series_name", loads: bool = True) -> DataFrame:
    """Rows through each stage per series; ``loads`` says whether valid rows are written."""
    n = F.col("row_count")
    zero = F.lit(0).cast("long")
    valid = F.when(F.col("passed"), n).otherwise(zero)
    return checked.select(
        by,
        F.when(F.col("passed"), "success").otherwise("quality_failed").alias("status"),
        n.alias("row_count"),
        valid.alias("valid_rows"),
        F.when(F.col("passed"), zero).otherwise(n).alias("rejected_rows"),
        (valid if loads else zero).alias("loaded_rows"),
    )


def metadata_checks(config: DataFrame, catalog: DataFrame, curated: DataFrame) -> DataFrame:
    """Checks of each configured series' metadata.

    config: series_code, frequency; catalog: series_code, frequency_code, any
    number of rows per code; curated: series_code and the required fields.
    """
    matched = catalog.groupBy("series_code").agg(
        F.count(F.lit(1)).alias("match_count"), F.min(F.lower("frequency_code")).alias("_source_frequency")
    )
    entries = curated.select("series_code", *CURATED_REQUIRED, F.lit(True).alias("_curated"))
    joined = (
        config.select("series_code", "frequency")
        .join(matched, "series_code", "left")
        .join(entries, "series_code", "left")
        .withColumn("match_count", F.coalesce("match_count", F.lit(0).cast("long")))
    )
    missing = F.array_compact(
        F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in CURATED_REQUIRED])
    )
    n = F.col("match_count")
    message = _labelled("match_count", n)
    quoted = F.array_join(F.transform(missing, lambda m: F.concat(F.lit("'"), m, F.lit("'"))), ", ")
    listed = F.array_compact(
        F.array(
            _check("found_in_catalog", n > 0, message),
            _check("unique_in_catalog", n <= 1, message),
            F.when(
                n == 1,
                _check(
                    "frequency_matches_config",
                    F.col("frequency").isNull()
                    | F.coalesce(F.lower("frequency") == F.col("_source_frequency"), F.lit(False)),
                    F.concat(
                        _labelled("source", F.col("_source_frequency")),
                        F.lit(", "),
                        _labelled("configured", F.col("frequency")),
                    ),
                ),
            ),
            _check("curated_metadata_present", F.col("_curated").isNotNull(), _labelled("series_code", F.col("series_code"))),
            _check(
                "curated_required_fields",
                F.size(missing) == 0,
                F.concat(F.lit("missing_fields=["), quoted, F.lit("]")),
            ),
        )
    )
    return (
        joined.select("series_code", "match_count", listed.alias("checks"))
        .withColumn("passed", F.forall("checks", lambda c: c["passed"]))
    )
