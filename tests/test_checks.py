"""Validation gates, rules, rollups, freshness and auditing on literal cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from collecting import collected
from seriesmart.functions.text import MESSAGE_SUFFIX
from seriesmart.operators import aggregates, audit, canonical, filters, freshness, quality, sets, validate
from seriesmart.schemas import OBSERVATIONS, SERIES, required_columns
from seriesmart.sources import config as configuration

START, END = date(2026, 1, 1), date(2026, 12, 31)
CONFIG = (
    "series_name string, series_code string, max_null_ratio double, require_numeric boolean, "
    "allow_duplicate_dates boolean, min_value double"
)


@pytest.fixture
def series_config(rows):
    return rows(CONFIG, ("test_series", "TEST", 0.25, True, False, 0.0))


def validated(rows, series_config, *values, start=START, end=END, **options):
    long = rows(
        "series_name string, observation_date string, value string",
        *[("test_series", d, v) for d, v in values],
    )
    return validate.checks(validate.profile(long, series_config, start, end), **options).head()


def failed(row):
    return [c.name for c in row.checks if not c.passed]


def test_valid_series(rows, series_config):
    row = validated(rows, series_config, ("2026-01-01", "100"), ("2026-01-02", "101"), ("2026-01-03", "102"))
    assert row.passed and failed(row) == []
    assert [c.name for c in row.checks] == [
        "not_empty",
        "valid_dates",
        "duplicate_dates",
        "dates_within_requested_range",
        "null_ratio",
        "numeric_values",
        "minimum_value",
    ]


def test_duplicate_dates(rows, series_config):
    row = validated(rows, series_config, ("2026-01-01", "100"), ("2026-01-01", "101"))
    assert not row.passed and failed(row) == ["duplicate_dates"]
    assert row.duplicate_date_count == 1


def test_null_ratio(rows, series_config):
    row = validated(
        rows, series_config, ("2026-01-01", "100"), ("2026-01-02", None), ("2026-01-03", None), ("2026-01-04", "103")
    )
    assert failed(row) == ["null_ratio"] and row.null_ratio == 0.5
    assert row.checks[4].message == "null_ratio=0.5000, max_allowed=0.2500"


@pytest.mark.parametrize("nulls, total", [(1, 32), (3, 32), (17, 160), (1, 3)])
def test_null_ratio_is_written_as_python_writes_it(rows, series_config, nulls, total):
    values = [(f"2026-{1 + i // 28:02d}-{1 + i % 28:02d}", None if i < nulls else "100") for i in range(total)]
    row = validated(rows, series_config, *values)
    assert row.checks[4].message == f"null_ratio={nulls / total:.4f}, max_allowed=0.2500"


def test_non_numeric(rows, series_config):
    row = validated(rows, series_config, ("2026-01-01", "100"), ("2026-01-02", "invalid"), ("2026-01-03", "102"))
    assert failed(row) == ["numeric_values"] and row.non_numeric_count == 1


def test_below_minimum(rows, series_config):
    row = validated(rows, series_config, ("2026-01-01", "100"), ("2026-01-02", "-1"))
    assert failed(row) == ["minimum_value"] and row.below_minimum_count == 1


def test_dates_outside_and_unreadable(rows, series_config):
    row = validated(rows, series_config, ("2025-12-31", "1"), ("bad", "1"), ("worse", "1"), ("2026-01-01", "1"))
    assert failed(row) == ["valid_dates", "duplicate_dates", "dates_within_requested_range"]
    assert (row.invalid_date_count, row.duplicate_date_count, row.out_of_range_count) == (2, 1, 1)
    only_bad = validated(rows, series_config, ("bad", "1"), ("worse", "1"))
    assert only_bad.out_of_range_count == 2


def test_empty_series(rows, series_config):
    row = validated(rows, series_config)
    assert not row.passed and failed(row) == ["not_empty"] and len(row.checks) == 1
    assert validated(rows, series_config, explicit_window=True).passed


def test_typed_values_count_nan_as_null(rows, series_config):
    long = rows(
        "series_name string, observation_date date, value double",
        ("test_series", date(2026, 1, 1), 1.0),
        ("test_series", date(2026, 1, 2), float("nan")),
        ("test_series", date(2026, 1, 3), None),
        ("test_series", date(2026, 1, 4), 2.0),
    )
    row = validate.profile(long, series_config, START, END).head()
    assert (row.null_count, row.non_numeric_count, row.below_minimum_count) == (2, 0, 0)


def test_dates_are_profiled_without_grouping_by_date(rows, series_config):
    days = [date(2025, 12, 31), date(2026, 1, 1), date(2026, 1, 1), date(2026, 1, 31), date(2026, 2, 1), None, None]
    typed = rows("series_name string, observation_date date, value double", *[("test_series", d, float(i)) for i, d in enumerate(days)])
    text = typed.select("series_name", F.col("observation_date").cast("string"), F.col("value").cast("string"))
    found = validate.profile(typed, series_config, START, END)
    assert collected(found) == collected(validate.profile(text, series_config, START, END))
    assert found.head().duplicate_date_count == 2
    assert "(distinct" not in found._jdf.queryExecution().executedPlan().toString()
    unreadable = typed.filter("observation_date IS NULL")
    assert validate.profile(unreadable, series_config, START, END).head().out_of_range_count == 2


def test_settings_default(rows):
    config = rows(CONFIG, ("test_series", "TEST", None, None, None, None))
    row = validated(rows, config, ("2026-01-01", None))
    assert row.passed and "minimum_value" not in [c.name for c in row.checks]


def test_gate_rejects_whole_series(rows):
    config = rows(CONFIG, ("good", "G", 1.0, True, False, None), ("bad", "B", 1.0, True, False, None))
    long = rows(
        "series_name string, observation_date string, value string",
        ("good", "2026-01-01", "1"),
        ("bad", "2026-01-01", "1"),
        ("bad", "2026-01-02", "oops"),
        ("stranger", "2026-01-02", "1"),
    )
    checked = validate.checks(validate.profile(long, config, START, END))
    accepted, rejected = validate.gate(long, checked, config)
    assert collected(accepted, "series_name") == [("good",)]
    assert collected(rejected, "series_name") == [("bad",), ("bad",), ("stranger",)]
    assert collected(validate.stage_counts(checked)) == [
        ("bad", "quality_failed", 2, 0, 2, 0),
        ("good", "success", 1, 1, 0, 1),
    ]
    assert collected(validate.stage_counts(checked, loads=False), "loaded_rows") == [(0,), (0,)]


def test_column_checks_are_part_of_the_gate(rows):
    config = rows(CONFIG, *[(n, n, 1.0, True, True, None) for n in ("good", "renamed", "more", "absent")])
    long = rows(
        "series_name string, observation_date string, value string, came_in string",
        ("good", "2026-01-01", "1", None), ("good", "2026-01-02", "2", "good"), ("renamed", "2026-01-01", "1", "other"),
        ("renamed", "bad", "x", "other"), ("more", "2026-01-01", "1", "more"), ("more", "2026-01-01", "x", "b"), ("more", "bad", "x", "a"),
    )
    checked = validate.checks(validate.profile(long, config, START, END, delivered="came_in"))
    got = {r.series_name: r for r in checked.collect()}
    assert got["good"].passed and [c.name for c in got["good"].checks][:4] == [
        "not_empty", "expected_column_present", "no_unexpected_columns", "valid_dates",
    ]
    assert [(c.name, c.passed, c.message) for c in got["renamed"].checks] == [
        ("not_empty", True, "row_count=2"),
        ("expected_column_present", False, "expected=renamed, actual=['other']"),
        ("no_unexpected_columns", False, "unexpected_columns=['other']"),
    ]
    assert failed(got["more"]) == ["no_unexpected_columns"] and got["more"].row_count == 1
    assert got["more"].checks[2].message == "unexpected_columns=['a', 'b']"
    assert [c.name for c in got["absent"].checks] == ["not_empty"] and not got["absent"].passed


def test_column_checks():
    assert [passed for _, passed, _ in validate.column_checks(["a"], "a")] == [True, True]
    assert [passed for _, passed, _ in validate.column_checks(["b"], "a")] == [False, False]
    assert sets.column_differences(["a", "x"], ["a", "b"]) == (["b"], ["x"])


def metadata(rows, catalog, curated, frequency="daily"):
    config = rows("series_code string, frequency string", ("T", frequency))
    checks = validate.metadata_checks(
        config,
        rows("series_code string, frequency_code string", *catalog),
        rows("series_code string, series_name string, category string, unit string", *curated),
    ).head()
    return [c.name for c in checks.checks if not c.passed]


CURATED = ("T", "Test", "Category", "unit")


def test_metadata_checks(rows):
    assert metadata(rows, [("T", "DAILY")], [CURATED]) == []
    assert metadata(rows, [], [CURATED]) == ["found_in_catalog"]
    assert metadata(rows, [("T", "DAILY"), ("T", "DAILY")], [CURATED]) == ["unique_in_catalog"]
    assert metadata(rows, [("T", "MONTHLY")], [CURATED]) == ["frequency_matches_config"]
    assert metadata(rows, [("T", "MONTHLY")], [CURATED], frequency=None) == []
    assert metadata(rows, [("T", "DAILY")], []) == ["curated_metadata_present", "curated_required_fields"]
    assert metadata(rows, [("T", "DAILY")], [("T", "Test", "", None)]) == ["curated_required_fields"]


# -- canonical tables ----------------------------------------------------------


def test_canonical_observations(rows):
    at = datetime(2026, 9, 25, 12)
    wide = rows("observation_date date, usd double, tpm double", (date(2026, 1, 1), 900.0, None), (date(2026, 1, 2), 901.0, 5.0))
    long = canonical.unpivot_wide(wide, ["observation_date"], ["usd", "tpm"])
    config = rows("series_name string, series_code string, frequency string, unit string", ("usd", "F073", "daily", "clp"))
    got = canonical.canonical_observations(long, config, F.lit(at), F.lit(at), F.lit("run"), "bank")
    assert got.columns == OBSERVATIONS.names
    assert collected(got) == [
        (date(2026, 1, d), "F073", "usd", v, "daily", "clp", date(2026, 9, 25), at, at, "run", "bank")
        for d, v in ((1, 900.0), (2, 901.0))
    ]


CATALOG = (
    "series_code string, frequency_code string, spanish_title string, english_title string, "
    "first_observation string, last_observation string, updated_at string"
)
ENTRY = "series_code string, series_name string, description string, category string, unit string"


def canonical_series(rows, catalog, curated):
    at = F.lit(datetime(2026, 9, 25, 12))
    return canonical.canonical_series(rows(CATALOG, *catalog), rows(ENTRY, *curated), at, F.lit("run"), "bank")


def test_canonical_series(rows):
    got = canonical_series(
        rows, [("T", "DAILY", "es", "en", "2020-01-01", "not a date", None)], [("T", "Test", None, "C", "u")]
    )
    assert got.columns == SERIES.names
    row = got.head()
    assert (row.frequency, row.first_observation_date, row.last_observation_date) == ("daily", date(2020, 1, 1), None)


def test_canonical_series_refuses_bad_input(rows):
    item = ("T", "DAILY", "es", "en", None, None, None)
    with pytest.raises(Exception, match="duplicate series code"):
        canonical_series(rows, [item, item], [("T", "Test", None, "C", "u")]).collect()
    with pytest.raises(Exception, match="no curated metadata"):
        canonical_series(rows, [item], []).collect()


def test_configuration_problems(rows):
    schema = "series_name string, series_code string, start_date date, enabled boolean"
    clean = rows(schema, ("a", "A", START, None), ("b", "B", START, False))
    assert collected(configuration.enabled(configuration.checked(clean, configuration.config_problems(clean))), "series_code") == [("A",)]
    dirty = rows(schema, ("a", "A", START, True), ("a", None, START, True), ("c", "A", None, True))
    assert collected(configuration.config_problems(dirty)) == [
        ("duplicate series_code", "A"),
        ("duplicate series_name", "a"),
        ("missing series_code", "a"),
        ("missing start_date", "A"),
    ]
    with pytest.raises(ValueError, match="4 problems.*duplicate series_code: A") as refused:
        configuration.checked(dirty, configuration.config_problems(dirty))
    listed = str(refused.value).split("listed in ")[1].split(";")[0]
    assert dirty.sparkSession.read.parquet(listed).count() == 4


def test_window_refuses_reversed_dates(rows):
    with pytest.raises(ValueError):
        filters.in_window(rows("observation_date date"), END, START)


# -- rules -----------------------------------------------------------------------


def test_range_bounds(rows):
    rules = rows(
        "series_code string, lo double, hi double, lo_inclusive boolean, hi_inclusive boolean",
        ("open", 50.0, 200.0, False, False),
        ("closed", -3.0, 5.0, True, True),
        ("positive", 0.0, None, False, True),
    )
    nan = float("nan")
    values = rows(
        "series_code string, value double",
        *[("open", v) for v in (50.0, 50.1, 199.9, 200.0, nan, None)],
        *[("closed", v) for v in (-3.0, -3.1, 5.0, 5.1, nan)],
        *[("positive", v) for v in (0.0, 0.1, float("inf"))],
        ("unruled", -1e9),
    )
    assert collected(filters.out_of_range(values, rules)) == sorted(
        [("open", 50.0), ("open", 200.0), ("closed", -3.1), ("closed", 5.1), ("positive", 0.0)], key=repr
    )


def test_step_grid(rows):
    values = rows("value double", (5.25,), (5.2499999999999,), (5.37,), (None,), (float("nan"),), (float("inf"),))
    assert collected(values.filter(quality.off_grid())) == [(5.37,)]


def test_future_dates(rows):
    at = datetime(2026, 3, 6, 15)
    series = rows("series_code string, frequency string", ("d", "daily"), ("m", "monthly"), ("y", "annual"))
    observations = rows(
        "series_code string, observation_date date, value double, extracted_at timestamp",
        ("d", date(2026, 3, 10), 1.0, at),
        ("d", date(2026, 3, 11), 1.0, at),
        ("m", date(2026, 2, 1), 1.0, at),
        ("m", date(2026, 3, 1), 1.0, at),
        ("y", date(2026, 3, 6), 1.0, at),
        ("y", date(2026, 3, 7), 1.0, at),
        ("d", date(2026, 1, 1), 1.0, datetime(2026, 5, 1)),
    )
    got = quality.future_dates(observations, series, F.lit(datetime(2026, 4, 1)))
    assert collected(got, "series_code", "observation_date", "issue") == [
        ("d", date(2026, 1, 1), "extracted_at in the future"),
        ("d", date(2026, 3, 11), "observation_date after it could be published"),
        ("m", date(2026, 3, 1), "observation_date after it could be published"),
        ("y", date(2026, 3, 7), "observation_date after it could be published"),
    ]


def test_run_invariants_find_planted_rows(rows):
    t0, t1 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    schema = (
        "run_id string, status string, started_at timestamp, completed_at timestamp, extracted_rows long, "
        "valid_rows long, rejected_rows long, loaded_rows long, error_message string"
    )
    runs = rows(
        schema,
        ("ok", "success", t0, t1, 10, 8, 2, 8, None),
        ("open", "running", t0, None, None, None, None, None, None),
        ("legacy", "unknown", t0, None, None, None, None, None, None),
        ("endless", "success", t0, None, 1, 1, 0, 1, None),
        ("backwards", "failed", t1, t0, 1, 1, 0, 1, "x"),
        ("ended", "running", t0, t1, None, None, None, None, None),
        ("grew", "success", t0, t1, 1, 1, 1, 1, None),
        ("silent", "crashed", t0, t1, None, None, None, None, None),
        ("noisy", "success", t0, t1, 1, 1, 0, 1, "why"),
        ("long", "failed", t0, t1, 1, 1, 0, 1, "x" * 1001),
    )
    broken = {name: sorted(r.run_id for r in runs.filter(c).collect()) for name, c in quality.run_invariants().items()}
    assert broken == {
        "completed_iff_finished": ["backwards", "ended", "endless"],
        "stage_counts_shrink": ["grew"],
        "error_iff_failed": ["noisy", "silent"],
        "error_is_short": ["long"],
    }


def test_rule_set_runs_fused_and_separate_rules(rows):
    table = rows("k string, v int", ("a", 1), ("a", None), ("b", 3))
    rules = (
        quality.RuleSet({"t": table})
        .add("v_present", "t", quality.is_null("v"))
        .add("v_small", "t", quality.outside("v", high=5), tag="domain")
        .add("k_known", "t", quality.not_accepted("k", ["a"]), tag="domain", severity="warn")
        .add("k_unique", "t", lambda: quality.unique(table, "k"), tag="structural")
    )
    assert collected(rules.results(), "rule", "failures", "status") == [
        ("k_known", 1, "warn"),
        ("k_unique", 1, "error"),
        ("v_present", 1, "error"),
        ("v_small", 0, "pass"),
    ]
    assert collected(rules.tagged("domain").results(), "rule") == [("k_known",), ("v_small",)]
    assert collected(rules.violations("v_present")) == [("a", None)]
    assert collected(rules.violations("k_unique")) == [("a", 2)]
    with pytest.raises(ValueError):
        rules.add("x", "t", quality.is_null("v"), severity="fatal")


def test_required_columns():
    assert required_columns(SERIES)[:2] == ["series_code", "series_name"]


# -- freshness ---------------------------------------------------------------------


def test_freshness_thresholds(rows):
    series = rows("series_code string, frequency string", ("d1", "daily"), ("d2", "daily"), ("d3", "daily"), ("m", "monthly"), ("q", "quarterly"))
    rules = freshness.cadence_rules(series)
    observations = rows(
        "series_code string, ingested_at timestamp",
        ("d1", datetime(2026, 1, 7)),
        ("d1", datetime(2025, 1, 1)),
        ("d2", datetime(2026, 1, 6, 23, 59)),
        ("m", datetime(2025, 11, 25)),
    )
    got = freshness.freshness(observations, rules, F.lit("2026-01-10 00:00:00"))
    assert collected(got, "series_code", "hours_since_loaded", "status") == [
        ("d1", 72.0, "pass"),
        ("d2", 72.0, "warn"),
        ("d3", None, "error"),
        ("m", 1104.0, "error"),
    ]
    assert collected(sets.unmonitored(series, rules), "series_code") == [("q",)]
    assert sets.unmonitored(series, rules.filter("false")).count() == 5


def test_stale_series(rows):
    today = F.lit(date(2026, 5, 20))
    series = rows("series_code string, series_name string, frequency string", *[(f, f, f) for f in ("daily", "monthly", "quarterly", "annual", "weekly")])
    schema = "series_code string, observation_date date, value double"
    edge = {"daily": date(2026, 5, 13), "monthly": date(2026, 2, 1), "quarterly": date(2025, 10, 1), "annual": date(2024, 1, 1), "weekly": date(1999, 1, 1)}
    at_edge = rows(schema, *[(f, d, 1.0) for f, d in edge.items()], ("daily", date(2026, 5, 20), None))
    assert freshness.stale_series(at_edge, series, today).count() == 0
    before = at_edge.withColumn("observation_date", F.date_sub("observation_date", 1))
    assert collected(freshness.stale_series(before, series, today), "series_code", "stale_before") == sorted(
        (f, d) for f, d in edge.items() if f != "weekly"
    )


# -- rollups and audit ---------------------------------------------------------------

RESULTS = (
    "run_id string, position long, series_name string, status string, error string, failed_checks array<string>, "
    "retryable boolean, row_count long, valid_rows long, rejected_rows long, loaded_rows long, rows_changed long"
)


def result(run, i, status="success", error=None, checks=None, retryable=None, counts=(10, 10, 0, 10, 7), name=None):
    return (run, i, name or f"s{i}", status, error, checks, retryable, *counts)


def test_run_rollup_and_message(rows):
    results = rows(
        RESULTS,
        result("r", 0, counts=(10, 10, 0, 10, 7)),
        result("r", 1, "quality_failed", checks=["min_value", "max_null_ratio"], name="tpm", counts=(5, 0, 5, None, None)),
        result("r", 2, "technical_failed", error="Read timed out", name="imacec", counts=(None,) * 5),
        result("r", 3, "technical_failed", error="", checks=[], name="ipc", counts=(None,) * 5),
        result("ok", 0),
    )
    rolled = {r.run_id: r for r in audit.run_summary(results).collect()}
    assert [rolled["r"][c] for c in ("extracted_rows", "valid_rows", "rejected_rows", "loaded_rows", "rows_changed")] == [15, 10, 5, 10, 7]
    assert rolled["r"].status == "failed" and rolled["ok"].status == "success"
    assert rolled["r"].error_message == (
        "tpm: quality_failed (min_value, max_null_ratio); imacec: technical_failed (Read timed out); "
        "ipc: technical_failed (no detail)"
    )
    assert rolled["ok"].error_message is None
    assert (rolled["r"].exit_code, rolled["ok"].exit_code) == (1, 0)


@pytest.mark.parametrize("failures", [125, 126, 127, 5000])
def test_message_of_many_short_failures(rows, failures):
    """The shortest entries there can be, around the point where the cap cuts."""
    data = [result("r", i, "f", error="e", name="n") for i in range(failures)]
    whole = "; ".join(["n: f (e)"] * failures)
    expected = whole if len(whole) <= 1000 else whole[: 1000 - len(MESSAGE_SUFFIX)] + MESSAGE_SUFFIX
    assert aggregates.error_messages(rows(RESULTS, *data).repartition(5)).head().error_message == expected


@pytest.mark.parametrize(
    "failures, expected",
    [([], 0), ([True], 75), ([True, True], 75), ([True, False], 1), ([None], 1), ([False], 1)],
)
def test_outcome(rows, failures, expected):
    data = [result("r", 0)] + [result("r", i + 1, "technical_failed", retryable=x) for i, x in enumerate(failures)]
    assert aggregates.outcome(rows(RESULTS, *data)).head().exit_code == expected


@pytest.mark.parametrize("codes, expected", [([0, 0], 0), ([0, 75], 75), ([75, 1], 1), ([2, 0], 1)])
def test_combined_outcome(rows, codes, expected):
    steps = rows("run string, exit_code long", *[("r", c) for c in codes])
    assert aggregates.combined_outcome(steps, "run").head().exit_code == expected


def test_strict_sum(rows):
    steps = rows("run string, n long", ("a", 1), ("a", 5), ("b", None), ("b", 0))
    got = steps.groupBy("run").agg(aggregates.strict_sum("n").alias("n"))
    assert collected(got) == [("a", 6), ("b", None)]


def test_status_counts_are_zero_filled_and_keep_other_statuses(rows):
    got = aggregates.status_counts(
        rows("command string, status string", ("test", "pass"), ("test", "pass"), ("test", "runtime error"), ("test", None)),
        "command",
    )
    assert collected(got, "status", "n") == sorted(
        [("pass", 2), ("warn", 0), ("error", 0), ("runtime error", 1), (None, 1)], key=repr
    )


def test_a_missing_code_or_status_is_a_failure(rows):
    steps = rows("run string, exit_code long", ("a", 0), ("a", None), ("b", 0), ("b", 75))
    assert collected(aggregates.combined_outcome(steps, "run")) == [("a", 1), ("b", 75)]
    results = rows("run_id string, status string, retryable boolean", ("a", "success", None), ("a", None, None))
    assert collected(aggregates.outcome(results)) == [("a", 1)]


def test_run_life_cycle(rows):
    t0, t1 = datetime(2026, 1, 1), datetime(2026, 1, 1, 1)
    schema = "run_id string, status string, started_at timestamp, completed_at timestamp, extracted_rows long, error_message string"
    runs = audit.record_started(rows(schema), rows("run_id string, started_at timestamp", ("a", t0), ("b", t0)))
    again = audit.record_started(runs, rows("run_id string, started_at timestamp", ("a", t1)))
    assert collected(again, "run_id", "status", "started_at") == [("a", "running", t0), ("b", "running", t0)]
    crashed = audit.record_crashed(
        again.withColumn("extracted_rows", F.lit(4).cast("long")),
        rows("run_id string, completed_at timestamp, error_message string", ("a", t1, "boom")),
    )
    assert collected(crashed, "run_id", "status", "completed_at", "extracted_rows") == [
        ("a", "crashed", t1, 4),
        ("b", "running", None, 4),
    ]


def test_events_fold_to_the_last_state(rows):
    t0, t1 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    events = rows(
        "run_id string, event_time timestamp, status string",
        ("a", t1, "success"),
        ("a", t0, "running"),
        ("b", t0, "running"),
        ("c", t0, "running"),
        ("c", t0, "crashed"),
    )
    assert collected(audit.fold_events(events), "run_id", "started_at", "status") == [
        ("a", t0, "success"),
        ("b", t0, "running"),
        ("c", t0, "crashed"),
    ]
