"""Validation gates, data quality rules, freshness and run auditing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from seriesmart.functions.text import not_finite, surrogate_key
from seriesmart.operators import aggregates, audit, digests, filters, freshness, joins, quality, sets, validate, windows
from seriesmart.operators.merge import merge_counts
from seriesmart.plans import ingest
from seriesmart.schemas import RUN_COMPLETION_COLUMNS, RUN_STATUSES

from .aggregates import CHANGE_SQL, GAPS_SQL, HISTORY_SQL, OVERLAP_SQL, SEQUENTIAL_SQL, gaps_of, holed_days, run_history
from .joins import COVERAGE_SQL, UNMONITORED_SQL, keyed, reconcile_sql
from .rows import RANGE_SQL
from .sql import query

START, END = date(1996, 1, 1), date(2000, 12, 31)

# -- validation: the profile of every configured series ------------------------

PROFILE_SQL = """
    measured AS (
      SELECT series_name, count(*) AS n, count(*) FILTER (is_missing) AS null_count,
        count(*) FILTER (day IS NULL) AS invalid_date_count,
        count(*) - count(DISTINCT coalesce(CAST(day AS VARCHAR), '')) AS duplicate_date_count,
        count(*) FILTER (day < DATE '1996-01-01' OR day > DATE '2000-12-31') AS outside,
        count(*) FILTER (is_text) AS non_numeric_count,
        count(*) FILTER (number < min_value) AS below_minimum_count
      FROM long_text JOIN (SELECT series_name, min_value FROM config) USING (series_name) GROUP BY 1),
    profiled AS (
      SELECT c.*, coalesce(n, 0) AS row_count, null_count, CAST(null_count AS DOUBLE) / n AS null_ratio,
        duplicate_date_count, invalid_date_count,
        CASE WHEN invalid_date_count = n THEN n ELSE outside END AS out_of_range_count,
        non_numeric_count, below_minimum_count
      FROM config c LEFT JOIN measured USING (series_name)),
    check_rows AS (
      SELECT series_name, 'not_empty' AS check_name, row_count > 0 AS passed, 'row_count=' || row_count AS message FROM profiled
      UNION ALL SELECT series_name, 'valid_dates', invalid_date_count = 0, 'invalid_date_count=' || invalid_date_count
      FROM profiled WHERE row_count > 0
      UNION ALL SELECT series_name, 'duplicate_dates', allow_duplicate_dates OR duplicate_date_count = 0,
        'duplicate_count=' || duplicate_date_count FROM profiled WHERE row_count > 0
      UNION ALL SELECT series_name, 'dates_within_requested_range', out_of_range_count = 0,
        'out_of_range_count=' || out_of_range_count FROM profiled WHERE row_count > 0
      UNION ALL SELECT series_name, 'null_ratio', null_ratio <= coalesce(max_null_ratio, 1),
        'null_ratio=' || printf('%.4f', null_ratio) || ', max_allowed=' || printf('%.4f', coalesce(max_null_ratio, CAST(1 AS DOUBLE)))
      FROM profiled WHERE row_count > 0
      UNION ALL SELECT series_name, 'numeric_values', NOT require_numeric OR non_numeric_count = 0,
        'non_numeric_count=' || non_numeric_count FROM profiled WHERE row_count > 0
      UNION ALL SELECT series_name, 'minimum_value', below_minimum_count = 0,
        'below_minimum_count=' || below_minimum_count || ', minimum=' || min_value
      FROM profiled WHERE row_count > 0 AND min_value IS NOT NULL),
    verdicts AS (SELECT series_name, bool_and(passed) AS passed FROM check_rows GROUP BY 1)
"""

METRICS = (
    "row_count",
    "null_count",
    "null_ratio",
    "duplicate_date_count",
    "invalid_date_count",
    "out_of_range_count",
    "non_numeric_count",
    "below_minimum_count",
)


def profiled(r):
    return validate.profile(r.long_text, r.config, START, END)


def checked(r):
    return validate.checks(profiled(r))


@query("agg_05_series_profile", PROFILE_SQL + f"SELECT series_name, {', '.join(METRICS)} FROM profiled")
def _(r):
    return profiled(r).select("series_name", *METRICS)


def one_check(name: str):
    def build(r):
        return validate.check_rows(checked(r)).filter(F.col("check_name") == name)

    return build


for _number, _check in (
    ("03", "valid_dates"),
    ("04", "duplicate_dates"),
    ("05", "dates_within_requested_range"),
    ("06", "null_ratio"),
    ("07", "numeric_values"),
    ("08", "minimum_value"),
):
    query(f"val_{_number}_{_check}", PROFILE_SQL + f"SELECT * FROM check_rows WHERE check_name = '{_check}'")(
        one_check(_check)
    )


@query(
    "val_01_not_empty",
    PROFILE_SQL
    + """
    SELECT series_name, row_count, row_count > 0 AS passed, true AS passed_in_window FROM (
      SELECT series_name, row_count FROM profiled WHERE row_count = 0)
    """,
)
def _(r):
    """An empty series fails, except under an explicit window."""
    empty = profiled(r).filter("row_count = 0")
    full = validate.checks(empty).select("series_name", "row_count", "passed")
    window = validate.checks(empty, explicit_window=True).select(
        "series_name", F.col("passed").alias("passed_in_window")
    )
    return full.join(window, "series_name")


@query(
    "val_02_columns",
    """
    SELECT series_name, bool_or(side = 'present') AS expected_column_present, bool_or(side = 'expected') AS no_unexpected_columns
    FROM (SELECT DISTINCT series_name, 'present' AS side FROM long_text
          UNION ALL SELECT series_name, 'expected' FROM config WHERE coalesce(enabled, true))
    GROUP BY 1
    """,
)
def _(r):
    return validate.series_columns(r.long_text, r.config.filter(F.coalesce("enabled", F.lit(True))))


@query(
    "val_09_overall",
    PROFILE_SQL
    + f"""
    SELECT series_name, passed, failed, {', '.join(METRICS)}
    FROM profiled JOIN verdicts USING (series_name)
      JOIN (SELECT series_name, coalesce(string_agg(check_name, ', ' ORDER BY
        list_position(['not_empty', 'valid_dates', 'duplicate_dates', 'dates_within_requested_range', 'null_ratio',
          'numeric_values', 'minimum_value'], check_name)) FILTER (NOT passed), '') AS failed
            FROM check_rows GROUP BY 1) USING (series_name)
    """,
)
def _(r):
    return checked(r).select(
        "series_name", "passed", F.concat_ws(", ", validate.failed_checks()).alias("failed"), *METRICS
    )


# Extractions that hand over a renamed column (one supplier in eleven), or a second one beside it (another one in eleven).
DELIVERED_SQL = """
    delivered_text AS (
      SELECT *, s % 11 <> 3 AND NOT extra AS here,
        CASE WHEN s % 11 = 3 THEN 'renamed ' || s WHEN extra THEN 'extra' ELSE series_name END AS came_in
      FROM (SELECT *, CAST(substring(series_name, 8) AS BIGINT) AS s,
              coalesce(CAST(substring(series_name, 8) AS BIGINT) % 11 = 5 AND number % 2 < 1, false) AS extra
            FROM long_text)),
    delivered_metrics AS (
      SELECT series_name, count(*) AS all_rows, list_sort(list(DISTINCT came_in)) AS actual, count(*) FILTER (here) AS n,
        count(*) FILTER (here AND is_missing) AS null_count, count(*) FILTER (here AND day IS NULL) AS invalid_date_count,
        count(*) FILTER (here) - count(DISTINCT CASE WHEN here THEN coalesce(CAST(day AS VARCHAR), '') END) AS duplicate_date_count,
        count(*) FILTER (here AND (day < DATE '1996-01-01' OR day > DATE '2000-12-31')) AS outside,
        count(*) FILTER (here AND is_text) AS non_numeric_count, count(*) FILTER (here AND number < min_value) AS below_minimum_count
      FROM delivered_text JOIN (SELECT series_name, min_value FROM config) USING (series_name) GROUP BY 1),
    judged AS (
      SELECT c.*, coalesce(CASE WHEN n > 0 THEN n ELSE all_rows END, 0) AS row_count, actual, n > 0 AS present, null_count / n AS null_ratio,
        list_filter(actual, lambda x: x <> c.series_name) AS unexpected, invalid_date_count, duplicate_date_count,
        CASE WHEN invalid_date_count = n THEN n ELSE outside END AS out_of_range_count, non_numeric_count, below_minimum_count
      FROM config c LEFT JOIN delivered_metrics USING (series_name)),
    named AS (
      SELECT *, '[' || array_to_string(list_transform(actual, lambda x: chr(39) || x || chr(39)), ', ') || ']' AS listed,
        '[' || array_to_string(list_transform(unexpected, lambda x: chr(39) || x || chr(39)), ', ') || ']' AS unlisted
      FROM judged),
    nine AS (
      SELECT series_name, 'not_empty' AS check_name, row_count > 0 AS passed, 'row_count=' || row_count AS message FROM named
      UNION ALL SELECT series_name, 'expected_column_present', present, 'expected=' || series_name || ', actual=' || listed FROM named WHERE row_count > 0
      UNION ALL SELECT series_name, 'no_unexpected_columns', len(unexpected) = 0, 'unexpected_columns=' || unlisted FROM named WHERE row_count > 0
      UNION ALL SELECT series_name, 'valid_dates', invalid_date_count = 0, 'invalid_date_count=' || invalid_date_count FROM named WHERE present
      UNION ALL SELECT series_name, 'duplicate_dates', allow_duplicate_dates OR duplicate_date_count = 0,
        'duplicate_count=' || duplicate_date_count FROM named WHERE present
      UNION ALL SELECT series_name, 'dates_within_requested_range', out_of_range_count = 0,
        'out_of_range_count=' || out_of_range_count FROM named WHERE present
      UNION ALL SELECT series_name, 'null_ratio', null_ratio <= coalesce(max_null_ratio, 1), 'null_ratio=' || printf('%.4f', null_ratio)
        || ', max_allowed=' || printf('%.4f', coalesce(max_null_ratio, CAST(1 AS DOUBLE))) FROM named WHERE present
      UNION ALL SELECT series_name, 'numeric_values', NOT require_numeric OR non_numeric_count = 0,
        'non_numeric_count=' || non_numeric_count FROM named WHERE present
      UNION ALL SELECT series_name, 'minimum_value', below_minimum_count = 0,
        'below_minimum_count=' || below_minimum_count || ', minimum=' || min_value FROM named WHERE present AND min_value IS NOT NULL)
"""


def delivered_checks(r):
    s = F.expr("cast(substring(series_name, 8) as bigint)")
    number = F.expr("CASE WHEN value NOT LIKE '%d' THEN try_cast(value AS double) END")
    extra = F.coalesce((s % 11 == 5) & (number % 2 < 1), F.lit(False))
    came_in = F.when(s % 11 == 3, F.concat(F.lit("renamed "), s)).when(extra, F.lit("extra"))
    rows = r.long_text.withColumn("column_name", came_in)
    return validate.checks(validate.profile(rows, r.config, START, END, delivered="column_name"))


@query(
    "val_02_column_checks",
    DELIVERED_SQL + "SELECT * FROM nine WHERE check_name IN ('expected_column_present', 'no_unexpected_columns')",
)
def _(r):
    rows = validate.check_rows(delivered_checks(r))
    return rows.filter(F.col("check_name").isin("expected_column_present", "no_unexpected_columns"))


@query("val_09_nine_checks", DELIVERED_SQL + "SELECT * FROM nine")
def _(r):
    """All nine checks of every series; three where the expected column did not come."""
    return validate.check_rows(delivered_checks(r))


METADATA_SQL = """
    matched AS (SELECT series_code, count(*) AS n, min(lower(frequency_code)) AS source_frequency FROM catalog GROUP BY 1),
    joined AS (
      SELECT c.series_code, c.frequency, coalesce(n, 0) AS match_count, source_frequency, u.series_code IS NOT NULL AS has_entry,
        CASE WHEN coalesce(u.series_name, '') = '' THEN ['''series_name'''] ELSE [] END
        || CASE WHEN coalesce(u.category, '') = '' THEN ['''category'''] ELSE [] END
        || CASE WHEN coalesce(u.unit, '') = '' THEN ['''unit'''] ELSE [] END AS missing
      FROM config c LEFT JOIN matched USING (series_code) LEFT JOIN curated u USING (series_code)),
    metadata_checks AS (
      SELECT series_code, 'found_in_catalog' AS check_name, match_count > 0 AS passed, 'match_count=' || match_count AS message FROM joined
      UNION ALL SELECT series_code, 'unique_in_catalog', match_count <= 1, 'match_count=' || match_count FROM joined
      UNION ALL SELECT series_code, 'frequency_matches_config', frequency IS NULL OR lower(frequency) = source_frequency,
        'source=' || source_frequency || ', configured=' || coalesce(frequency, 'None') FROM joined WHERE match_count = 1
      UNION ALL SELECT series_code, 'curated_metadata_present', has_entry, 'series_code=' || series_code FROM joined
      UNION ALL SELECT series_code, 'curated_required_fields', len(missing) = 0,
        'missing_fields=[' || array_to_string(missing, ', ') || ']' FROM joined)
"""


def metadata_rows(*names):
    def build(r):
        checks = validate.metadata_checks(r.config, r.catalog, r.curated)
        return validate.check_rows(checks, "series_code").filter(F.col("check_name").isin(list(names)))

    return build


for _id, _names in (
    ("val_10_catalog", ("found_in_catalog", "unique_in_catalog")),
    ("val_11_frequency_matches_config", ("frequency_matches_config",)),
    ("val_12_curated", ("curated_metadata_present", "curated_required_fields")),
):
    _listed = ", ".join(f"'{n}'" for n in _names)
    query(_id, METADATA_SQL + f"SELECT * FROM metadata_checks WHERE check_name IN ({_listed})")(metadata_rows(*_names))


@query(
    "val_13_stage_counts",
    PROFILE_SQL
    + """
    SELECT series_name, CASE WHEN passed THEN 'success' ELSE 'quality_failed' END AS status, row_count,
      CASE WHEN passed THEN row_count ELSE 0 END AS valid_rows, CASE WHEN passed THEN 0 ELSE row_count END AS rejected_rows,
      CASE WHEN passed THEN row_count ELSE 0 END AS loaded_rows
    FROM profiled JOIN verdicts USING (series_name)
    """,
)
def _(r):
    return validate.stage_counts(checked(r))


GATE_SQL = """
    measured AS (
      SELECT series_name, count(*) AS n, count(*) - count(value) AS nulls, count(*) FILTER (value < min_value) AS below
      FROM raw_observations JOIN (SELECT series_name, min_value FROM config) USING (series_name) GROUP BY 1),
    verdicts AS (
      SELECT series_name, CAST(nulls AS DOUBLE) / n <= coalesce(max_null_ratio, 1) AND below = 0 AS passed
      FROM measured JOIN config USING (series_name))
"""


@query(
    "val_13_quarantine",
    GATE_SQL + "SELECT series_name, observation_date, value FROM raw_observations JOIN verdicts USING (series_name) WHERE NOT passed",
)
def _(r):
    """Rows of series that failed; typed values, over the whole history."""
    return _ingested(r).rejected


def _ingested(r):
    long = r.raw_observations.select("series_name", "observation_date", "value")
    at = F.lit("2002-02-01 00:00:00").cast("timestamp")
    return ingest.ingest_observations(
        r.first_load, long, r.config, date(1990, 1, 1), date(2010, 1, 1), at, at, F.lit("run-all"), "tpch"
    )


@query(
    "val_13_ingest_counts",
    GATE_SQL
    + """,
    accepted AS (SELECT o.* FROM raw_observations o JOIN verdicts USING (series_name) WHERE passed)
    SELECT count(*) FILTER (t.series_code IS NULL) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted,
      count(*) FILTER (t.series_code IS NULL) AS rows_changed
    FROM accepted a LEFT JOIN first_load t ON t.series_code = a.series_code AND t.observation_date = a.observation_date
    """,
)
def _(r):
    """Validate, gate, canonicalise and merge in one plan: only rows new to the table change it."""
    return merge_counts(_ingested(r).plan)


# -- data quality ---------------------------------------------------------------

OBS_KEYS = "series_code, observation_date"


@query("dq_01_not_null", f"SELECT {OBS_KEYS}, value FROM obs WHERE value IS NULL")
def _(r):
    return r.obs.select("series_code", "observation_date", "value").filter(quality.is_null("value"))


@query(
    "dq_02_unique",
    "SELECT series_code, count(*) AS n_records FROM faulty_config WHERE series_code IS NOT NULL "
    "GROUP BY 1 HAVING count(*) > 1",
)
def _(r):
    return quality.unique(r.faulty_config, "series_code")


@query(
    "dq_03_unique_where",
    "SELECT series_code, count(*) AS n_records FROM versions WHERE valid_to IS NULL GROUP BY 1 HAVING count(*) > 1",
)
def _(r):
    return quality.unique(r.versions, "series_code", where=F.col("valid_to").isNull())


@query(
    "dq_04_accepted_values",
    "SELECT series_code, frequency_code FROM catalog "
    "WHERE frequency_code NOT IN ('DAILY', 'MONTHLY', 'QUARTERLY', 'ANNUAL')",
)
def _(r):
    allowed = ("DAILY", "MONTHLY", "QUARTERLY", "ANNUAL")
    return r.catalog.filter(quality.not_accepted("frequency_code", allowed)).select("series_code", "frequency_code")


@query(
    "dq_05_relationships",
    "SELECT series_code, observation_date, ingestion_run_id FROM obs "
    "WHERE ingestion_run_id NOT IN (SELECT run_id FROM runs)",
)
def _(r):
    rows = r.obs.select("series_code", "observation_date", "ingestion_run_id")
    return joins.orphans(rows, r.runs, "ingestion_run_id", "run_id")


@query(
    "dq_06_unique_combination",
    "SELECT series_name, observation_date, count(*) AS n_records FROM ("
    "SELECT series_name, coalesce(CAST(day AS VARCHAR), 'not-a-date') AS observation_date FROM long_text) "
    "GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(r):
    return aggregates.duplicate_keys(r.long_text, ["series_name", "observation_date"])


@query(
    "dq_07_expression_is_true",
    "SELECT run_id, valid_rows, loaded_rows FROM runs WHERE status IN ('success', 'failed') AND NOT (loaded_rows <= valid_rows)",
)
def _(r):
    broken = quality.not_true(
        F.col("loaded_rows") <= F.col("valid_rows"), where=F.col("status").isin("success", "failed")
    )
    return r.runs.filter(broken).select("run_id", "valid_rows", "loaded_rows")


@query("dq_08_accepted_range", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45")
def _(r):
    return r.table("lineitem").filter(quality.outside("l_quantity", 5, 45)).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("dq_09_sequential_values", SEQUENTIAL_SQL.format(every=17))
def _(r):
    return windows.not_sequential(holed_days(r, 17))


def rule_set(r) -> quality.RuleSet:
    """Rules of all four tags over observations, runs, calendar and series."""
    tables = {"observations": r.dirty_obs, "runs": r.runs, "calendar": r.dim_date, "series": r.series}
    rules = quality.RuleSet(tables)
    for column in ("series_code", "observation_date", "value", "extracted_at"):
        rules.add(f"not_null_{column}", "observations", quality.is_null(column))
    rules.add("finite", "observations", not_finite("value"), tag="structural")
    rules.add("on_grid", "observations", quality.off_grid("value"), tag="domain")
    rules.add("known_status", "runs", quality.not_accepted("status", RUN_STATUSES))
    for name, broken in quality.run_invariants().items():
        rules.add(name, "runs", broken, tag="operational")
    for name, broken in quality.calendar_invariants().items():
        rules.add(name, "calendar", broken, tag="structural")
    rules.add("unique_series", "series", lambda: quality.unique(r.series, "series_code"))
    rules.add(
        "runs_registered",
        "observations",
        lambda: joins.orphans(r.obs, r.runs, "ingestion_run_id", "run_id"),
        tag="integrity",
    )
    rules.add("no_gaps", "observations", lambda: gaps_of(r), tag="operational")
    rules.add(
        "not_stale",
        "series",
        lambda: freshness.stale_series(r.obs, r.series, F.lit("2001-12-01").cast("date")),
        tag="operational",
        severity="warn",
    )
    return rules


# How far a series may lie behind the start of the current period.
STALE_SQL = """
    slack(frequency, unit, back) AS (VALUES ('daily', 'day', INTERVAL 7 DAY), ('monthly', 'month', INTERVAL 3 MONTH),
      ('quarterly', 'quarter', INTERVAL 6 MONTH), ('annual', 'year', INTERVAL 24 MONTH)),
    limits_ AS (SELECT frequency, CAST(date_trunc(unit, DATE '{today}') - back AS DATE) AS stale_before FROM slack),
    stale AS (
      SELECT series_code, series_name, frequency, max(observation_date) AS latest_observation_date, stale_before
      FROM series JOIN limits_ USING (frequency) JOIN obs USING (series_code) WHERE value IS NOT NULL
      GROUP BY ALL HAVING latest_observation_date < stale_before)
"""

INVARIANTS_SQL = """
    run_flags AS (
      SELECT run_id,
        CASE WHEN status IN ('running', 'unknown') THEN completed_at IS NOT NULL
          ELSE NOT coalesce(completed_at >= started_at, false) END AS completed_iff_finished,
        status IN ('success', 'failed') AND NOT (valid_rows + rejected_rows <= extracted_rows AND loaded_rows <= valid_rows)
          AS stage_counts_shrink,
        status NOT IN ('running', 'unknown') AND (status IN ('failed', 'crashed')) <> (error_message IS NOT NULL)
          AS error_iff_failed,
        coalesce(length(error_message) > 1000, false) AS error_is_short
      FROM runs)
"""

GRID = "NOT isnan(value) AND abs(value * 4 - round(value * 4)) > 1e-9"

RULES_SQL = (
    STALE_SQL.format(today="2001-12-01").rstrip()
    + ","
    + INVARIANTS_SQL.rstrip()
    + ",\n    gap_rows AS (WITH "
    + GAPS_SQL.strip()
    + ")"
    + f""",
    counted AS (
      SELECT 'not_null_series_code' AS rule, 'observations' AS table_name, 'generic' AS tag, 'error' AS severity,
        count(*) FILTER (series_code IS NULL) AS failures FROM dirty_obs
      UNION ALL SELECT 'not_null_observation_date', 'observations', 'generic', 'error', count(*) FILTER (observation_date IS NULL) FROM dirty_obs
      UNION ALL SELECT 'not_null_value', 'observations', 'generic', 'error', count(*) FILTER (value IS NULL) FROM dirty_obs
      UNION ALL SELECT 'not_null_extracted_at', 'observations', 'generic', 'error', count(*) FILTER (extracted_at IS NULL) FROM dirty_obs
      UNION ALL SELECT 'finite', 'observations', 'structural', 'error', count(*) FILTER (isnan(value) OR isinf(value)) FROM dirty_obs
      UNION ALL SELECT 'on_grid', 'observations', 'domain', 'error',
        count(*) FILTER (NOT isinf(value) AND {GRID}) FROM dirty_obs
      UNION ALL SELECT 'known_status', 'runs', 'generic', 'error',
        count(*) FILTER (status NOT IN ('running', 'success', 'failed', 'crashed', 'unknown')) FROM runs
      UNION ALL SELECT 'completed_iff_finished', 'runs', 'operational', 'error', count(*) FILTER (completed_iff_finished) FROM run_flags
      UNION ALL SELECT 'stage_counts_shrink', 'runs', 'operational', 'error', count(*) FILTER (stage_counts_shrink) FROM run_flags
      UNION ALL SELECT 'error_iff_failed', 'runs', 'operational', 'error', count(*) FILTER (error_iff_failed) FROM run_flags
      UNION ALL SELECT 'error_is_short', 'runs', 'operational', 'error', count(*) FILTER (error_is_short) FROM run_flags
      UNION ALL SELECT 'weekend_agrees_with_date', 'calendar', 'structural', 'error',
        count(*) FILTER (is_weekend <> (dayofweek(date_day) IN (0, 6))) FROM dim_date
      UNION ALL SELECT 'key_agrees_with_date', 'calendar', 'structural', 'error',
        count(*) FILTER (date_key <> year(date_day) * 10000 + month(date_day) * 100 + day(date_day)) FROM dim_date
      UNION ALL SELECT 'unique_series', 'series', 'generic', 'error', count(*) FROM (
        SELECT series_code FROM series GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'runs_registered', 'observations', 'integrity', 'error', count(*) FROM obs
        WHERE ingestion_run_id NOT IN (SELECT run_id FROM runs)
      UNION ALL SELECT 'no_gaps', 'observations', 'operational', 'error', count(*) FROM gap_rows
      UNION ALL SELECT 'not_stale', 'series', 'operational', 'warn', count(*) FROM stale),
    rule_results AS (
      SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'error' END AS status FROM counted)
"""
)


@query("dq_10_severity_and_tags", RULES_SQL + "SELECT * FROM rule_results")
def _(r):
    return rule_set(r).results()


@query(
    "dq_10_tag_selection",
    RULES_SQL + "SELECT * FROM rule_results WHERE tag IN ('structural', 'integrity')",
)
def _(r):
    return rule_set(r).tagged("structural", "integrity").results()


@query(
    "dq_11_results_rollup",
    RULES_SQL
    + """
    SELECT tag, s AS status, count(*) FILTER (status = s) AS n
    FROM rule_results CROSS JOIN (VALUES ('pass'), ('warn'), ('error')) AS listed(s) GROUP BY 1, 2
    """,
)
def _(r):
    return aggregates.status_counts(rule_set(r).results(), "tag")


@query(
    "dq_12_first_of_month",
    "SELECT series_code, observation_date, value FROM obs JOIN series USING (series_code) "
    "WHERE frequency = 'monthly' AND day(observation_date) <> 1",
)
def _(r):
    return quality.not_first_of_month(r.obs, r.series)


@query(
    "dq_13_finite_values",
    f"SELECT {OBS_KEYS}, CAST(value AS VARCHAR) AS value_text FROM dirty_obs WHERE isnan(value) OR isinf(value)",
)
def _(r):
    named = F.when(F.isnan("value"), "nan").when(F.col("value") > 0, "inf").otherwise("-inf")
    return quality.infinite_values(r.dirty_obs).select("series_code", "observation_date", named.alias("value_text"))


@query(
    "dq_14_no_weekend_values",
    "SELECT series_code, observation_date, dayname(observation_date) AS day_name, value "
    "FROM obs JOIN series USING (series_code) "
    "WHERE frequency = 'daily' AND value IS NOT NULL AND dayofweek(observation_date) IN (0, 6)",
)
def _(r):
    return quality.weekend_values(r.obs, r.series)


@query("dq_15_value_ranges", RANGE_SQL.format(rows="dirty_obs").replace("o.value\n", "CAST(o.value AS VARCHAR) IN ('inf', '-inf') AS is_infinite\n", 1))
def _(r):
    """NaN passes every range, an infinity fails one."""
    rows = r.dirty_obs.select("series_code", "observation_date", "value")
    return filters.out_of_range(rows, r.bounds).select(
        "series_code", "observation_date", not_finite("value").alias("is_infinite")
    )


@query("dq_16_step_grid", f"SELECT {OBS_KEYS}, value FROM obs WHERE {GRID}")
def _(r):
    return r.obs.filter(quality.off_grid("value")).select("series_code", "observation_date", "value")


@query("dq_17_pct_change_limit", f"changes AS (WITH {CHANGE_SQL.strip()}) SELECT * FROM changes WHERE abs(change) > 0.10")
def _(r):
    return windows.change_over_limit(r.obs, 0.10).select(
        "series_code", "previous_date", "previous_value", "observation_date", "value", "change", "change_pct"
    )


# One query for each way to be too early, and one for a clock ahead of the check.
FUTURE_SQL = """
    local AS (
      SELECT o.series_code, s.frequency, o.observation_date, o.value, o.extracted_at,
        CAST(timezone('America/Santiago', timezone('UTC', o.extracted_at)) AS DATE) AS taken_on
      FROM obs o JOIN series s ON s.series_code = o.series_code),
    ahead AS (
      SELECT * FROM local WHERE frequency = 'daily' AND observation_date - taken_on > 4
      UNION ALL
      SELECT * FROM local WHERE frequency = 'monthly'
        AND strftime(observation_date, '%Y-%m') >= strftime(taken_on, '%Y-%m')
      UNION ALL
      SELECT * FROM local WHERE frequency IN ('quarterly', 'annual') AND observation_date > taken_on)
    SELECT * EXCLUDE (taken_on), 'extracted_at in the future' AS issue FROM local
    WHERE extracted_at > TIMESTAMP '2001-10-01 00:00:00'
    UNION ALL
    SELECT * EXCLUDE (taken_on), 'observation_date after it could be published' FROM ahead
    WHERE extracted_at <= TIMESTAMP '2001-10-01 00:00:00'
"""


@query("dq_18_no_future_dates", FUTURE_SQL)
def _(r):
    return quality.future_dates(r.obs, r.series, F.lit("2001-10-01 00:00:00").cast("timestamp"))


@query("dq_19_coverage_start", COVERAGE_SQL)
def _(r):
    return quality.before_coverage(r.obs, r.series)


# The observations of nation 24 have no series of their code, so no facts; the ghosts have no observations.
@query(
    "dq_20_every_series_has_facts",
    "SELECT md5(series_code) AS series_key, series_code FROM config WHERE md5(series_code) NOT IN (SELECT series_key FROM fact)",
)
def _(r):
    series = r.config.select(surrogate_key("series_code").alias("series_key"), "series_code")
    return joins.missing_children(series, r.fact, "series_key")


FACT_SQL = "SELECT series_key, observation_date, value, ingestion_run_id FROM fact"


@query("dq_21_fact_reconciles", reconcile_sql("retracted_obs", FACT_SQL))
def _(r):
    return joins.reconcile(
        keyed(r, r.retracted_obs), r.fact, ["series_key", "observation_date"], "value", "ingestion_run_id"
    )


@query("dq_21_digest_reconcile", reconcile_sql("retracted_obs", FACT_SQL))
def _(r):
    """Retractions are everywhere here, so every range differs and all rows are joined after all."""
    return digests.reconcile(
        keyed(r, r.retracted_obs), r.fact, ["series_key", "observation_date"], "value", "ingestion_run_id", day="observation_date"
    )


@query("dq_22_versions_no_overlap", OVERLAP_SQL)
def _(r):
    return windows.version_overlaps(r.versions)


@query("dq_23_no_gaps", GAPS_SQL)
def _(r):
    return gaps_of(r)


@query("dq_24_not_stale", STALE_SQL.format(today="2001-12-01") + "SELECT * FROM stale")
def _(r):
    return freshness.stale_series(r.obs, r.series, F.lit("2001-12-01").cast("date"))


@query(
    "dq_25_stuck_runs",
    "SELECT run_id, pipeline, target_table, started_at FROM runs "
    "WHERE status = 'running' AND started_at < TIMESTAMP '2001-06-01 03:00:00' - INTERVAL 2 HOUR",
)
def _(r):
    return quality.stuck_runs(r.runs, F.lit("2001-06-01 03:00:00")).select(
        "run_id", "pipeline", "target_table", "started_at"
    )


@query("dq_26_unmonitored_series", UNMONITORED_SQL)
def _(r):
    named = r.series.select("series_code", "series_name", "frequency")
    return sets.unmonitored(named, freshness.cadence_rules(r.series))


@query("dq_27_run_invariants", INVARIANTS_SQL + "SELECT * FROM run_flags")
def _(r):
    flags = [F.coalesce(broken, F.lit(False)).alias(name) for name, broken in quality.run_invariants().items()]
    return r.runs.select("run_id", *flags)


# The calendar with its weekend flag shifted by the day-of-week of another day.
@query(
    "dq_28_calendar_invariants",
    """
    SELECT date_day, date_key, is_weekend FROM (
      SELECT date_day, date_key + CASE WHEN month_name = 'May' THEN 1 ELSE 0 END AS date_key,
        day_of_week IN (1, 6) AS is_weekend FROM dim_date)
    WHERE is_weekend <> (dayofweek(date_day) IN (0, 6)) OR date_key <> CAST(strftime(date_day, '%Y%m%d') AS BIGINT)
    """,
)
def _(r):
    broken = quality.calendar_invariants()
    calendar = r.dim_date.select(
        "date_day",
        (F.col("date_key") + F.when(F.col("month_name") == "May", 1).otherwise(0)).alias("date_key"),
        F.col("day_of_week").isin(1, 6).alias("is_weekend"),
    )
    return calendar.filter(broken["weekend_agrees_with_date"] | broken["key_agrees_with_date"])


@query(
    "dq_29_source_freshness",
    """
    rules AS (
      SELECT series_code, CASE frequency WHEN 'daily' THEN 72 WHEN 'monthly' THEN 840 END AS warn_h,
        CASE frequency WHEN 'daily' THEN 120 WHEN 'monthly' THEN 1080 END AS error_h
      FROM config WHERE frequency IN ('daily', 'monthly')),
    loaded AS (SELECT series_code, max(ingested_at) AS max_loaded_at FROM raw_observations GROUP BY 1),
    aged AS (
      SELECT series_code, max_loaded_at, warn_h, error_h,
        date_diff('second', max_loaded_at, TIMESTAMP '2001-11-12 00:30:00') AS age
      FROM rules LEFT JOIN loaded USING (series_code))
    SELECT series_code, max_loaded_at, CAST(round(CAST(age AS DECIMAL(18, 6)) / 3600, 1) AS DOUBLE) AS hours_since_loaded,
      CASE WHEN age IS NULL OR age > error_h * 3600 THEN 'error' WHEN age > warn_h * 3600 THEN 'warn' ELSE 'pass' END AS status
    FROM aged
    """,
)
def _(r):
    rules = freshness.cadence_rules(r.config)
    return freshness.freshness(r.raw_observations, rules, F.lit("2001-11-12 00:30:00"))


# -- auditing -------------------------------------------------------------------

AUDIT = ("run_id", "source", "started_at", "completed_at", "status", "extracted_rows", "error_message", "pipeline",
         "target_table")
AUDIT_SQL = ", ".join(AUDIT)


def run_starts(r):
    return r.runs.select("run_id", "source", "started_at", "pipeline", "target_table")


def run_table(r):
    """Runs started before 1999, as recorded when they started."""
    early = r.runs.filter("started_at < TIMESTAMP'1999-01-01 00:00:00'")
    return early.select(
        "run_id",
        "source",
        "started_at",
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit("running").alias("status"),
        F.lit(None).cast("long").alias("extracted_rows"),
        F.lit(None).cast("string").alias("error_message"),
        "pipeline",
        "target_table",
    )


@query(
    "aud_01_run_started",
    "SELECT run_id, source, started_at, CAST(NULL AS TIMESTAMP) AS completed_at, 'running' AS status, "
    "CAST(NULL AS BIGINT) AS extracted_rows, CAST(NULL AS VARCHAR) AS error_message, pipeline, target_table FROM runs",
)
def _(r):
    return audit.record_started(run_table(r), run_starts(r))


@query(
    "aud_02_run_completed",
    f"""
    SELECT {AUDIT_SQL.replace('completed_at, status, extracted_rows, error_message',
      "CASE WHEN fin THEN completed_at END AS completed_at, CASE WHEN fin THEN status ELSE 'running' END AS status, "
      "CASE WHEN fin THEN extracted_rows END AS extracted_rows, CASE WHEN fin THEN error_message END AS error_message")}
    FROM (SELECT *, status IN ('success', 'failed') AS fin FROM runs)
    WHERE fin OR started_at < TIMESTAMP '1999-01-01 00:00:00'
    """,
)
def _(r):
    extra = ("valid_rows", "rejected_rows", "loaded_rows", "exit_code", "rows_changed")
    done = r.runs.filter("status IN ('success', 'failed')").select(*AUDIT, *extra, "summary_uri")
    return audit.record_completed(run_table(r), done)


@query(
    "aud_02_all_columns",
    """
    SELECT run_id, source, started_at, pipeline, target_table, CASE WHEN fin THEN status ELSE 'running' END AS status,
      CASE WHEN fin THEN completed_at END AS completed_at, CASE WHEN fin THEN extracted_rows END AS extracted_rows,
      CASE WHEN fin THEN valid_rows END AS valid_rows, CASE WHEN fin THEN rejected_rows END AS rejected_rows,
      CASE WHEN fin THEN loaded_rows END AS loaded_rows, CASE WHEN fin THEN error_message END AS error_message,
      CASE WHEN fin THEN exit_code END AS exit_code, CASE WHEN fin THEN rows_changed END AS rows_changed,
      CASE WHEN fin THEN 'summaries/' || run_id END AS summary_uri
    FROM (SELECT *, status IN ('success', 'failed') AS fin FROM runs)
    WHERE fin OR started_at < TIMESTAMP '1999-01-01 00:00:00'
    """,
)
def _(r):
    """A run table with every completion column, and completions that fill all of them."""
    named = r.runs.withColumn("summary_uri", F.concat(F.lit("summaries/"), F.col("run_id")))
    identity = ("run_id", "source", "started_at", "pipeline", "target_table")
    unset = [F.lit(None).cast(named.schema[c].dataType).alias(c) for c in RUN_COMPLETION_COLUMNS if c != "status"]
    started = named.filter("started_at < TIMESTAMP'1999-01-01 00:00:00'").select(*identity, F.lit("running").alias("status"), *unset)
    done = named.filter("status IN ('success', 'failed')").select(*identity, *RUN_COMPLETION_COLUMNS)
    return audit.record_completed(started, done)


@query(
    "aud_03_run_crashed",
    f"""
    SELECT run_id, source, started_at, CASE WHEN bad THEN completed_at END AS completed_at,
      CASE WHEN bad THEN 'crashed' ELSE 'running' END AS status, CAST(NULL AS BIGINT) AS extracted_rows,
      CASE WHEN bad THEN error_message END AS error_message, pipeline, target_table
    FROM (SELECT *, status = 'crashed' AS bad FROM runs)
    WHERE bad OR started_at < TIMESTAMP '1999-01-01 00:00:00'
    """,
)
def _(r):
    crashed = r.runs.filter("status = 'crashed'").select(
        "run_id", "source", "started_at", "completed_at", "error_message", "pipeline", "target_table"
    )
    return audit.record_crashed(run_table(r), crashed)


@query(
    "aud_04_run_events_fold",
    """
    SELECT run_id || '-' || position AS run_id, t AS started_at,
      CASE WHEN retries = 1 THEN t + to_hours(CAST(row_count AS INTEGER)) ELSE t END AS event_time,
      CASE WHEN retries = 2 THEN 'running' WHEN retries = 0 THEN 'crashed'
        WHEN status = 'success' THEN 'success' ELSE 'failed' END AS status
    FROM (SELECT *, CAST(strptime(substring(run_id, 5) || '01', '%Y%m%d') AS TIMESTAMP) AS t FROM results)
    """,
)
def _(r):
    return audit.fold_events(r.run_events)


@query("aud_05_run_history", HISTORY_SQL)
def _(r):
    return run_history(r)


@query(
    "aud_06_step_report",
    """
    SELECT u.run_id, pipeline, u.status, exit_code, u.rows_changed,
      CAST(trunc((epoch_us(completed_at) - epoch_us(started_at)) / 1000000) AS BIGINT) AS duration_seconds, parent_run_id,
      coalesce(x.retries, 0) AS api_retries
    FROM runs u LEFT JOIN (SELECT run_id, CAST(sum(retries) AS BIGINT) AS retries FROM results GROUP BY 1) x USING (run_id)
    """,
)
def _(r):
    return audit.step_report(r.runs, r.results)


@query(
    "aud_07_label_search",
    "SELECT o_orderkey AS job_id FROM orders WHERE strftime(o_orderdate, '%Y%m%d') LIKE '1997%'",
)
def _(r):
    return audit.jobs_with_label(r.jobs, "run_id", "1997%").select("job_id")
