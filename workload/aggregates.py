"""Aggregations, windows and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmart.functions.text import MESSAGE_SUFFIX, lenient_date
from seriesmart.operators import aggregates, sets, windows
from seriesmart.operators.quality import with_frequency
from seriesmart.sources import tables

from .sql import query


@query(
    "agg_01_global_min_max",
    "SELECT min(observation_date) AS min_date, max(observation_date) AS max_date FROM obs",
)
def _(r):
    return aggregates.bounds(r.obs)


@query(
    "agg_02_latest_per_series",
    "SELECT series_code, series_name, frequency, max(observation_date) AS latest_observation_date "
    "FROM raw_observations WHERE value IS NOT NULL GROUP BY ALL",
)
def _(r):
    return aggregates.latest_per_series(r.raw_observations)


@query(
    "agg_03_high_water_mark",
    "SELECT coalesce(max(extracted_at), TIMESTAMP '1900-01-01 00:00:00') AS high_water_mark FROM fact",
)
def _(r):
    return aggregates.high_water_mark(r.fact)


@query(
    "agg_04_duplicate_keys",
    "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS ship_date, count(*) AS n_records FROM lineitem "
    "GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(r):
    rows = r.table("lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("ship_date"))
    return aggregates.duplicate_keys(rows, ["l_suppkey", "ship_date"])


RUN_ROLLUP_SQL = """
    SELECT run_id, CAST(sum(row_count) AS BIGINT) AS extracted_rows, CAST(sum(valid_rows) AS BIGINT) AS valid_rows,
      CAST(sum(rejected_rows) AS BIGINT) AS rejected_rows,
      CAST(sum(coalesce(loaded_rows, 0)) AS BIGINT) AS loaded_rows,
      CAST(sum(coalesce(rows_changed, 0)) AS BIGINT) AS rows_changed, count(*) AS total_series,
      count(*) FILTER (status = 'success') AS success_count,
      count(*) FILTER (status = 'quality_failed') AS quality_failed_count,
      count(*) FILTER (status = 'technical_failed') AS technical_failed_count,
      CASE WHEN count(*) FILTER (status <> 'success') = 0 THEN 'success' ELSE 'failed' END AS status
    FROM results GROUP BY run_id
"""


@query("agg_06_run_rollup", RUN_ROLLUP_SQL)
def _(r):
    return aggregates.run_rollup(r.results)


ERROR_SQL = f"""
    texts AS (
      SELECT run_id, string_agg(series_name || ': ' || status || ' (' || coalesce(error, failed, 'no detail') || ')', '; '
        ORDER BY position) AS m
      FROM results WHERE status <> 'success' GROUP BY run_id),
    messages AS (
      SELECT run_id, CASE WHEN length(m) > 1000
        THEN substring(m, 1, 1000 - length('{MESSAGE_SUFFIX}')) || '{MESSAGE_SUFFIX}' ELSE m END AS error_message
      FROM texts)
"""


@query("agg_07_error_rollup", ERROR_SQL + "SELECT * FROM messages")
def _(r):
    return aggregates.error_messages(r.results)


OUTCOME_SQL = """
    SELECT run_id, CAST(CASE WHEN count(*) FILTER (status <> 'success') = 0 THEN 0
      WHEN count(*) FILTER (status <> 'success' AND NOT coalesce(retryable, false)) = 0 THEN 75 ELSE 1 END AS BIGINT)
      AS exit_code
    FROM results GROUP BY run_id
"""


@query("agg_08_outcome_rollup", OUTCOME_SQL)
def _(r):
    return aggregates.outcome(r.results)


@query(
    "agg_08_combined_outcome",
    """
    SELECT parent_run_id, CAST(CASE WHEN max(worst) = 0 THEN 0 WHEN max(worst) = 1 THEN 75 ELSE 1 END AS BIGINT)
      AS exit_code
    FROM (SELECT parent_run_id, CASE exit_code WHEN 0 THEN 0 WHEN 75 THEN 1 ELSE 2 END AS worst FROM runs)
    GROUP BY 1
    """,
)
def _(r):
    return aggregates.combined_outcome(r.runs, "parent_run_id")


@query(
    "agg_09_null_propagating_sum",
    "SELECT parent_run_id, CASE WHEN count(*) = count(rows_changed) THEN CAST(sum(rows_changed) AS BIGINT) END "
    "AS rows_changed FROM runs GROUP BY 1",
)
def _(r):
    return r.runs.groupBy("parent_run_id").agg(aggregates.strict_sum("rows_changed").alias("rows_changed"))


STATUS_SQL = """
    named AS (
      SELECT run_id AS command,
        CASE status WHEN 'success' THEN CASE WHEN series_code LIKE '%7' THEN 'runtime error' ELSE 'pass' END
          WHEN 'technical_failed' THEN 'warn' WHEN 'quality_failed' THEN 'error' END AS status
      FROM results)
    SELECT command, status, count(*) AS n FROM named GROUP BY 1, 2
    UNION ALL
    SELECT DISTINCT command, s, 0 FROM named, (VALUES ('pass'), ('warn'), ('error')) AS listed(s)
    WHERE NOT EXISTS (SELECT 1 FROM named AS o WHERE o.command = named.command AND o.status = s)
"""


def named_statuses(r):
    """Results under the names of check statuses, a fourth one among them."""
    status = F.expr(
        "CASE status WHEN 'success' THEN CASE WHEN series_code LIKE '%7' THEN 'runtime error' ELSE 'pass' END "
        "WHEN 'technical_failed' THEN 'warn' WHEN 'quality_failed' THEN 'error' END"
    )
    return r.results.select(F.col("run_id").alias("command"), status.alias("status"))


@query("agg_10_status_counts", STATUS_SQL)
def _(r):
    return aggregates.status_counts(named_statuses(r), "command")


@query(
    "agg_11_first_seen_runs",
    "SELECT ingestion_run_id AS run_id, min(extracted_at) AS started_at FROM obs "
    "WHERE ingestion_run_id NOT IN (SELECT run_id FROM runs) GROUP BY 1",
)
def _(r):
    return aggregates.first_seen_runs(r.obs, r.runs)


@query(
    "agg_12_catalog_match_count",
    "SELECT c.series_code, c.series_name, count(k.series_code) AS match_count "
    "FROM config c LEFT JOIN catalog k USING (series_code) GROUP BY 1, 2",
)
def _(r):
    return aggregates.catalog_matches(r.config.select("series_code", "series_name"), r.catalog)


# -- windows -------------------------------------------------------------------

CHANGE_SQL = """
    lagged AS (
      SELECT series_code, observation_date, value,
        lag(observation_date) OVER w AS previous_date, lag(value) OVER w AS previous_value
      FROM obs WHERE value IS NOT NULL WINDOW w AS (PARTITION BY series_code ORDER BY observation_date))
    SELECT series_code, previous_date, previous_value, observation_date, value,
      CASE WHEN previous_value <> 0 THEN (value - previous_value) / previous_value END AS change,
      round(CASE WHEN previous_value <> 0 THEN (value - previous_value) / previous_value END * 100, 2) AS change_pct
    FROM lagged
"""


@query("win_01_pct_change", CHANGE_SQL)
def _(r):
    return windows.percent_change(r.obs).select(
        "series_code", "previous_date", "previous_value", "observation_date", "value", "change", "change_pct"
    )


# A hole is wide if the period of a date lies further than allowed behind the latest earlier one.
GAPS_SQL = """
    allowances(frequency, allowed) AS (VALUES ('daily', 7), ('monthly', 1), ('quarterly', 1), ('annual', 1)),
    placed AS (
      SELECT series_code, frequency, allowed, observation_date,
        CASE frequency WHEN 'daily' THEN observation_date - DATE '1970-01-01'
          WHEN 'monthly' THEN 12 * year(observation_date) + month(observation_date)
          WHEN 'quarterly' THEN 4 * year(observation_date) + quarter(observation_date)
          ELSE year(observation_date) END AS period
      FROM obs JOIN series USING (series_code) JOIN allowances USING (frequency) WHERE value IS NOT NULL),
    reached AS (
      SELECT *, max(period) OVER earlier AS last_period, max(observation_date) OVER earlier AS previous_date
      FROM placed
      WINDOW earlier AS (PARTITION BY series_code ORDER BY period, observation_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT series_code, frequency, previous_date, observation_date,
      CAST(observation_date - previous_date AS BIGINT) AS gap_days
    FROM reached WHERE period > last_period + allowed
"""


def gaps_of(r):
    rows = with_frequency(r.obs.select("series_code", "observation_date", "value"), r.series)
    return windows.gaps(rows).select("series_code", "frequency", "previous_date", "observation_date", "gap_days")


@query("win_02_gap_detection", GAPS_SQL)
def _(r):
    return gaps_of(r)


# Each version beside the one numbered after it; one query for each kind of issue.
OVERLAP_SQL = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY series_code ORDER BY valid_from) AS n FROM versions),
    beside AS (
      SELECT v.series_code, v.valid_from, v.valid_to, f.valid_from AS next_valid_from
      FROM numbered v LEFT JOIN numbered f ON f.series_code = v.series_code AND f.n = v.n + 1),
    backwards AS (SELECT * FROM beside WHERE valid_to <= valid_from),
    forwards AS (SELECT * FROM beside WHERE valid_to IS NULL OR valid_to > valid_from)
    SELECT *, 'ends before it starts' AS issue FROM backwards
    UNION ALL
    SELECT *, 'superseded version still current' FROM forwards WHERE valid_to IS NULL AND next_valid_from IS NOT NULL
    UNION ALL
    SELECT *, 'overlaps next version' FROM forwards WHERE next_valid_from < valid_to
"""


@query("win_03_version_overlap", OVERLAP_SQL)
def _(r):
    return windows.version_overlaps(r.versions)


# Days with an order; those at every so many days are moved on, so the calendar has holes.
SEQUENTIAL_SQL = """
    ordered AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
    days AS (SELECT DISTINCT d + CASE WHEN (d - DATE '1970-01-01') % {every} = 0 THEN 1 ELSE 0 END AS date_day FROM ordered),
    lagged AS (SELECT date_day, lag(date_day) OVER (ORDER BY date_day) AS previous_day FROM days)
    SELECT date_day, previous_day FROM lagged WHERE date_day <> previous_day + 1
"""


def holed_days(r, every):
    day = F.to_date("o_orderdate")
    moved = F.when(F.unix_date(day) % every == 0, F.date_add(day, 1)).otherwise(day)
    return r.table("orders").select(moved.alias("date_day")).distinct()


@query("win_04_sequential_values", SEQUENTIAL_SQL.format(every=13))
def _(r):
    return windows.not_sequential(holed_days(r, 13))


@query(
    "win_05_duplicate_ordinal",
    "SELECT series_name, count(*) - count(DISTINCT coalesce(CAST(day AS VARCHAR), '')) AS duplicate_count "
    "FROM long_text GROUP BY 1",
)
def _(r):
    parsed = r.long_text.select("series_name", lenient_date("observation_date").alias("observation_date"))
    return windows.duplicate_ordinals(parsed, "series_name")


# -- sorts ---------------------------------------------------------------------

HISTORY_SQL = """
    SELECT run_id, pipeline, status, started_at, completed_at,
      CAST(trunc((epoch_us(completed_at) - epoch_us(started_at)) / 1000000) AS BIGINT) AS duration_seconds
    FROM runs WHERE source = 'tpch' ORDER BY started_at DESC, run_id
"""


def run_history(r):
    return aggregates.history(r.runs, "tpch").select(
        "run_id", "pipeline", "status", "started_at", "completed_at", "duration_seconds"
    )


@query("srt_01_run_history", HISTORY_SQL)
def _(r):
    return run_history(r)


@query(
    "srt_02_cluster_sort",
    "SELECT series_code, observation_date, value, strftime(observation_date, '%Y-%m') AS observation_month FROM obs",
)
def _(r):
    rows = r.obs.select("series_code", "observation_date", "value").withColumn(
        tables.MONTH, tables.month_of("observation_date")
    )
    return tables.clustered(rows, [tables.MONTH], ["series_code"])


@query(
    "srt_03_sorted_codes",
    "SELECT series_code FROM catalog GROUP BY 1 HAVING count(*) > 1 ORDER BY 1",
)
def _(r):
    return sets.sorted_codes(aggregates.duplicate_keys(r.catalog, ["series_code"]))
