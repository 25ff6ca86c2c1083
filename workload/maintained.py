"""Results kept beside a stored table: a first load, a second one merged in, rows deleted."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from seriesmart.operators import freshness, monthly
from seriesmart.schemas import OBSERVATIONS_KEY
from seriesmart.sources import summaries, tables

from .checks import METRICS
from .sources import fresh_folder
from .sql import query

START, END = date(1996, 2, 10), date(2000, 11, 20)

# What the table holds in the end. Rows of the second load that change no value stay as first loaded.
STORED_SQL = """
    kept_rows AS (
      SELECT * REPLACE (CASE WHEN same THEN first_at ELSE ingested_at END AS ingested_at) FROM (
        SELECT n.*, o.value IS NOT DISTINCT FROM n.value AND o.series_code IS NOT NULL AS same, o.ingested_at AS first_at
        FROM second_load n LEFT JOIN first_load o USING (series_code, observation_date))
      UNION ALL BY NAME SELECT *, false AS same, NULL AS first_at FROM first_load WHERE observation_date < DATE '2000-06-01'),
    stored_rows AS (
      SELECT * FROM kept_rows
      WHERE (CAST(substring(series_code, 2) AS BIGINT) * 31 + date_diff('day', DATE '1970-01-01', observation_date)) % 23 <> 0
        AND NOT (series_code LIKE '%3' AND strftime(observation_date, '%Y-%m') = '1998-05'))
"""


def doomed(r):
    k = F.expr("CAST(substring(series_code, 2) AS BIGINT) * 31 + unix_date(observation_date)")
    month = F.expr("series_code LIKE '%3' AND date_format(observation_date, 'yyyy-MM') = '1998-05'")
    return r.obs.filter((k % 23 == 0) | month).select(*OBSERVATIONS_KEY)


def table_of(r, *kept: summaries.Summary) -> str:
    path = fresh_folder(r)
    for load in (r.first_load, r.second_load):
        summaries.merge(r.spark, path, load, OBSERVATIONS_KEY, kept)
    summaries.delete(r.spark, path, doomed(r), OBSERVATIONS_KEY, kept)
    return path


def profile_of(r) -> summaries.Summary:
    return summaries.Summary("profile", monthly.profile_partials(r.config))


@query(
    "agg_05_maintained_profile",
    STORED_SQL
    + f""",
    measured_rows AS (
      SELECT series_code, count(*) AS n, count(*) - count(value) AS null_count, count(*) - count(DISTINCT observation_date) AS duplicate_date_count,
        count(*) FILTER (NOT observation_date BETWEEN DATE '{START}' AND DATE '{END}') AS out_of_range_count,
        count(*) FILTER (value < min_value) AS below_minimum_count
      FROM stored_rows JOIN (SELECT series_code, min_value FROM config) USING (series_code) GROUP BY 1)
    SELECT series_code, coalesce(n, 0) AS row_count, null_count, CAST(null_count AS DOUBLE) / n AS null_ratio, duplicate_date_count,
      CASE WHEN n > 0 THEN 0 END AS invalid_date_count, out_of_range_count, CASE WHEN n > 0 THEN 0 END AS non_numeric_count, below_minimum_count
    FROM config LEFT JOIN measured_rows USING (series_code)
    """,
)
def _(r):
    kept = profile_of(r)
    path = table_of(r, kept)
    partials = summaries.read(r.spark, path, kept)
    return monthly.profile(partials, r.config, START, END, tables.stored(r.spark, path)).select("series_code", *METRICS)


@query(
    "dq_24_maintained_stale",
    STORED_SQL
    + """,
    slack(frequency, unit, back) AS (VALUES ('daily', 'day', INTERVAL 7 DAY), ('monthly', 'month', INTERVAL 3 MONTH),
      ('quarterly', 'quarter', INTERVAL 6 MONTH), ('annual', 'year', INTERVAL 24 MONTH)),
    limits_ AS (SELECT frequency, CAST(date_trunc(unit, DATE '2001-12-01') - back AS DATE) AS stale_before FROM slack)
    SELECT s.series_code, s.series_name, s.frequency, max(observation_date) AS latest_observation_date, stale_before
    FROM series s JOIN limits_ USING (frequency) JOIN stored_rows o ON s.series_code = o.series_code WHERE value IS NOT NULL
    GROUP BY ALL HAVING latest_observation_date < stale_before
    """,
)
def _(r):
    kept = profile_of(r)
    partials = summaries.read(r.spark, table_of(r, kept), kept)
    return freshness.stale_series(monthly.latest(partials), r.series, F.lit("2001-12-01").cast("date"))


@query(
    "dq_29_maintained_freshness",
    STORED_SQL
    + """,
    rules AS (
      SELECT series_code, CASE frequency WHEN 'daily' THEN 72 WHEN 'monthly' THEN 840 END AS warn_h,
        CASE frequency WHEN 'daily' THEN 120 WHEN 'monthly' THEN 1080 END AS error_h
      FROM config WHERE frequency IN ('daily', 'monthly')),
    loaded AS (SELECT series_code, max(ingested_at) AS max_loaded_at FROM stored_rows GROUP BY 1),
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
    kept = profile_of(r)
    partials = summaries.read(r.spark, table_of(r, kept), kept)
    return freshness.freshness(monthly.latest(partials), freshness.cadence_rules(r.config), F.lit("2001-11-12 00:30:00"))


NEIGHBOURS_SQL = (
    STORED_SQL
    + """,
    neighbours AS (
      SELECT series_code, frequency, observation_date, value, lag(observation_date) OVER w AS previous_date, lag(value) OVER w AS previous_value
      FROM stored_rows WHERE value IS NOT NULL WINDOW w AS (PARTITION BY series_code ORDER BY observation_date))
"""
)


def broken(r, name, found):
    inside, edge = summaries.Summary(f"{name}_inside", monthly.pairs_inside(found)), summaries.Summary("edges", monthly.edges)
    path = table_of(r, inside, edge)
    return monthly.broken_pairs(summaries.read(r.spark, path, inside), summaries.read(r.spark, path, edge), found)


@query(
    "win_02_maintained_gaps",
    NEIGHBOURS_SQL
    + """
    SELECT * FROM neighbours WHERE CASE frequency WHEN 'daily' THEN observation_date - previous_date > 7
      WHEN 'monthly' THEN date_diff('month', previous_date, observation_date) > 1
      WHEN 'quarterly' THEN date_diff('quarter', previous_date, observation_date) > 1
      ELSE date_diff('year', previous_date, observation_date) > 1 END
    """,
)
def _(r):
    return broken(r, "gaps", monthly.gap())


@query(
    "win_01_maintained_jumps",
    NEIGHBOURS_SQL + "SELECT * FROM neighbours WHERE previous_value <> 0 AND abs((value - previous_value) / previous_value) > 0.8",
)
def _(r):
    return broken(r, "jumps", monthly.jump(0.8))
