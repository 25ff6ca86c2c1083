"""The relations of ``relations.py`` as SQL, and the table of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .relations import Relations

_FREQ = "CASE {s} % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'monthly' WHEN 2 THEN 'quarterly' ELSE 'annual' END"


def _k(code: str = "series_code", day: str = "observation_date") -> str:
    return f"(CAST(substring({code}, 2) AS BIGINT) * 31 + date_diff('day', DATE '1970-01-01', {day}))"


BASE = f"""
grouped AS (
  SELECT l_suppkey AS s, CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS v, max(l_linenumber) AS ln
  FROM lineitem GROUP BY 1, 2),
keyed AS (SELECT *, s * 31 + date_diff('day', DATE '1970-01-01', d) AS k FROM grouped),
timed AS (
  SELECT *, CAST(d AS TIMESTAMP)
    + to_hours(CAST(CASE WHEN k % 41 = 0 THEN -240 ELSE ln * 24 END + s % 24 AS INTEGER)) AS ex
  FROM keyed),
raw_observations AS (
  SELECT d AS observation_date, 'S' || s AS series_code, 'series ' || s AS series_name,
    CASE WHEN k % 17 <> 0 THEN v END AS value, {_FREQ.format(s='s')} AS frequency, 'USD' AS unit,
    CAST(ex AS DATE) AS extraction_date, ex AS extracted_at, ex + INTERVAL 1 HOUR AS ingested_at,
    'run-' || strftime(d, '%Y%m') AS ingestion_run_id, 'tpch' AS source
  FROM timed),
obs AS (SELECT series_code, observation_date, value, extracted_at, ingestion_run_id FROM raw_observations),
first_load AS (SELECT * FROM raw_observations WHERE observation_date < DATE '2001-01-01'),
second_load AS (
  SELECT * REPLACE (
    CASE WHEN CAST(substring(series_code, 2) AS BIGINT) % 7 = 0
      THEN value * CAST(1.01 AS DOUBLE) ELSE value END AS value,
    ingested_at + INTERVAL 1 DAY AS ingested_at, 'run-second' AS ingestion_run_id)
  FROM raw_observations WHERE observation_date >= DATE '2000-06-01'),
dirty_obs AS (
  SELECT * REPLACE (
    CASE WHEN {_k()} % 53 = 0 THEN CAST('NaN' AS DOUBLE) WHEN {_k()} % 59 = 0 THEN CAST('Infinity' AS DOUBLE)
      WHEN {_k()} % 61 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS value)
  FROM obs),
retracted_obs AS (SELECT * REPLACE (CASE WHEN {_k()} % 19 <> 0 THEN value END AS value) FROM obs),
small_obs AS (
  SELECT event_type AS series_code, CAST(ts AS DATE) AS observation_date, max(value) AS value
  FROM events GROUP BY 1, 2),
long_text AS (
  SELECT 'series ' || l_suppkey AS series_name,
    CASE WHEN l_orderkey % 211 <> 0 THEN CAST(l_shipdate AS DATE) END AS day,
    l_partkey % 13 = 0 AS is_missing,
    l_partkey % 13 <> 0 AND (l_partkey % 97 = 0 OR l_partkey % 89 = 0) AS is_text,
    CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 97 <> 0 AND l_partkey % 89 <> 0 THEN l_extendedprice END AS number
  FROM lineitem),
raw_series AS (
  SELECT CASE WHEN s_nationkey = 24 THEN 'X' ELSE 'S' END || s_suppkey AS series_code, 'series ' || s_suppkey AS series_name,
    'Balance of ' || s_name AS description, 'nation ' || s_nationkey AS category,
    {_FREQ.format(s='s_suppkey')} AS frequency, 'USD' AS unit,
    upper(s_name) AS source_title_es, s_name AS source_title_en,
    DATE '1995-01-01' + CAST(s_suppkey % 400 AS INTEGER) AS first_observation_date,
    DATE '2001-12-31' AS last_observation_date, DATE '2001-12-31' AS source_updated_date,
    DATE '2002-01-01' AS extraction_date, TIMESTAMP '2002-01-01 00:00:00' AS extracted_at,
    'tpch' AS source, 'run-200111' AS ingestion_run_id
  FROM supplier),
series AS (
  SELECT series_code, series_name, description AS series_description, category, frequency, unit, source,
    source_title_es, source_title_en, first_observation_date, last_observation_date, source_updated_date, extracted_at
  FROM raw_series),
series_reload AS (
  SELECT * REPLACE (
    CASE WHEN category IN ('nation 1', 'nation 11', 'nation 21') THEN category || ' b' ELSE category END AS category,
    'run-second' AS ingestion_run_id)
  FROM raw_series WHERE category <> 'nation 5'),
snapshot_1 AS (
  SELECT series_code, series_name, frequency, unit, category, source FROM raw_series WHERE category <> 'nation 9'),
snapshot_2 AS (
  SELECT series_code, series_name, frequency, unit, category, 'tpch v2' AS source FROM series_reload),
snapshot_3 AS (SELECT series_code, series_name, frequency, unit, category, source FROM raw_series),
versions AS (
  SELECT 'C' || o_custkey AS series_code, t AS valid_from,
    CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN t - INTERVAL 1 DAY WHEN 2 THEN t + INTERVAL 400 DAY
      ELSE t + INTERVAL 1 DAY END AS valid_to
  FROM (SELECT o_custkey, CAST(o_orderdate AS TIMESTAMP) AS t, max(o_orderkey) AS k FROM orders GROUP BY 1, 2)),
config AS (
  SELECT 'series ' || s_suppkey AS series_name, 'S' || s_suppkey AS series_code, DATE '1995-01-01' AS start_date,
    {_FREQ.format(s='s_suppkey')} AS frequency, 'USD' AS unit,
    CASE s_nationkey WHEN 10 THEN false WHEN 11 THEN NULL ELSE true END AS enabled,
    CASE s_suppkey % 3 WHEN 0 THEN CAST(0.05 AS DOUBLE) WHEN 1 THEN CAST(0.25 AS DOUBLE) END AS max_null_ratio,
    s_suppkey % 5 <> 0 AS require_numeric, s_suppkey % 2 = 0 AS allow_duplicate_dates,
    CASE WHEN s_suppkey % 4 = 0 THEN CAST(1000 AS DOUBLE) END AS min_value
  FROM supplier
  UNION ALL
  SELECT 'ghost ' || n_name, 'G' || n_nationkey, DATE '1995-01-01', 'daily', 'USD', true, NULL, true, false, NULL
  FROM nation),
faulty_config AS (
  SELECT 'series ' || s_suppkey AS series_name,
    CASE s_nationkey WHEN 2 THEN NULL WHEN 4 THEN 'S-four' ELSE 'S' || s_suppkey END AS series_code,
    CASE WHEN s_nationkey <> 7 THEN DATE '1995-01-01' END AS start_date
  FROM supplier),
catalog_once AS (
  SELECT CASE WHEN s_nationkey = 3 THEN 'X' ELSE 'S' END || s_suppkey AS series_code,
    CASE WHEN s_nationkey = 12 THEN 'WEEKLY' ELSE upper({_FREQ.format(s='s_suppkey')}) END AS frequency_code,
    upper(s_name) AS spanish_title, s_name AS english_title,
    CASE WHEN s_nationkey = 14 THEN 'unknown' ELSE '1995-01-01' END AS first_observation,
    '2001-12-31 08:00:00' AS last_observation, '2001-12-31' AS updated_at, s_nationkey AS nation
  FROM supplier),
catalog AS (SELECT * FROM catalog_once UNION ALL SELECT * FROM catalog_once WHERE nation = 8),
curated AS (
  SELECT CASE WHEN s_nationkey = 6 THEN 'Y' ELSE 'S' END || s_suppkey AS series_code, 'series ' || s_suppkey AS series_name,
    'Balance of ' || s_name AS description,
    CASE WHEN s_nationkey = 13 THEN '' ELSE 'nation ' || s_nationkey END AS category,
    CASE WHEN s_nationkey <> 17 THEN 'USD' END AS unit
  FROM supplier),
bounds AS (
  SELECT 'S' || s_suppkey AS series_code,
    CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE CAST(5000 + s_suppkey AS DOUBLE) END AS lo,
    CASE s_suppkey % 4 WHEN 2 THEN NULL ELSE CAST(60000 + s_suppkey AS DOUBLE) END AS hi,
    s_suppkey % 2 = 0 AS lo_inclusive, s_suppkey % 3 = 0 AS hi_inclusive
  FROM supplier),
run_stats AS (
  SELECT *, year(d) * 12 + month(d) AS idx, CAST(date_trunc('month', d) AS TIMESTAMP) AS t,
    ['running', 'success', 'failed', 'crashed', 'unknown'][(year(d) * 12 + month(d)) % 5 + 1] AS status
  FROM (SELECT ingestion_run_id, min(observation_date) AS d, count(*) AS n, count(value) AS nv
        FROM raw_observations GROUP BY 1)),
runs AS (
  SELECT CASE WHEN idx = 1998 * 12 + 8 THEN 'misnamed' ELSE ingestion_run_id END AS run_id, 'tpch' AS source,
    t + INTERVAL 2 HOUR AS started_at,
    CASE WHEN status IN ('running', 'unknown') THEN CASE WHEN idx % 7 = 0 THEN t END
      WHEN idx % 33 = 0 THEN NULL ELSE t + to_hours(CAST(1 + idx % 7 AS INTEGER)) END AS completed_at,
    status, n AS extracted_rows, nv AS valid_rows,
    n - nv + CASE WHEN idx % 9 = 0 THEN 1 ELSE 0 END AS rejected_rows,
    nv + CASE WHEN idx % 16 = 0 THEN 1 ELSE 0 END AS loaded_rows,
    CASE WHEN idx % 27 = 0 THEN repeat('x', 1200)
      WHEN status IN ('failed', 'crashed') AND idx % 4 <> 0 THEN 'boom ' || idx
      WHEN status = 'success' AND idx % 6 = 0 THEN 'odd' END AS error_message,
    'observations' AS pipeline, 'raw.observations' AS target_table,
    CAST(CASE status WHEN 'success' THEN 0 WHEN 'failed' THEN 75 WHEN 'crashed' THEN 1 END AS BIGINT) AS exit_code,
    CAST(CASE WHEN idx % 6 <> 0 THEN idx % 4 END AS BIGINT) AS rows_changed,
    'parent-' || year(d) || '-' || quarter(d) AS parent_run_id
  FROM run_stats),
result_stats AS (
  SELECT *, CASE WHEN idx % 3 = 0 THEN 9 ELSE (s * 7 + idx) % 10 END AS h
  FROM (SELECT ingestion_run_id, CAST(substring(series_code, 2) AS BIGINT) AS s, count(*) AS n,
          count(value) AS nv, year(min(observation_date)) * 12 + month(min(observation_date)) AS idx
        FROM raw_observations GROUP BY 1, 2)),
results AS (
  SELECT ingestion_run_id AS run_id, s AS position, 'series ' || s AS series_name, 'S' || s AS series_code,
    CASE WHEN h = 0 THEN 'quality_failed' WHEN h IN (1, 2) THEN 'technical_failed' ELSE 'success' END AS status,
    n AS row_count, CASE WHEN h <> 0 THEN n ELSE 0 END AS valid_rows,
    CASE WHEN h = 0 THEN n ELSE 0 END AS rejected_rows, CASE WHEN h > 2 THEN n END AS loaded_rows,
    CASE WHEN s % 5 <> 0 THEN nv END AS rows_changed,
    CASE WHEN h IN (1, 2) AND s % 2 = 0 THEN 'Read timed out' END AS error,
    CASE WHEN h = 0 AND s % 3 = 0 THEN 'min_value, max_null_ratio' WHEN h = 0 THEN 'min_value' END AS failed,
    CASE WHEN idx % 3 = 1 THEN true WHEN s % 4 = 1 THEN NULL ELSE s % 4 <> 0 END AS retryable,
    s % 3 AS retries
  FROM result_stats),
dim_series AS (
  SELECT md5(series_code) AS series_key, series_code, series_name, series_description, category, frequency,
    unit, source, first_observation_date, last_observation_date
  FROM series),
dim_date AS (
  SELECT CAST(strftime(x, '%Y%m%d') AS BIGINT) AS date_key, x AS date_day,
    CAST(year(x) AS BIGINT) AS "year", CAST(quarter(x) AS BIGINT) AS "quarter",
    CAST(month(x) AS BIGINT) AS "month", CAST(day(x) AS BIGINT) AS "day",
    CAST(dayofweek(x) + 1 AS BIGINT) AS day_of_week, monthname(x) AS month_name, dayname(x) AS day_name,
    dayofweek(x) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS x
        FROM (SELECT CAST(min(observation_date) AS TIMESTAMP) AS lo, CAST(max(observation_date) AS TIMESTAMP) AS hi
              FROM obs))),
fact AS (
  SELECT s.series_key, d.date_key, o.observation_date, o.value, o.extracted_at, o.ingestion_run_id
  FROM obs o JOIN dim_series s USING (series_code) LEFT JOIN dim_date d ON o.observation_date = d.date_day
  WHERE o.value IS NOT NULL)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of Relations as a query; ``sql`` is its check.

    ``sql`` may start with further CTEs ("x AS (...), ... SELECT ...").
    """

    def register(build: Callable[[Relations], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain_types(build(Relations(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            joint = "" if text.upper().startswith("SELECT") else ","
            ORACLES[name] = f"WITH {BASE.strip()}{joint}\n{text}"
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps and counters as long, as SQL gives them."""
    wanted = {T.TimestampType(): "timestamp_ntz", T.IntegerType(): "long"}
    return df.select(
        *[F.col(f"`{f.name}`").cast(wanted.get(f.dataType, f.dataType)).alias(f.name) for f in df.schema.fields]
    )
