"""Upserts, deletes, schema changes and dimensional models."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from seriesmart.functions.text import timestamp_run_id
from seriesmart.operators import aggregates, merge
from seriesmart.plans import ingest, marts
from seriesmart.schemas import OBSERVATIONS, OBSERVATIONS_KEY, RUNS, RUNS_KEY

from .sql import query

NON_AUDIT = ("series_name", "value", "frequency", "unit", "source")
ON = "t.series_code = s.series_code AND t.observation_date = s.observation_date"
CHANGED = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in NON_AUDIT)

MERGE_SQL = f"""
    planned AS (
      SELECT t, s, CASE WHEN t.series_code IS NULL THEN 'insert' WHEN s.series_code IS NULL THEN 'keep'
        WHEN {CHANGED} THEN 'update' ELSE 'keep' END AS act
      FROM first_load t FULL JOIN second_load s ON {ON}),
    merged AS (SELECT unnest(CASE WHEN act IN ('insert', 'update') THEN s ELSE t END) FROM planned)
"""


def observation_plan(r):
    return merge.merge_plan(r.first_load, r.second_load, OBSERVATIONS_KEY)


@query("mrg_01_merge_changed", MERGE_SQL + "SELECT * FROM merged")
def _(r):
    return merge.merge_apply(observation_plan(r))


SERIES_COLUMNS = ("series_name", "description", "category", "frequency", "unit", "source_title_es",
                  "source_title_en", "first_observation_date", "last_observation_date",
                  "source_updated_date", "source")
SERIES_CHANGED = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in SERIES_COLUMNS)


@query(
    "mrg_02_merge_delete_unmatched",
    f"""
    retained AS (SELECT 'S' || s_suppkey AS series_code FROM supplier WHERE s_acctbal > 5000),
    planned AS (
      SELECT t, s, CASE WHEN t.series_code IS NULL THEN 'insert'
        WHEN s.series_code IS NULL THEN CASE WHEN t.series_code IN (SELECT series_code FROM retained) THEN 'keep' ELSE 'delete' END
        WHEN {SERIES_CHANGED} THEN 'update' ELSE 'keep' END AS act
      FROM raw_series t FULL JOIN series_reload s ON t.series_code = s.series_code)
    SELECT unnest(CASE WHEN act IN ('insert', 'update') THEN s ELSE t END) FROM planned WHERE act <> 'delete'
    """,
)
def _(r):
    retained = (
        r.table("supplier").filter("s_acctbal > 5000").select(F.expr("concat('S', s_suppkey)").alias("series_code"))
    )
    return merge.merge_apply(
        merge.merge_plan(r.raw_series, r.series_reload, ["series_code"], retained=retained)
    )


@query(
    "mrg_03_change_counts",
    MERGE_SQL
    + """
    SELECT count(*) FILTER (act = 'insert') AS inserted, count(*) FILTER (act = 'update') AS updated,
      CAST(0 AS BIGINT) AS deleted, count(*) FILTER (act IN ('insert', 'update')) AS rows_changed
    FROM planned
    """,
)
def _(r):
    return merge.merge_counts(observation_plan(r))


@query(
    "mrg_03_rerun_changes_nothing",
    "SELECT CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted, "
    "CAST(0 AS BIGINT) AS rows_changed",
)
def _(r):
    merged = merge.merge_apply(observation_plan(r))
    return merge.merge_counts(merge.merge_plan(merged, r.second_load, OBSERVATIONS_KEY))


@query(
    "mrg_04_prune_unconfigured",
    "SELECT * FROM obs WHERE series_code IN (SELECT series_code FROM config WHERE coalesce(enabled, true))",
)
def _(r):
    return merge.prune(r.obs, r.config.filter(F.coalesce("enabled", F.lit(True))))


# Completion of every run that reports a code; runs of 2001 were never started.
@query(
    "mrg_05_keyed_run_upsert",
    """
    started AS (SELECT run_id, source, pipeline, target_table, started_at, 'running' AS status FROM runs
      WHERE started_at < TIMESTAMP '2001-01-01 00:00:00')
    SELECT u.run_id, u.source, u.pipeline, u.target_table, u.started_at,
      CASE WHEN u.exit_code IS NULL AND s.run_id IS NOT NULL THEN s.status ELSE u.status END AS status,
      CASE WHEN u.exit_code IS NOT NULL THEN u.exit_code END AS exit_code
    FROM runs u LEFT JOIN started s USING (run_id) WHERE s.run_id IS NOT NULL OR u.exit_code IS NOT NULL
    """,
)
def _(r):
    base = r.runs.select("run_id", "source", "pipeline", "target_table", "started_at")
    started = (
        base.filter("started_at < TIMESTAMP'2001-01-01 00:00:00'")
        .withColumn("status", F.lit("running"))
        .withColumn("exit_code", F.lit(None).cast("long"))
    )
    done = r.runs.filter("exit_code IS NOT NULL").select(*base.columns, "status", "exit_code")
    return merge.upsert_columns(started, done, RUNS_KEY, ["status", "exit_code"])


FACT_BUILD_SQL = """
    SELECT s.series_key, d.date_key, o.observation_date, o.value, o.extracted_at, o.ingestion_run_id
    FROM retracted_obs o JOIN dim_series s USING (series_code) JOIN dim_date d ON o.observation_date = d.date_day
    WHERE o.value IS NOT NULL
"""


@query("mrg_06_incremental_fact", FACT_BUILD_SQL)
def _(r):
    return marts.incremental_fact(r.old_fact, r.retracted_obs, r.dim_series, r.dim_date)


@query(
    "mrg_07_delete_stale",
    """
    SELECT f.* FROM fact f WHERE EXISTS (
      SELECT 1 FROM retracted_obs o JOIN dim_series s USING (series_code)
      WHERE s.series_key = f.series_key AND o.observation_date = f.observation_date AND o.value IS NOT NULL)
    """,
)
def _(r):
    return merge.delete_stale(r.fact, r.retracted_obs, r.dim_series)


@query(
    "mrg_09_add_missing_columns",
    "SELECT *, NULL::TIMESTAMP AS ingested_at, NULL::VARCHAR AS ingestion_run_id FROM ("
    "SELECT * EXCLUDE (ingested_at, ingestion_run_id) FROM raw_observations)",
)
def _(r):
    evolved, _added = merge.evolve(r.raw_observations.drop("ingested_at", "ingestion_run_id"), OBSERVATIONS)
    return evolved


RUN_ID_SQL = "strftime(extracted_at, '%Y%m%dT%H%M%S') || '000000Z'"


@query(
    "mrg_10_backfill_columns",
    f"""
    SELECT series_code, observation_date, coalesce(value, CAST(0 AS DOUBLE)) AS value, extracted_at,
      CASE WHEN month(observation_date) = 3 THEN {RUN_ID_SQL} ELSE ingestion_run_id END AS ingestion_run_id
    FROM obs
    """,
)
def _(r):
    unnamed = r.obs.withColumn(
        "ingestion_run_id", F.when(F.month("observation_date") != 3, F.col("ingestion_run_id"))
    )
    return merge.backfill(
        unnamed, {"ingestion_run_id": timestamp_run_id("extracted_at"), "value": F.lit(0.0)}
    )


@query(
    "mrg_10_backfill_count",
    "SELECT count(*) AS rows_updated FROM obs WHERE value IS NULL OR month(observation_date) = 3",
)
def _(r):
    unnamed = r.obs.withColumn(
        "ingestion_run_id", F.when(F.month("observation_date") != 3, F.col("ingestion_run_id"))
    )
    return merge.backfill_count(unnamed, ["value", "ingestion_run_id"])


@query(
    "mrg_11_register_missing_runs",
    """
    SELECT run_id, source, pipeline, target_table, status, started_at FROM runs
    UNION ALL
    SELECT ingestion_run_id, 'tpch', 'observations', 'raw.observations', 'unknown', min(extracted_at) FROM obs
    WHERE ingestion_run_id NOT IN (SELECT run_id FROM runs) GROUP BY 1
    """,
)
def _(r):
    known = r.runs.select("run_id", "source", "pipeline", "target_table", "status", "started_at")
    seen = aggregates.first_seen_runs(r.obs, known)
    return merge.register_runs(known, seen, "tpch", "observations", "raw.observations")


# Observations from before the run table: every run is registered, all as unknown.
@query(
    "mrg_12_migrate",
    f"""
    legacy AS (SELECT series_code, observation_date, extracted_at, {RUN_ID_SQL} AS ingestion_run_id FROM obs)
    SELECT ingestion_run_id AS run_id, 'tpch' AS source, 'observations' AS pipeline, 'raw.observations' AS target_table,
      'unknown' AS status, min(extracted_at) AS started_at
    FROM legacy GROUP BY 1
    """,
)
def _(r):
    old = r.raw_observations.drop("ingested_at", "ingestion_run_id")
    no_runs = r.spark.createDataFrame([], RUNS)
    _rows, runs = ingest.migrate(old, no_runs, "tpch", "observations", "raw.observations")
    return runs.select("run_id", "source", "pipeline", "target_table", "status", "started_at")


@query(
    "mrg_12_migrated_rows",
    f"SELECT * REPLACE (extracted_at AS ingested_at, {RUN_ID_SQL} AS ingestion_run_id) FROM raw_observations",
)
def _(r):
    old = r.raw_observations.drop("ingested_at", "ingestion_run_id")
    return ingest.migrate(old, r.spark.createDataFrame([], RUNS), "tpch", "observations", "raw.observations")[0]


@query(
    "mrg_13_backfill_windows",
    """
    months AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2002-01-01', INTERVAL 1 MONTH)) AS DATE)
      AS window_start),
    held AS (SELECT series_code, CAST(date_trunc('month', observation_date) AS DATE) AS window_start, count(*) AS n
      FROM obs GROUP BY 1, 2)
    SELECT c.series_code, m.window_start, CAST(last_day(m.window_start) AS DATE) AS window_end, coalesce(h.n, 0) AS row_count
    FROM config c CROSS JOIN months m LEFT JOIN held h ON h.series_code = c.series_code AND h.window_start = m.window_start
    """,
)
def _(r):
    return ingest.backfill_windows(r.config, r.obs, date(1994, 11, 15), date(2002, 1, 20))


@query(
    "mrg_14_needs_rebuild",
    """
    SELECT parent_run_id, CASE WHEN count(*) = count(rows_changed) THEN CAST(sum(rows_changed) AS BIGINT) END AS rows_changed,
      count(*) <> count(rows_changed) OR sum(rows_changed) > 0 AS needs_rebuild
    FROM runs GROUP BY 1
    """,
)
def _(r):
    return merge.needs_rebuild(r.runs, "parent_run_id")


# -- dimensional models ----------------------------------------------------------


@query("dim_01_dim_series", "SELECT * FROM dim_series")
def _(r):
    return r.dim_series


@query("dim_02_dim_date", "SELECT * FROM dim_date")
def _(r):
    return r.dim_date


@query(
    "dim_03_fact_observation",
    """
    SELECT s.series_key, d.date_key, o.observation_date, o.value, o.extracted_at, o.ingestion_run_id
    FROM obs o LEFT JOIN dim_series s USING (series_code) LEFT JOIN dim_date d ON o.observation_date = d.date_day
    WHERE o.value IS NOT NULL
    """,
)
def _(r):
    return marts.fact_rows(r.obs, r.dim_series, r.dim_date)
