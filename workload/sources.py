"""Scans, sinks and what they leave behind.

Queries that write do so under the session's shared checkpoint folder and
return what reading the files back gives.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F, types as T

from seriesmart.operators import audit, merge, validate
from seriesmart.plans import marts
from seriesmart.schemas import OBSERVATIONS, OBSERVATIONS_KEY
from seriesmart.session import ensure_checkpoint_dir, folder_names
from seriesmart.sources import config, landed, tables

from .aggregates import ERROR_SQL, OUTCOME_SQL, RUN_ROLLUP_SQL
from .merge import FACT_BUILD_SQL, MERGE_SQL
from .sql import query


def fresh_folder(r) -> str:
    return f"{ensure_checkpoint_dir(r.spark)}/workload/{uuid.uuid4().hex}"


# -- scans ---------------------------------------------------------------------


@query("src_01_scan_observations", "SELECT * FROM obs")
def _(r):
    return r.obs


@query("src_02_scan_series", "SELECT * FROM series")
def _(r):
    return r.series


@query("src_03_scan_runs", "SELECT * FROM runs")
def _(r):
    path = fresh_folder(r)
    r.runs.drop("summary_uri").write.parquet(path)
    return tables.scan_runs(r.spark, path)


@query(
    "src_04_read_raw_json",
    """
    SELECT series_code AS series_name, observation_date, CAST(value AS VARCHAR) AS value,
      DATE '2024-02-01' AS extraction_date, strftime(date_trunc('week', observation_date), '%Y-%m-%d') AS "window"
    FROM small_obs
    """,
)
def _(r):
    """Table-oriented artifacts, one per series and week, written and replayed."""
    path = fresh_folder(r)
    week = F.date_format(F.date_trunc("week", "observation_date"), "yyyy-MM-dd")
    record = F.concat(
        F.lit('{"index":"'),
        F.date_format("observation_date", "yyyy-MM-dd"),
        F.lit('T00:00:00.000","'),
        F.col("series_code"),
        F.lit('":'),
        F.col("value").cast("string"),
        F.lit("}"),
    )
    # At most seven records per artifact.
    artifacts = (
        r.small_obs.withColumn("window", week)
        .groupBy(F.col("series_code").alias("series_name"), "window")
        .agg(F.array_join(F.array_sort(F.collect_list(record)), ",").alias("records"))
        .select(
            "series_name",
            F.lit("2024-02-01").alias("extraction_date"),
            "window",
            F.concat(F.lit('{"schema":{"fields":[]},"data":['), "records", F.lit("]}")).alias("value"),
        )
    )
    artifacts.write.partitionBy("series_name", "extraction_date", "window").text(path)
    return landed.read_table_json(r.spark, path, pattern="*.txt")


@query("src_05_catalog_union", "SELECT series_code, frequency_code, english_title FROM catalog")
def _(r):
    """One landed catalog per frequency that occurs, united."""
    path = fresh_folder(r)
    slim = r.catalog.select("series_code", "frequency_code", "english_title")
    slim.withColumn("landed", F.col("frequency_code")).write.partitionBy("landed").parquet(path)
    folders = [n for n in folder_names(r.spark, path) if n.startswith("landed=")]
    return landed.catalog_union([r.spark.read.parquet(f"{path}/{n}") for n in folders])


@query("src_06_series_config", "SELECT * FROM config WHERE coalesce(enabled, true)")
def _(r):
    return config.checked(config.enabled(r.config), config.config_problems(r.config))


@query(
    "src_06_config_problems",
    """
    SELECT 'missing series_code' AS problem, coalesce(series_code, series_name, '?') AS subject FROM faulty_config
    WHERE series_code IS NULL
    UNION ALL
    SELECT 'missing start_date', coalesce(series_code, series_name, '?') FROM faulty_config WHERE start_date IS NULL
    UNION ALL
    SELECT 'duplicate series_code', series_code FROM faulty_config WHERE series_code IS NOT NULL
    GROUP BY series_code HAVING count(*) > 1
    """,
)
def _(r):
    return config.config_problems(r.faulty_config)


@query(
    "src_07_curated_metadata",
    """
    SELECT 'duplicate series_code' AS problem, series_code AS subject FROM faulty_config
    WHERE series_code <> '' GROUP BY series_code HAVING count(*) > 1
    UNION ALL
    SELECT 'missing series_code', coalesce(series_name, '?') FROM faulty_config WHERE coalesce(series_code, '') = ''
    """,
)
def _(r):
    return config.curated_problems(r.faulty_config)


# -- sinks ---------------------------------------------------------------------

LANDED_SQL = """
    landed AS (
      SELECT series_name, CAST(date_trunc('year', extraction_date) AS DATE) AS extraction_date,
        CASE WHEN month(observation_date) <= 6 THEN 'full' ELSE '07-01_12-31' END AS "window", observation_date, value
      FROM raw_observations)
"""


def landed_rows(r):
    """Rows of two windows per extraction: the whole history, or the second half-year."""
    window = F.when(F.month("observation_date") > 6, "07-01_12-31")
    return r.raw_observations.select(
        "series_name",
        F.to_date(F.trunc("extraction_date", "year")).alias("extraction_date"),
        window.alias("window"),
        "observation_date",
        "value",
    )


@query("snk_01_write_raw", LANDED_SQL + "SELECT * FROM landed")
def _(r):
    path = fresh_folder(r)
    landed.write_landed(landed_rows(r), path)
    return landed.read_landed(r.spark, path)


@query(
    "snk_02_artifact_manifest",
    LANDED_SQL
    + """,
    quality AS (
      SELECT series_name, count(*) - count(value) AS nulls, count(*) AS n FROM raw_observations GROUP BY 1)
    SELECT l.series_name, extraction_date, "window", min(observation_date) AS first_observation,
      max(observation_date) AS last_observation, count(*) AS row_count, c.series_code, c.frequency, c.unit,
      any_value(CAST(nulls AS DOUBLE) / n <= coalesce(max_null_ratio, 1)
        AND coalesce(q.below, 0) = 0) AS quality_passed
    FROM landed l JOIN config c USING (series_name) JOIN quality USING (series_name)
      LEFT JOIN (SELECT o.series_name, count(*) AS below FROM raw_observations o JOIN config USING (series_name)
                 WHERE o.value < min_value GROUP BY 1) q USING (series_name)
    GROUP BY ALL
    """,
)
def _(r):
    rows = landed_rows(r).withColumn("window", F.coalesce("window", F.lit(landed.FULL_WINDOW)))
    spans = F.lit("1900-01-01").cast("date"), F.lit("2100-01-01").cast("date")
    checked = validate.checks(validate.profile(rows, r.config, *spans))
    return landed.artifact_manifest(rows, checked).drop("failed_checks", "quality")


# A landed file's lines as the writer writes them.
FILE_SQL = """sha256(string_agg('{"observation_date":"' || strftime(observation_date, '%Y-%m-%d') || '","value":'
        || coalesce(value::VARCHAR, 'null') || '}' || chr(10), '' ORDER BY observation_date))"""

MANIFEST_SQL = f"""
    artifacts AS (
      SELECT series_code AS series_name, series_code AS code, min(observation_date) AS first_observation,
        max(observation_date) AS last_observation, count(*) AS row_count, count(*) FILTER (value IS NULL) AS nulls,
        count(*) FILTER (value < 50) AS below, count(*) FILTER (observation_date > DATE '2024-01-20') AS outside,
        {FILE_SQL} AS data_file_sha256
      FROM small_obs GROUP BY 1)
    SELECT series_name, DATE '2024-02-01' AS extraction_date, 'full' AS "window", first_observation, last_observation, row_count, code AS series_code,
      'daily' AS frequency, 'USD' AS unit, outside = 0 AND below = 0 AS quality_passed,
      concat_ws(', ', CASE WHEN outside > 0 THEN 'dates_within_requested_range' END, CASE WHEN below > 0 THEN 'minimum_value' END) AS failed_checks,
      '[' || array_to_string([
        '{{"name":"not_empty","passed":true,"message":"row_count=' || row_count || '"}}',
        '{{"name":"valid_dates","passed":true,"message":"invalid_date_count=0"}}',
        '{{"name":"duplicate_dates","passed":true,"message":"duplicate_count=0"}}',
        '{{"name":"dates_within_requested_range","passed":' || (outside = 0) || ',"message":"out_of_range_count=' || outside || '"}}',
        '{{"name":"null_ratio","passed":true,"message":"null_ratio=' || printf('%.4f', nulls / row_count) || ', max_allowed=1.0000"}}',
        '{{"name":"numeric_values","passed":true,"message":"non_numeric_count=0"}}',
        '{{"name":"minimum_value","passed":' || (below = 0) || ',"message":"below_minimum_count=' || below || ', minimum=50.0"}}'], ',') || ']' AS quality,
      DATE '2024-01-01' AS requested_start_date, DATE '2024-01-20' AS requested_end_date, data_file_sha256
    FROM artifacts
"""


@query("snk_02_full_manifest", MANIFEST_SQL)
def _(r):
    """Every field: requested window, checks as JSON, digest of the landed file."""
    path = fresh_folder(r)
    rows = small_landed(r)
    landed.write_landed(rows, path, per_series=True)
    spans = F.lit("2024-01-01").cast("date"), F.lit("2024-01-20").cast("date")
    known = rows.select("series_name").distinct().select(
        "series_name", F.col("series_name").alias("series_code"), F.lit("daily").alias("frequency"), F.lit("USD").alias("unit"),
        F.lit(50.0).alias("min_value"),
    )
    checked = validate.checks(validate.profile(rows, known, *spans))
    held = rows.withColumn("window", F.coalesce("window", F.lit(landed.FULL_WINDOW)))
    return landed.artifact_manifest(held, checked, spans, landed.artifact_checksums(r.spark, path))


def small_landed(r):
    return r.small_obs.select(
        F.col("series_code").alias("series_name"),
        F.to_date(F.lit("2024-02-01")).alias("extraction_date"),
        F.lit(None).cast("string").alias("window"),
        "observation_date",
        "value",
    )


@query(
    "snk_03_artifact_checksum",
    f"SELECT series_code AS series_name, count(*) AS row_count, {FILE_SQL} AS data_file_sha256 FROM small_obs GROUP BY 1",
)
def _(r):
    path = fresh_folder(r)
    landed.write_landed(small_landed(r), path, per_series=True)
    sums = landed.artifact_checksums(r.spark, path).select("series_name", "data_file_sha256")
    held = landed.read_landed(r.spark, path).groupBy("series_name").agg(F.count(F.lit(1)).alias("row_count"))
    return held.join(sums, "series_name")


@query(
    "snk_04_ensure_table",
    "SELECT *, strftime(observation_date, '%Y-%m') AS observation_month FROM raw_observations",
)
def _(r):
    """Created, loaded clustered by series within months, and read back."""
    path, name = fresh_folder(r), f"observations_{uuid.uuid4().hex}"
    schema = T.StructType([*OBSERVATIONS.fields, T.StructField(tables.MONTH, T.StringType())])
    for _attempt in range(2):  # the second call finds the table
        tables.ensure_table(r.spark, name, schema, [tables.MONTH], location=path)
    rows = r.raw_observations.withColumn(tables.MONTH, tables.month_of("observation_date"))
    tables.load(rows, name, [tables.MONTH], ["series_code"])
    back = r.spark.read.option("basePath", path).parquet(path)
    r.spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return back.withColumn(tables.MONTH, F.col(tables.MONTH).cast("string"))


@query(
    "snk_05_append_load",
    "SELECT * FROM first_load UNION ALL SELECT * FROM second_load",
)
def _(r):
    path = fresh_folder(r)
    tables.append(r.first_load, path)
    tables.append(r.second_load, path)
    return r.spark.read.parquet(path)


@query(
    "snk_06_run_summary_json",
    f"""
    rollup_ AS ({RUN_ROLLUP_SQL}), outcomes AS ({OUTCOME_SQL}), {ERROR_SQL}
    SELECT r.*, m.error_message, o.exit_code, u.started_at, CAST(u.started_at AS DATE) AS run_date,
      (SELECT count(*) FROM results x WHERE x.run_id = r.run_id) AS result_lines
    FROM rollup_ r LEFT JOIN messages m USING (run_id) JOIN outcomes o USING (run_id)
      JOIN (SELECT run_id, started_at FROM runs) u USING (run_id)
    """,
)
def _(r):
    path = fresh_folder(r)
    started = r.runs.select("run_id", "started_at")
    summary = audit.run_summary(r.results).join(started, "run_id")
    landed.write_run_summaries(summary, r.results, path)
    # The error message may be absent from every line of a file: state its type.
    schema = summary.schema.add("run_date", T.DateType())
    lines = r.spark.read.json(f"{path}/results").groupBy("run_id").agg(F.count(F.lit(1)).alias("result_lines"))
    return r.spark.read.schema(schema).json(f"{path}/summaries").join(lines, "run_id")


@query("snk_07_materialize", "SELECT series_key, count(*) AS n FROM fact GROUP BY 1")
def _(r):
    path = fresh_folder(r)
    fact = tables.materialize(r.fact, "table", path)
    view = tables.materialize(fact, "view", f"fact_{uuid.uuid4().hex}")
    return view.groupBy("series_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mrg_01_merge_into_table",
    MERGE_SQL + "SELECT *, strftime(observation_date, '%Y-%m') AS observation_month FROM merged",
)
def _(r):
    """The same merge on a stored table: only touched months are read, only changed ones written."""
    path = fresh_folder(r)
    tables.write_observations(r.first_load, path)
    tables.merge_into_path(r.spark, path, r.second_load, OBSERVATIONS_KEY)
    return tables.stored(r.spark, path)


@query(
    "mrg_04_prune_table",
    "SELECT *, strftime(observation_date, '%Y-%m') AS observation_month FROM raw_observations "
    "WHERE series_code IN (SELECT series_code FROM config WHERE coalesce(enabled, true))",
)
def _(r):
    path = fresh_folder(r)
    tables.write_observations(r.raw_observations, path)
    doomed = merge.unconfigured(tables.stored(r.spark, path), config.enabled(r.config))
    tables.delete_from_path(r.spark, path, doomed, OBSERVATIONS_KEY)
    return tables.stored(r.spark, path)


@query("mrg_06_incremental_fact_table", FACT_BUILD_SQL)
def _(r):
    """An incremental build of a stored fact: equals a full refresh."""
    path = fresh_folder(r)
    tables.write_observations(r.old_fact, path, cluster="series_key")
    marts.build_fact_table(r.spark, path, r.retracted_obs, r.dim_series, r.dim_date)
    return tables.stored(r.spark, path).drop(tables.MONTH)


@query(
    "flt_03_window_scan",
    "SELECT *, strftime(observation_date, '%Y-%m') AS observation_month FROM raw_observations "
    "WHERE observation_date BETWEEN DATE '1997-03-05' AND DATE '1997-07-20'",
)
def _(r):
    path = fresh_folder(r)
    tables.write_observations(r.raw_observations, path)
    return tables.scan_window(r.spark, path, date(1997, 3, 5), date(1997, 7, 20))
