"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmart.operators import asof, digests, joins, sets, windows
from seriesmart.operators.freshness import cadence_rules
from seriesmart.operators.validate import series_columns

from .scd2 import history_after_second, HISTORY_SQL
from .sql import query

FACT_KEYS_SQL = """
    SELECT o.series_code, o.observation_date, s.series_key, d.date_key
    FROM obs o LEFT JOIN dim_series s USING (series_code) LEFT JOIN dim_date d ON o.observation_date = d.date_day
"""


@query("jon_01_fact_dim_left", FACT_KEYS_SQL)
def _(r):
    rows = r.obs.select("series_code", "observation_date")
    return joins.fact_with_dims(rows, r.dim_series, r.dim_date)


@query(
    "jon_02_obs_series_inner",
    "SELECT series_code, observation_date, o.value, frequency, first_observation_date "
    "FROM obs o JOIN series USING (series_code)",
)
def _(r):
    rows = r.obs.select("series_code", "observation_date", "value")
    lookup = r.series.select("series_code", "frequency", "first_observation_date")
    return joins.lookup_join(rows, lookup, "series_code", "inner")


# Facts of the ghosts never exist; those of suppliers do.
@query(
    "jon_03_anti_missing_child",
    "SELECT series_code, series_name FROM config WHERE series_code NOT IN (SELECT series_code FROM obs)",
)
def _(r):
    return joins.missing_children(r.config.select("series_code", "series_name"), r.obs, "series_code")


@query(
    "jon_04_not_exists",
    """
    SELECT series_key, observation_date FROM fact f WHERE NOT EXISTS (
      SELECT 1 FROM retracted_obs o JOIN dim_series s USING (series_code)
      WHERE s.series_key = f.series_key AND o.observation_date = f.observation_date AND o.value IS NOT NULL)
    """,
)
def _(r):
    present = joins.lookup_join(
        r.retracted_obs.filter("value IS NOT NULL").select("series_code", "observation_date"),
        r.dim_series.select("series_code", "series_key"),
        "series_code",
        "inner",
    )
    keys = ["series_key", "observation_date"]
    return r.fact.select(*keys).join(present.select(*keys), keys, "left_anti")


def reconcile_sql(expected: str, actual: str) -> str:
    """Both sides as marked rows, grouped by key; a group that is not whole and equal is an issue."""
    return f"""
    sides AS (
      SELECT md5(series_code) AS series_key, observation_date, value, ingestion_run_id, true AS called_for
      FROM {expected} WHERE value IS NOT NULL AND series_code IN (SELECT series_code FROM dim_series)
      UNION ALL SELECT series_key, observation_date, value, ingestion_run_id, false FROM ({actual})),
    grouped_sides AS (
      SELECT series_key, observation_date, count(*) FILTER (called_for) AS e, count(*) FILTER (NOT called_for) AS a,
        any_value(value) FILTER (called_for) AS expected_value, any_value(value) FILTER (NOT called_for) AS actual_value,
        any_value(ingestion_run_id) FILTER (called_for) AS expected_lineage,
        any_value(ingestion_run_id) FILTER (NOT called_for) AS actual_lineage
      FROM sides GROUP BY ALL),
    judged_sides AS (
      SELECT * EXCLUDE (e, a), CASE e - a WHEN 1 THEN 'missing from fact' WHEN -1 THEN 'not in staging'
        ELSE if(expected_value = actual_value, if(expected_lineage IS NOT DISTINCT FROM actual_lineage, NULL,
          'ingestion run differs'), 'value differs') END AS issue
      FROM grouped_sides)
    SELECT * FROM judged_sides WHERE issue IS NOT NULL
    """


# The fact of the first load against the observations of the second.
FIRST_FACT_SQL = """SELECT s.series_key, o.observation_date, o.value, o.ingestion_run_id
      FROM first_load o JOIN dim_series s USING (series_code) WHERE o.value IS NOT NULL"""


def keyed(r, rows):
    return joins.lookup_join(
        rows.filter("value IS NOT NULL"), r.dim_series.select("series_code", "series_key"), "series_code", "inner"
    )


@query("jon_05_full_outer_reconcile", reconcile_sql("second_load", FIRST_FACT_SQL))
def _(r):
    return joins.reconcile(
        keyed(r, r.second_load),
        keyed(r, r.first_load),
        ["series_key", "observation_date"],
        "value",
        "ingestion_run_id",
    )


def second_tree(r):
    return keyed(r, r.second_load), keyed(r, r.first_load), ["series_key", "observation_date"]


@query("jon_05_digest_reconcile", reconcile_sql("second_load", FIRST_FACT_SQL))
def _(r):
    """The same issues, of which only rows in differing months and key ranges are joined."""
    return digests.reconcile(*second_tree(r), "value", "ingestion_run_id", day="observation_date")


@query(
    "jon_05_month_digests",
    f"""
    issues AS (WITH {reconcile_sql("second_load", FIRST_FACT_SQL)}),
    months AS (
      SELECT strftime(observation_date, '%Y-%m') AS month, count(*) FILTER (side = 0) AS n_expected, count(*) FILTER (side = 1) AS n_actual
      FROM (SELECT observation_date, 0 AS side FROM second_load WHERE value IS NOT NULL AND series_code IN (SELECT series_code FROM dim_series)
            UNION ALL SELECT observation_date, 1 FROM ({FIRST_FACT_SQL})) GROUP BY 1)
    SELECT *, month IN (SELECT strftime(observation_date, '%Y-%m') FROM issues) AS differs FROM months
    """,
)
def _(r):
    expected, actual, keys = second_tree(r)
    return digests.month_summary(digests.tree(expected, actual, keys, ["value", "ingestion_run_id"], "observation_date"))


COVERAGE_SQL = """
    SELECT series_code, observation_date, value, first_observation_date
    FROM obs JOIN series USING (series_code) WHERE observation_date < first_observation_date
"""


@query("jon_06_theta_lt", COVERAGE_SQL)
def _(r):
    return joins.lookup_join(
        r.obs.select("series_code", "observation_date", "value"),
        r.series.select("series_code", "first_observation_date"),
        "series_code",
        "inner",
        condition=F.col("observation_date") < F.col("first_observation_date"),
    )


@query("jon_07_calendar_from_bounds", "SELECT date_day FROM dim_date")
def _(r):
    return r.dim_date.select("date_day")


@query(
    "jon_08_relationship_check",
    "SELECT series_code, observation_date FROM obs WHERE series_code NOT IN (SELECT series_code FROM series)",
)
def _(r):
    return joins.orphans(r.obs.select("series_code", "observation_date"), r.series, "series_code")


@query(
    "jon_09_semi_quality_gate",
    """
    SELECT o.series_code, o.observation_date, o.value FROM obs o
    WHERE o.series_code IN (
      SELECT series_code FROM obs GROUP BY 1 HAVING count(*) - count(value) <= 0.06 * count(*))
    """,
)
def _(r):
    ratio = r.obs.groupBy("series_code").agg(
        F.count_if(F.col("value").isNull()).alias("n"), F.count(F.lit(1)).alias("rows")
    )
    passed = ratio.filter("n <= 0.06 * rows").select("series_code")
    return joins.lookup_join(
        r.obs.select("series_code", "observation_date", "value"), passed, "series_code", "left_semi"
    )


@query(
    "jon_10_lineage_join",
    "SELECT series_code, observation_date, ingestion_run_id, status AS run_status, started_at "
    "FROM obs LEFT JOIN runs ON ingestion_run_id = run_id",
)
def _(r):
    rows = r.obs.select("series_code", "observation_date", "ingestion_run_id")
    return joins.with_run(rows, r.runs.select("run_id", F.col("status").alias("run_status"), "started_at"))


@query(
    "jon_11_asof_snapshot",
    HISTORY_SQL
    + """
    SELECT o.series_code, o.observation_date, o.extracted_at, h.category, h.valid_from
    FROM obs o LEFT JOIN history h ON o.series_code = h.series_code
      AND h.valid_from <= o.extracted_at AND (h.valid_to IS NULL OR o.extracted_at < h.valid_to)
    """,
)
def _(r):
    rows = r.obs.select("series_code", "observation_date", "extracted_at")
    history = history_after_second(r).select("series_code", "category", "valid_from", "valid_to")
    return asof.as_of_join(rows, history, "series_code", "extracted_at").drop("valid_to")


# Five keys with thousands of versions each; some versions end before the next one starts.
QUOTES_SQL = """
    days AS (SELECT o_orderpriority AS desk, o_orderdate AS valid_from, max(o_orderkey) AS quote FROM orders GROUP BY 1, 2),
    quotes AS (
      SELECT desk, valid_from, quote, CASE WHEN quote % 10 = 0 THEN valid_from + INTERVAL 1 HOUR
        ELSE lead(valid_from) OVER (PARTITION BY desk ORDER BY valid_from) END AS valid_to FROM days),
    asked AS (
      SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END AS desk,
        CASE WHEN o_orderkey % 70 <> 1 THEN o_orderdate + to_hours(CAST(o_orderkey % 960 - 480 AS INTEGER)) END AS asked_at FROM orders)
"""


def quotes(r):
    days = r.table("orders").groupBy(F.col("o_orderpriority").alias("desk"), F.col("o_orderdate").cast("timestamp").alias("valid_from")).agg(
        F.max("o_orderkey").alias("quote")
    )
    following = windows.shifted(days, ["desk"], "valid_from", {"valid_from": "following"}, bucket=F.trunc("valid_from", "month"), forward=True)
    end = F.when(F.expr("quote % 10 = 0"), F.expr("valid_from + INTERVAL 1 HOUR")).otherwise(F.col("following"))
    return following.withColumn("valid_to", end).drop("following")


def asked(r):
    hours = F.expr("cast(o_orderkey % 960 - 480 AS int)")
    return r.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.expr("CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END").alias("desk"),
        F.when(F.expr("o_orderkey % 70 <> 1"), F.timestamp_add("HOUR", hours, F.col("o_orderdate").cast("timestamp"))).alias("asked_at"),
    )


@query(
    "jon_11_asof_many_versions",
    QUOTES_SQL
    + """
    SELECT order_id, a.desk, asked_at, quote, valid_from
    FROM asked a LEFT JOIN quotes q ON a.desk = q.desk AND valid_from <= asked_at AND (valid_to IS NULL OR asked_at < valid_to)
    """,
)
def _(r):
    return asof.as_of_join(asked(r), quotes(r), "desk", "asked_at").drop("valid_to")


@query(
    "jon_11_asof_inner",
    QUOTES_SQL
    + """
    SELECT a.desk, year(valid_from) AS "year", count(*) AS orders, sum(quote) AS quotes
    FROM asked a JOIN quotes q ON a.desk = q.desk AND valid_from <= asked_at AND (valid_to IS NULL OR asked_at < valid_to)
    GROUP BY 1, 2
    """,
)
def _(r):
    held = asof.as_of_join(asked(r), quotes(r), "desk", "asked_at", how="inner", bucket="day")
    return held.groupBy("desk", F.year("valid_from").alias("year")).agg(F.count("*").alias("orders"), F.sum("quote").alias("quotes"))


# -- set operations ------------------------------------------------------------


@query(
    "set_01_union_all",
    "SELECT series_code, frequency_code FROM catalog",
)
def _(r):
    slim = r.catalog.select("series_code", "frequency_code")
    listed = ("DAILY", "MONTHLY", "QUARTERLY", "ANNUAL")
    parts = [slim.filter(F.col("frequency_code") == f) for f in listed]
    others = slim.filter(~F.coalesce(F.col("frequency_code").isin(*listed), F.lit(False)))
    return sets.union_all([*parts, others])


@query(
    "set_02_except_codes",
    "SELECT DISTINCT series_code FROM curated EXCEPT SELECT series_code FROM config WHERE coalesce(enabled, true)",
)
def _(r):
    return sets.except_codes(r.curated, r.config.filter(F.coalesce("enabled", F.lit(True))))


UNMONITORED_SQL = (
    "SELECT series_code, series_name, frequency FROM series WHERE frequency NOT IN ('daily', 'monthly')"
)


@query("set_03_unmonitored", UNMONITORED_SQL)
def _(r):
    return sets.unmonitored(r.series.select("series_code", "series_name", "frequency"), cadence_rules(r.series))


@query(
    "set_04_column_set_diff",
    """
    SELECT series_name, bool_or(side = 'present') AS expected_column_present, bool_or(side = 'expected') AS no_unexpected_columns
    FROM (SELECT DISTINCT series_name, 'present' AS side FROM raw_observations
          UNION ALL SELECT series_name, 'expected' FROM raw_series
          UNION ALL SELECT series_name, 'expected' FROM config WHERE series_code LIKE 'G%')
    GROUP BY 1
    """,
)
def _(r):
    expected = r.raw_series.select("series_name").unionByName(
        r.config.filter("series_code LIKE 'G%'").select("series_name")
    )
    return series_columns(r.raw_observations, expected)


@query(
    "set_05_symmetric_diff",
    """
    SELECT coalesce(a.series_code, b.series_code) AS series_code,
      CASE WHEN b.series_code IS NULL THEN 'catalog only' ELSE 'curated only' END AS side
    FROM (SELECT DISTINCT series_code FROM catalog) a FULL JOIN (SELECT DISTINCT series_code FROM curated) b
      ON a.series_code = b.series_code
    WHERE a.series_code IS NULL OR b.series_code IS NULL
    """,
)
def _(r):
    catalog_only = sets.except_codes(r.catalog, r.curated).withColumn("side", F.lit("catalog only"))
    curated_only = sets.except_codes(r.curated, r.catalog).withColumn("side", F.lit("curated only"))
    return sets.union_all([catalog_only, curated_only])


@query(
    "set_05_digest_symmetric_diff",
    """
    SELECT coalesce(a.series_code, b.series_code) AS series_code, CASE WHEN b.series_code IS NULL THEN 'left' ELSE 'right' END AS side
    FROM (SELECT DISTINCT series_code FROM catalog) a FULL JOIN (SELECT DISTINCT series_code FROM curated) b
      ON a.series_code = b.series_code
    WHERE a.series_code IS NULL OR b.series_code IS NULL
    """,
)
def _(r):
    return digests.symmetric_difference(r.catalog, r.curated, "series_code")
