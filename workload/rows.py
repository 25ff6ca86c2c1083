"""Projections, filters and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from seriesmart.functions import dates, text
from seriesmart.operators import canonical, filters
from seriesmart.operators.quality import with_frequency

from .sql import query


# -- projections ---------------------------------------------------------------


@query(
    "prj_01_canonical_observations",
    """
    SELECT o.observation_date, c.series_code, o.series_name, o.value, c.frequency, c.unit, o.extraction_date,
      o.extracted_at, o.ingested_at, o.ingestion_run_id, 'tpch' AS source
    FROM raw_observations o JOIN config c USING (series_name)
    """,
)
def _(r):
    return canonical.canonical_observations(
        r.raw_observations,
        r.config,
        F.col("extracted_at"),
        F.col("ingested_at"),
        F.col("ingestion_run_id"),
        "tpch",
    )


@query(
    "prj_02_canonical_series",
    """
    SELECT c.series_code, m.series_name, m.description, m.category, lower(c.frequency_code) AS frequency, m.unit,
      c.spanish_title AS source_title_es, c.english_title AS source_title_en,
      CAST(TRY_CAST(c.first_observation AS TIMESTAMP) AS DATE) AS first_observation_date,
      CAST(CAST(c.last_observation AS TIMESTAMP) AS DATE) AS last_observation_date,
      CAST(c.updated_at AS DATE) AS source_updated_date,
      DATE '2002-01-01' AS extraction_date, TIMESTAMP '2002-01-01 06:00:00' AS extracted_at,
      'tpch' AS source, 'run-x' AS ingestion_run_id
    FROM catalog_once c JOIN curated m USING (series_code)
    """,
)
def _(r):
    at = F.lit("2002-01-01 06:00:00").cast("timestamp")
    known = filters.configured_only(r.catalog.distinct(), r.curated)
    return canonical.canonical_series(known, r.curated, at, F.lit("run-x"), "tpch")


@query(
    "prj_03_unpivot_wide",
    """
    SELECT d.observation_date, t.series_name, s.value
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS observation_date FROM events) d
    CROSS JOIN (SELECT DISTINCT event_type AS series_name FROM events) t
    LEFT JOIN small_obs s ON s.series_code = t.series_name AND s.observation_date = d.observation_date
    """,
)
def _(r):
    wide = r.wide
    return canonical.unpivot_wide(wide, ["observation_date"], [c for c in wide.columns if c != "observation_date"])


# -- filters ------------------------------------------------------------------


@query("flt_01_non_null_observations", "SELECT * FROM obs WHERE value IS NOT NULL")
def _(r):
    return filters.non_null(r.obs)


@query(
    "flt_02_configured_only",
    "SELECT * EXCLUDE (nation) FROM catalog WHERE series_code IN (SELECT series_code FROM config WHERE coalesce(enabled, true))",
)
def _(r):
    config = r.config.filter(F.coalesce("enabled", F.lit(True)))
    return filters.configured_only(r.catalog, config)


@query(
    "flt_03_window_filter",
    "SELECT * FROM obs WHERE observation_date BETWEEN DATE '1997-03-01' AND DATE '1999-02-28'",
)
def _(r):
    end = filters.resolve_end(None, as_of=date(1999, 2, 28))
    return filters.in_window(r.obs, date(1997, 3, 1), end)


RANGE_SQL = """
    SELECT o.series_code, o.observation_date, o.value
    FROM {rows} o JOIN bounds b USING (series_code)
    WHERE o.value IS NOT NULL AND NOT isnan(o.value) AND (
      coalesce(CASE WHEN lo_inclusive THEN o.value < lo ELSE o.value <= lo END, false)
      OR coalesce(CASE WHEN hi_inclusive THEN o.value > hi ELSE o.value >= hi END, false))
"""


@query("flt_04_range_predicate", RANGE_SQL.format(rows="obs"))
def _(r):
    rows = r.obs.select("series_code", "observation_date", "value")
    return filters.out_of_range(rows, r.bounds)


@query(
    "flt_05_case_predicate",
    """
    SELECT o.series_code, frequency, observation_date
    FROM obs o JOIN series s USING (series_code)
    WHERE CASE frequency WHEN 'daily' THEN dayofweek(observation_date) = 1
      WHEN 'monthly' THEN day(observation_date) <> 1 WHEN 'annual' THEN month(observation_date) <> 1 END
    """,
)
def _(r):
    day = F.col("observation_date")
    broken = dates.by_frequency(
        "frequency",
        {
            "daily": F.dayofweek(day) == 2,
            "monthly": F.dayofmonth(day) != 1,
            "annual": F.month(day) != 1,
        },
    )
    rows = with_frequency(r.obs.select("series_code", "observation_date"), r.series)
    return rows.filter(broken).select("series_code", "frequency", "observation_date")


@query(
    "flt_06_null_safe_compare",
    """
    SELECT o.series_code, o.observation_date, o.value AS old_value, n.value AS new_value
    FROM obs o JOIN retracted_obs n USING (series_code, observation_date)
    WHERE o.value IS DISTINCT FROM n.value
    """,
)
def _(r):
    old = r.obs.select("series_code", "observation_date", F.col("value").alias("old_value"))
    new = r.retracted_obs.select("series_code", "observation_date", F.col("value").alias("new_value"))
    return old.join(new, ["series_code", "observation_date"]).filter(filters.differs("old_value", "new_value"))


@query(
    "flt_07_in_list",
    """
    SELECT series_code, observation_date FROM obs
    WHERE dayofweek(observation_date) IN (0, 6)
      AND series_code NOT IN (SELECT series_code FROM config WHERE enabled = false)
    """,
)
def _(r):
    weekend = r.obs.filter(dates.is_weekend("observation_date")).select("series_code", "observation_date")
    return filters.not_in_list(weekend, "series_code", r.config.filter("enabled = false"))


# -- scalar functions ----------------------------------------------------------

KEYS = "series_code, observation_date"


def _days(r):
    return r.obs.select("series_code", "observation_date")


@query("scl_01_date_key", f"SELECT {KEYS}, CAST(strftime(observation_date, '%Y%m%d') AS BIGINT) AS date_key FROM obs")
def _(r):
    return _days(r).withColumn("date_key", dates.date_key("observation_date"))


@query(
    "scl_02_date_parts",
    f'SELECT {KEYS}, CAST(year(observation_date) AS BIGINT) AS "year", CAST(quarter(observation_date) AS BIGINT) AS '
    '"quarter", CAST(month(observation_date) AS BIGINT) AS "month", CAST(day(observation_date) AS BIGINT) AS "day" FROM obs',
)
def _(r):
    d = F.col("observation_date")
    return _days(r).select(
        "*",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
    )


@query("scl_03_day_of_week", f"SELECT {KEYS}, CAST(dayofweek(observation_date) + 1 AS BIGINT) AS day_of_week FROM obs")
def _(r):
    return _days(r).withColumn("day_of_week", F.dayofweek("observation_date"))


@query(
    "scl_04_names",
    f"SELECT {KEYS}, monthname(observation_date) AS month_name, dayname(observation_date) AS day_name FROM obs",
)
def _(r):
    return _days(r).select(
        "*",
        dates.month_name("observation_date").alias("month_name"),
        dates.day_name("observation_date").alias("day_name"),
    )


@query("scl_05_weekend", f"SELECT {KEYS}, dayofweek(observation_date) IN (0, 6) AS is_weekend FROM obs")
def _(r):
    return _days(r).withColumn("is_weekend", dates.is_weekend("observation_date"))


@query(
    "scl_06_date_array",
    """
    SELECT series_code, CAST(unnest(generate_series(CAST(min(observation_date) AS TIMESTAMP),
      CAST(max(observation_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day
    FROM obs GROUP BY series_code
    """,
)
def _(r):
    spans = r.obs.groupBy("series_code").agg(
        F.min("observation_date").alias("lo"), F.max("observation_date").alias("hi")
    )
    return spans.select("series_code", F.explode(F.sequence("lo", "hi")).alias("date_day"))


@query(
    "scl_07_date_diff",
    f"""
    SELECT {KEYS}, date_diff('day', observation_date, CAST(extracted_at AS DATE)) AS days,
      date_diff('month', observation_date, CAST(extracted_at AS DATE)) AS months,
      date_diff('quarter', observation_date, CAST(extracted_at AS DATE)) AS quarters,
      date_diff('year', observation_date, CAST(extracted_at AS DATE)) AS years
    FROM obs
    """,
)
def _(r):
    to = F.to_date("extracted_at")
    return r.obs.select(
        "series_code",
        "observation_date",
        *[
            dates.periods_between(to, "observation_date", unit).alias(unit + "s")
            for unit in ("day", "month", "quarter", "year")
        ],
    )


@query(
    "scl_08_date_trunc_add",
    f"""
    SELECT {KEYS}, CAST(date_trunc('month', observation_date) AS DATE) AS month_start,
      CAST(date_trunc('quarter', observation_date) AS DATE) AS quarter_start,
      CAST(date_trunc('year', observation_date) AS DATE) AS year_start,
      observation_date + 4 AS plus_days, observation_date - 7 AS minus_days,
      CAST(date_trunc('month', observation_date) - INTERVAL 3 MONTH AS DATE) AS minus_months,
      CAST(date_trunc('year', observation_date) - INTERVAL 2 YEAR AS DATE) AS minus_years
    FROM obs
    """,
)
def _(r):
    d = F.col("observation_date")
    return _days(r).select(
        "*",
        dates.period_start(d, "month").alias("month_start"),
        dates.period_start(d, "quarter").alias("quarter_start"),
        dates.period_start(d, "year").alias("year_start"),
        F.date_add(d, 4).alias("plus_days"),
        F.date_sub(d, 7).alias("minus_days"),
        F.add_months(dates.period_start(d, "month"), -3).alias("minus_months"),
        F.add_months(dates.period_start(d, "year"), -24).alias("minus_years"),
    )


@query(
    "scl_09_zone_date",
    f"""
    SELECT {KEYS}, extracted_at,
      CAST((extracted_at AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) AS extracted_date
    FROM obs
    """,
)
def _(r):
    return r.obs.select(
        "series_code",
        "observation_date",
        "extracted_at",
        dates.zone_date("extracted_at", "America/Santiago").alias("extracted_date"),
    )


@query(
    "scl_10_timestamp_arithmetic",
    """
    SELECT event_id, ts - INTERVAL 2 HOUR AS two_hours_before,
      CAST(floor((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts)) / 1000000) AS BIGINT) AS seconds_left
    FROM events
    """,
)
def _(r):
    at = F.col("ts").cast("timestamp")
    end = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return r.table("events").select(
        "event_id",
        (at - F.expr("INTERVAL 2 HOURS")).alias("two_hours_before"),
        dates.seconds_between(end, at).alias("seconds_left"),
    )


@query(
    "scl_11_safe_divide",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, l_discount, "
    "CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount END AS ratio FROM lineitem",
)
def _(r):
    return r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_discount",
        text.safe_divide("l_extendedprice", "l_discount").alias("ratio"),
    )


@query(
    "scl_12_abs_round",
    "SELECT c_custkey, abs(c_acctbal) AS magnitude, "
    "CAST(round(CAST(c_acctbal AS DECIMAL(18, 2)), 0) AS DOUBLE) AS whole FROM customer",
)
def _(r):
    return r.table("customer").select(
        "c_custkey", F.abs("c_acctbal").alias("magnitude"), F.round("c_acctbal").alias("whole")
    )


@query(
    "scl_13_not_finite",
    f"SELECT {KEYS}, isnan(value) OR isinf(value) AS is_not_finite FROM dirty_obs WHERE value IS NOT NULL",
)
def _(r):
    return r.dirty_obs.filter("value IS NOT NULL").select(
        "series_code", "observation_date", text.not_finite("value").alias("is_not_finite")
    )


@query(
    "scl_14_surrogate_key",
    "SELECT series_code, observation_date, value, md5(series_code || '-' || CAST(observation_date AS VARCHAR) || '-' || "
    "CASE WHEN value IS NULL THEN '_dbt_utils_surrogate_key_null_' ELSE 'v' END) AS surrogate_key FROM obs",
)
def _(r):
    marker = F.when(F.col("value").isNotNull(), "v")
    return r.obs.select(
        "series_code",
        "observation_date",
        "value",
        text.surrogate_key("series_code", "observation_date", marker).alias("surrogate_key"),
    )


@query(
    "scl_15_timestamp_run_id",
    "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') || 'Z' "
    "AS run_id FROM events",
)
def _(r):
    return r.table("events").select("event_id", text.timestamp_run_id(F.col("ts").cast("timestamp")).alias("run_id"))


@query(
    "scl_16_run_id",
    "SELECT strftime(ts, '%Y%m%dT%H%M%S') AS second, count(*) AS n, count(*) AS n_different, true AS well_formed "
    "FROM events GROUP BY 1",
)
def _(r):
    """The random part cannot be checked by value: its form and that ids differ can."""
    ids = r.table("events").select(text.run_id(F.col("ts").cast("timestamp")).alias("run_id"))
    return ids.groupBy(F.substring("run_id", 1, 15).alias("second")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("run_id").alias("n_different"),
        F.bool_and(F.col("run_id").rlike("^[0-9]{8}T[0-9]{12}Z-[0-9a-f]{8}$")).alias("well_formed"),
    )


@query(
    "scl_17_case_coalesce_lower",
    """
    SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal > 5000 THEN 'rich' END,
      lower(c_mktsegment)) AS class, CAST(c_nationkey AS VARCHAR) AS nation_text FROM customer
    """,
)
def _(r):
    named = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") > 5000, "rich")
    return r.table("customer").select(
        "c_custkey",
        F.coalesce(named, F.lower("c_mktsegment")).alias("class"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
    )


@query(
    "scl_18_lenient_parsing",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
      CASE WHEN l_orderkey % 211 <> 0 THEN CAST(l_shipdate AS DATE) END AS parsed_date,
      CASE l_partkey % 4 WHEN 0 THEN l_quantity WHEN 3 THEN 100.0 END AS parsed_number
    FROM lineitem
    """,
)
def _(r):
    date_text = F.expr(
        "CASE WHEN l_orderkey % 211 = 0 THEN '31 of June' ELSE date_format(l_shipdate, 'yyyy-MM-dd') END"
    )
    number_text = F.expr(
        "CASE l_partkey % 4 WHEN 0 THEN cast(l_quantity AS STRING) WHEN 1 THEN '1d' WHEN 2 THEN 'NaN' ELSE ' 1e2 ' END"
    )
    return r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.lenient_date(date_text).alias("parsed_date"),
        text.lenient_number(number_text).alias("parsed_number"),
    )


@query(
    "scl_19_redact_tokens",
    r"""
    SELECT doc_id, md5(regexp_replace(text || ' https://x.test/?TOKEN=ab-' || doc_id || '&y=token=' || n_chars || '''',
      '(?i)(token=)[^&\s''"]+', '\1***', 'g')) AS redacted_md5
    FROM documents
    """,
)
def _(r):
    dirty = F.concat(
        "text", F.lit(" https://x.test/?TOKEN=ab-"), "doc_id", F.lit("&y=token="), "n_chars", F.lit("'")
    )
    return r.table("documents").select("doc_id", F.md5(text.redact_tokens(dirty)).alias("redacted_md5"))


@query(
    "scl_20_short_message",
    f"""
    SELECT doc_id, md5(CASE WHEN length(text) > 1000
      THEN substring(text, 1, 1000 - length('{text.MESSAGE_SUFFIX}')) || '{text.MESSAGE_SUFFIX}' ELSE text END) AS message_md5
    FROM documents
    """,
)
def _(r):
    return r.table("documents").select("doc_id", F.md5(text.short_message("text")).alias("message_md5"))


@query(
    "scl_21_label_value",
    "SELECT page_id, substring(regexp_replace(lower(url), '[^a-z0-9_-]', '_', 'g'), 1, 63) AS label FROM pages",
)
def _(r):
    return r.table("pages").select("page_id", text.label_value("url").alias("label"))


@query(
    "scl_22_array_exists",
    "SELECT o_orderkey AS job_id, lower(o_orderpriority) LIKE '%urgent%' AS is_urgent FROM orders",
)
def _(r):
    return r.jobs.select("job_id", text.has_label("labels", "pipeline", "%urgent%").alias("is_urgent"))


@query(
    "scl_23_json_encode",
    """
    SELECT run_id, position, '{"series_name":"' || series_name || '","status":"' || status || '","row_count":'
      || row_count || '}' AS payload
    FROM results
    """,
)
def _(r):
    return r.results.select(
        "run_id", "position", F.to_json(F.struct("series_name", "status", "row_count")).alias("payload")
    )


@query(
    "scl_24_hours_since",
    """
    SELECT series_code, CAST(round(CAST(date_diff('second', max(ingested_at), TIMESTAMP '2001-12-01 00:30:00') AS
      DECIMAL(18, 6)) / 3600, 1) AS DOUBLE) AS hours_since_loaded
    FROM raw_observations GROUP BY 1
    """,
)
def _(r):
    loaded = r.raw_observations.groupBy("series_code").agg(F.max("ingested_at").alias("m"))
    return loaded.select(
        "series_code", dates.hours_since(F.lit("2001-12-01 00:30:00"), "m").alias("hours_since_loaded")
    )
