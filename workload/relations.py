"""The warehouse relations, derived from the given tables.

Observations come from lineitem, one per supplier and ship date; series
metadata from supplier; runs from the months observed. Blemishes (missing
metadata, repeated catalog rows, unreadable dates, NULL values) are part of the
definitions, so rules have both passing and failing rows. The same definitions
in SQL are in ``sql.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.plans import marts
from seriesmart.sources import tables

FIRST_LOAD_END = "2001-01-01"
SECOND_LOAD_START = "2000-06-01"
FACT_CUTOFF = "2000-01-01 00:00:00"
SNAPSHOT_1, SNAPSHOT_2, SNAPSHOT_3 = (
    "1996-01-01 00:00:00",
    "1999-01-01 00:00:00",
    "2000-06-01 00:00:00",
)


class Relations:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- observations ----------------------------------------------------

    @cached_property
    def raw_observations(self) -> DataFrame:
        """The eleven canonical columns, one row per supplier and ship date."""
        grouped = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("s"), F.to_date("l_shipdate").alias("d"))
            .agg(F.max("l_extendedprice").alias("v"), F.max("l_linenumber").alias("ln"))
        )
        k = F.expr("s * 31 + unix_date(d)")
        hours = F.expr(
            "cast(CASE WHEN (s * 31 + unix_date(d)) % 41 = 0 THEN -240 ELSE ln * 24 END + s % 24 AS int)"
        )
        extracted = F.timestamp_add("HOUR", hours, F.col("d").cast("timestamp"))
        return grouped.select(
            F.col("d").alias("observation_date"),
            F.expr("concat('S', s)").alias("series_code"),
            F.expr("concat('series ', s)").alias("series_name"),
            F.when(k % 17 == 0, None).otherwise(F.col("v")).alias("value"),
            F.expr(FREQUENCY_SQL).alias("frequency"),
            F.lit("USD").alias("unit"),
            F.to_date(extracted).alias("extraction_date"),
            extracted.alias("extracted_at"),
            F.timestamp_add("HOUR", F.lit(1), extracted).alias("ingested_at"),
            F.date_format("d", "'run-'yyyyMM").alias("ingestion_run_id"),
            F.lit("tpch").alias("source"),
        )

    @cached_property
    def obs(self) -> DataFrame:
        return tables.scan_observations(self.raw_observations)

    @cached_property
    def first_load(self) -> DataFrame:
        return self.raw_observations.filter(F.col("observation_date") < FIRST_LOAD_END)

    @cached_property
    def second_load(self) -> DataFrame:
        """A later extraction overlapping the first: some values revised, all audit columns new."""
        revised = F.expr("CAST(substring(series_code, 2) AS BIGINT) % 7 = 0")
        return (
            self.raw_observations.filter(F.col("observation_date") >= SECOND_LOAD_START)
            .withColumn("value", F.when(revised, F.col("value") * 1.01).otherwise(F.col("value")))
            .withColumn("ingested_at", F.timestamp_add("DAY", F.lit(1), F.col("ingested_at")))
            .withColumn("ingestion_run_id", F.lit("run-second"))
        )

    @cached_property
    def dirty_obs(self) -> DataFrame:
        """Observations with NaN and infinities."""
        k = F.expr("CAST(substring(series_code, 2) AS BIGINT) * 31 + unix_date(observation_date)")
        return self.obs.withColumn(
            "value",
            F.when(k % 53 == 0, F.lit(float("nan")))
            .when(k % 59 == 0, F.lit(float("inf")))
            .when(k % 61 == 0, F.lit(float("-inf")))
            .otherwise(F.col("value")),
        )

    @cached_property
    def small_obs(self) -> DataFrame:
        """One series per event type."""
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("series_code"), F.to_date("ts").alias("observation_date"))
            .agg(F.max("value").alias("value"))
        )

    @cached_property
    def wide(self) -> DataFrame:
        """One row per day, one column per event type."""
        # The types that occur name the columns.
        return self.table("events").groupBy(F.to_date("ts").alias("observation_date")).pivot("event_type").agg(F.max("value"))

    @cached_property
    def long_text(self) -> DataFrame:
        """Extracted rows before validation: dates and values as text, repeats included."""
        date_text = F.when(F.expr("l_orderkey % 211 = 0"), F.lit("not-a-date")).otherwise(
            F.date_format("l_shipdate", "yyyy-MM-dd")
        )
        value_text = (
            F.when(F.expr("l_partkey % 13 = 0"), F.lit(None).cast("string"))
            .when(F.expr("l_partkey % 97 = 0"), F.lit("invalid"))
            .when(F.expr("l_partkey % 89 = 0"), F.lit("1d"))
            .otherwise(F.col("l_extendedprice").cast("string"))
        )
        return self.table("lineitem").select(
            F.expr("concat('series ', l_suppkey)").alias("series_name"),
            date_text.alias("observation_date"),
            value_text.alias("value"),
        )

    # -- series metadata ---------------------------------------------------

    @cached_property
    def raw_series(self) -> DataFrame:
        """Metadata of every supplier; that of nation 24 under a code without observations."""
        s = F.col("s_suppkey")
        loaded = F.lit("2002-01-01 00:00:00").cast("timestamp")
        return (
            self.table("supplier")
            .withColumn("s", s)
            .select(
                F.expr("concat(CASE WHEN s_nationkey = 24 THEN 'X' ELSE 'S' END, s)").alias("series_code"),
                F.expr("concat('series ', s)").alias("series_name"),
                F.expr("concat('Balance of ', s_name)").alias("description"),
                F.expr("concat('nation ', s_nationkey)").alias("category"),
                F.expr(FREQUENCY_SQL).alias("frequency"),
                F.lit("USD").alias("unit"),
                F.upper("s_name").alias("source_title_es"),
                F.col("s_name").alias("source_title_en"),
                F.expr("date_add(DATE'1995-01-01', cast(s % 400 as int))").alias("first_observation_date"),
                F.expr("DATE'2001-12-31'").alias("last_observation_date"),
                F.expr("DATE'2001-12-31'").alias("source_updated_date"),
                F.to_date(loaded).alias("extraction_date"),
                loaded.alias("extracted_at"),
                F.lit("tpch").alias("source"),
                F.lit("run-200111").alias("ingestion_run_id"),
            )
        )

    @cached_property
    def series(self) -> DataFrame:
        return tables.scan_series(self.raw_series)

    @cached_property
    def series_reload(self) -> DataFrame:
        """Next extraction of the metadata: nation 5 missing, three nations recategorised."""
        moved = F.col("category").isin("nation 1", "nation 11", "nation 21")
        return (
            self.raw_series.filter("category <> 'nation 5'")
            .withColumn(
                "category", F.when(moved, F.concat(F.col("category"), F.lit(" b"))).otherwise(F.col("category"))
            )
            .withColumn("ingestion_run_id", F.lit("run-second"))
        )

    def _tracked(self, rows: DataFrame) -> DataFrame:
        return rows.select("series_code", "series_name", "frequency", "unit", "category", "source")

    @cached_property
    def snapshot_1(self) -> DataFrame:
        """First state seen: nation 9 not there yet."""
        return self._tracked(self.raw_series).filter("category <> 'nation 9'")

    @cached_property
    def snapshot_2(self) -> DataFrame:
        return self._tracked(self.series_reload).withColumn("source", F.lit("tpch v2"))

    @cached_property
    def snapshot_3(self) -> DataFrame:
        """Nation 5 is back."""
        return self._tracked(self.raw_series)

    @cached_property
    def versions(self) -> DataFrame:
        """A version history with planted overlaps: one version per customer and order date."""
        valid_to = F.expr(
            "CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN timestampadd(DAY, -1, valid_from) "
            "WHEN 2 THEN timestampadd(DAY, 400, valid_from) ELSE timestampadd(DAY, 1, valid_from) END"
        )
        return (
            self.table("orders")
            .groupBy("o_custkey", F.col("o_orderdate").cast("timestamp").alias("valid_from"))
            .agg(F.max("o_orderkey").alias("k"))
            .select(
                F.expr("concat('C', o_custkey)").alias("series_code"), "valid_from", valid_to.alias("valid_to")
            )
        )

    # -- configuration and catalog ----------------------------------------

    @cached_property
    def config(self) -> DataFrame:
        """One entry per supplier, and one per nation that has no data."""
        s = self.table("supplier").selectExpr(
            "concat('series ', s_suppkey) AS series_name",
            "concat('S', s_suppkey) AS series_code",
            "DATE'1995-01-01' AS start_date",
            f"{FREQUENCY_SQL.replace('s %', 's_suppkey %')} AS frequency",
            "'USD' AS unit",
            "CASE s_nationkey WHEN 10 THEN false WHEN 11 THEN NULL ELSE true END AS enabled",
            "CASE s_suppkey % 3 WHEN 0 THEN CAST(0.05 AS DOUBLE) WHEN 1 THEN CAST(0.25 AS DOUBLE) END AS max_null_ratio",
            "s_suppkey % 5 <> 0 AS require_numeric",
            "s_suppkey % 2 = 0 AS allow_duplicate_dates",
            "CASE WHEN s_suppkey % 4 = 0 THEN CAST(1000 AS DOUBLE) END AS min_value",
        )
        ghosts = self.table("nation").selectExpr(
            "concat('ghost ', n_name) AS series_name",
            "concat('G', n_nationkey) AS series_code",
            "DATE'1995-01-01' AS start_date",
            "'daily' AS frequency",
            "'USD' AS unit",
            "true AS enabled",
            "CAST(NULL AS DOUBLE) AS max_null_ratio",
            "true AS require_numeric",
            "false AS allow_duplicate_dates",
            "CAST(NULL AS DOUBLE) AS min_value",
        )
        return s.unionByName(ghosts)

    @cached_property
    def faulty_config(self) -> DataFrame:
        """The configuration with missing codes (nation 2) and repeated ones (nation 4)."""
        joined = self.table("supplier").selectExpr(
            "concat('series ', s_suppkey) AS series_name",
            "CASE s_nationkey WHEN 2 THEN NULL WHEN 4 THEN 'S-four' ELSE concat('S', s_suppkey) END AS series_code",
            "CASE WHEN s_nationkey <> 7 THEN DATE'1995-01-01' END AS start_date",
        )
        return joined

    @cached_property
    def catalog(self) -> DataFrame:
        """Source catalog: nation 3 under other codes, nation 8 listed twice, nation 12 with another frequency."""
        rows = self.table("supplier").selectExpr(
            "concat(CASE WHEN s_nationkey = 3 THEN 'X' ELSE 'S' END, s_suppkey) AS series_code",
            f"CASE WHEN s_nationkey = 12 THEN 'WEEKLY' ELSE upper({FREQUENCY_SQL.replace('s %', 's_suppkey %')}) END AS frequency_code",
            "upper(s_name) AS spanish_title",
            "s_name AS english_title",
            "CASE WHEN s_nationkey = 14 THEN 'unknown' ELSE '1995-01-01' END AS first_observation",
            "'2001-12-31 08:00:00' AS last_observation",
            "'2001-12-31' AS updated_at",
            "s_nationkey AS nation",
        )
        twice = F.explode(F.when(F.col("nation") == 8, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        return rows.withColumn("copy", twice).drop("copy", "nation")

    @cached_property
    def curated(self) -> DataFrame:
        """Curated metadata: nation 6 under other codes, nation 13 without category, nation 17 without unit."""
        return self.table("supplier").selectExpr(
            "concat(CASE WHEN s_nationkey = 6 THEN 'Y' ELSE 'S' END, s_suppkey) AS series_code",
            "concat('series ', s_suppkey) AS series_name",
            "concat('Balance of ', s_name) AS description",
            "CASE WHEN s_nationkey = 13 THEN '' ELSE concat('nation ', s_nationkey) END AS category",
            "CASE WHEN s_nationkey <> 17 THEN 'USD' END AS unit",
        )

    @cached_property
    def bounds(self) -> DataFrame:
        """Value bounds per series: four kinds of rule, open and closed."""
        return self.table("supplier").selectExpr(
            "concat('S', s_suppkey) AS series_code",
            "CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE CAST(5000 + s_suppkey AS DOUBLE) END AS lo",
            "CASE s_suppkey % 4 WHEN 2 THEN NULL ELSE CAST(60000 + s_suppkey AS DOUBLE) END AS hi",
            "s_suppkey % 2 = 0 AS lo_inclusive",
            "s_suppkey % 3 = 0 AS hi_inclusive",
        )

    # -- runs -----------------------------------------------------------------

    @cached_property
    def run_stats(self) -> DataFrame:
        """One row per run that wrote observations; idx numbers its month."""
        return (
            self.raw_observations.groupBy("ingestion_run_id")
            .agg(
                F.min("observation_date").alias("d"),
                F.count(F.lit(1)).alias("n"),
                F.count("value").alias("nv"),
            )
            .withColumn("idx", F.expr("year(d) * 12 + month(d)"))
            .withColumn("t", F.trunc("d", "month").cast("timestamp"))
            .withColumn(
                "status",
                F.expr("element_at(array('running', 'success', 'failed', 'crashed', 'unknown'), idx % 5 + 1)"),
            )
        )

    @cached_property
    def runs(self) -> DataFrame:
        """The audit table; the run of August 1998 was recorded under another id."""
        return self.run_stats.selectExpr(
            "CASE WHEN idx = 1998 * 12 + 8 THEN 'misnamed' ELSE ingestion_run_id END AS run_id",
            "'tpch' AS source",
            "timestampadd(HOUR, 2, t) AS started_at",
            "CASE WHEN status IN ('running', 'unknown') THEN CASE WHEN idx % 7 = 0 THEN t END "
            "WHEN idx % 33 = 0 THEN NULL ELSE timestampadd(HOUR, 1 + idx % 7, t) END AS completed_at",
            "status",
            "n AS extracted_rows",
            "nv AS valid_rows",
            "n - nv + CASE WHEN idx % 9 = 0 THEN 1 ELSE 0 END AS rejected_rows",
            "nv + CASE WHEN idx % 16 = 0 THEN 1 ELSE 0 END AS loaded_rows",
            "CASE WHEN idx % 27 = 0 THEN repeat('x', 1200) WHEN status IN ('failed', 'crashed') AND idx % 4 <> 0 "
            "THEN concat('boom ', idx) WHEN status = 'success' AND idx % 6 = 0 THEN 'odd' END AS error_message",
            "'observations' AS pipeline",
            "'raw.observations' AS target_table",
            "CAST(CASE status WHEN 'success' THEN 0 WHEN 'failed' THEN 75 WHEN 'crashed' THEN 1 END AS BIGINT) AS exit_code",
            "CAST(CASE WHEN idx % 6 <> 0 THEN idx % 4 END AS BIGINT) AS rows_changed",
            "CAST(NULL AS STRING) AS summary_uri",
            "concat('parent-', year(d), '-', quarter(d)) AS parent_run_id",
        )

    @cached_property
    def results(self) -> DataFrame:
        """One result per run and series; a third of the runs are clean, a third fail retryably."""
        grouped = (
            self.raw_observations.withColumn("s", F.expr("CAST(substring(series_code, 2) AS BIGINT)"))
            .groupBy("ingestion_run_id", "s")
            .agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("nv"), F.min("observation_date").alias("d"))
            .withColumn("idx", F.expr("year(d) * 12 + month(d)"))
            .withColumn("h", F.expr("CASE WHEN idx % 3 = 0 THEN 9 ELSE (s * 7 + idx) % 10 END"))
        )
        return grouped.selectExpr(
            "ingestion_run_id AS run_id",
            "s AS position",
            "concat('series ', s) AS series_name",
            "concat('S', s) AS series_code",
            "CASE WHEN h = 0 THEN 'quality_failed' WHEN h IN (1, 2) THEN 'technical_failed' ELSE 'success' END AS status",
            "n AS row_count",
            "CASE WHEN h <> 0 THEN n ELSE 0 END AS valid_rows",
            "CASE WHEN h = 0 THEN n ELSE 0 END AS rejected_rows",
            "CASE WHEN h > 2 THEN n END AS loaded_rows",
            "CASE WHEN s % 5 <> 0 THEN nv END AS rows_changed",
            "CASE WHEN h IN (1, 2) AND s % 2 = 0 THEN 'Read timed out' END AS error",
            "CASE WHEN h = 0 AND s % 3 = 0 THEN array('min_value', 'max_null_ratio') "
            "WHEN h = 0 THEN array('min_value') END AS failed_checks",
            "CASE WHEN idx % 3 = 1 THEN true WHEN s % 4 = 1 THEN NULL ELSE s % 4 <> 0 END AS retryable",
            "s % 3 AS retries",
        )

    @cached_property
    def run_events(self) -> DataFrame:
        """Start and end events of every run and series, as a log would hold them."""
        key = "concat(run_id, '-', position)"
        day = "cast(to_date(concat(substring(run_id, 5), '01'), 'yyyyMMdd') as timestamp)"
        return self.results.select(
            F.expr(key).alias("run_id"),
            F.explode(
                F.expr(
                    f"CASE WHEN retries = 2 THEN array(named_struct('event_time', {day}, 'status', 'running')) "
                    f"WHEN retries = 1 THEN array(named_struct('event_time', {day}, 'status', 'running'), "
                    f"named_struct('event_time', timestampadd(HOUR, cast(row_count as int), {day}), 'status', "
                    "CASE WHEN status = 'success' THEN 'success' ELSE 'failed' END)) "
                    f"ELSE array(named_struct('event_time', {day}, 'status', 'running'), "
                    f"named_struct('event_time', {day}, 'status', 'crashed')) END"
                )
            ).alias("e"),
        ).select("run_id", "e.event_time", "e.status")

    @cached_property
    def jobs(self) -> DataFrame:
        """Warehouse jobs with labels, one per order."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("job_id"),
            F.array(
                F.struct(F.lit("pipeline").alias("key"), F.lower("o_orderpriority").alias("value")),
                F.struct(
                    F.lit("run_id").alias("key"), F.date_format("o_orderdate", "yyyyMMdd").alias("value")
                ),
            ).alias("labels"),
        )

    # -- marts ----------------------------------------------------------------

    @cached_property
    def dim_series(self) -> DataFrame:
        return marts.dim_series(self.series)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.obs)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.full_fact(self.obs, self.dim_series, self.dim_date)

    @cached_property
    def old_fact(self) -> DataFrame:
        """The fact as built from what had arrived by the cutoff."""
        arrived = self.obs.filter(F.col("extracted_at") <= F.lit(FACT_CUTOFF).cast("timestamp"))
        return marts.full_fact(arrived, self.dim_series, marts.dim_date(arrived))

    @cached_property
    def retracted_obs(self) -> DataFrame:
        """Observations after some old values were retracted to NULL."""
        k = F.expr("CAST(substring(series_code, 2) AS BIGINT) * 31 + unix_date(observation_date)")
        return self.obs.withColumn("value", F.when(k % 19 == 0, None).otherwise(F.col("value")))


FREQUENCY_SQL = "CASE s % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'monthly' WHEN 2 THEN 'quarterly' ELSE 'annual' END"
