"""Landed raw files: read for replay, written per extraction date and window.

Layout: ``[series_name=<name>/]extraction_date=<date>/window=<start_end or full>``.
The window folder is always there, so partition discovery sees one layout. A
folder per series suits a few series landed one by one; with many, one batch
lands all of them and the series is a column, sorted inside the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.sets import union_all
from ..operators.validate import failed_checks

LANDING_KEYS = ("series_name", "extraction_date", "window")
FULL_WINDOW = "full"


def write_landed(long: DataFrame, path: str, per_series: bool = False) -> None:
    """Land rows as JSON lines. Only the folders present in ``long`` are
    replaced, so windows landed on the same day live side by side. Without
    ``per_series`` a folder holds one batch of all series."""
    rows = long.withColumn("window", F.coalesce("window", F.lit(FULL_WINDOW)))
    folders = LANDING_KEYS if per_series else LANDING_KEYS[1:]
    # REBALANCE splits a heavy folder over several files.
    order = [c for c in ("series_name", "observation_date") if c in rows.columns and c not in folders]
    laid_out = rows.hint("rebalance", *folders).sortWithinPartitions(*folders, *order)
    laid_out.write.partitionBy(*folders).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("ignoreNullFields", "false").json(path)


def read_landed(spark: SparkSession, path: str, data: str = "observation_date date, value double") -> DataFrame:
    """Read back what write_landed wrote; folders prune by the landing keys."""
    keys = "series_name string, extraction_date date, window string"
    return spark.read.schema(f"{data}, {keys}").json(path)


def read_table_json(spark: SparkSession, path: str, pattern: str = "data*.json") -> DataFrame:
    """Replay table-oriented artifacts: ``{"schema": ..., "data": [{index, series: value}]}``.

    Works for folders with and without window=; the series is the record's one
    field besides its date, so all series share one schema. Values stay text
    for the validation to judge.
    """
    raw = (
        spark.read.schema("data array<map<string,string>>")
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(path)
        .withColumn("file_path", F.col("_metadata.file_path"))
    )
    records = raw.select("file_path", F.explode("data").alias("record"))
    entries = records.select(
        "file_path",
        F.coalesce(
            F.try_element_at("record", F.lit("index")), F.try_element_at("record", F.lit("date"))
        ).alias("observation_date"),
        F.explode(
            F.map_filter("record", lambda k, _: ~k.isin("index", "date"))
        ).alias("series_name", "value"),
    )
    part = lambda key: F.nullif(
        F.regexp_extract("file_path", rf"/{key}=([^/]+)/", 1), F.lit("")
    )
    return entries.select(
        "series_name",
        F.to_date(F.substring("observation_date", 1, 10)).alias("observation_date"),
        "value",
        F.to_date(part("extraction_date")).alias("extraction_date"),
        F.coalesce(part("window"), F.lit(FULL_WINDOW)).alias("window"),
    )


def catalog_union(catalogs: Sequence[DataFrame]) -> DataFrame:
    """One catalog from one landed file per frequency."""
    return union_all(catalogs, allow_missing=True)


def artifact_manifest(
    landed: DataFrame,
    checked: DataFrame,
    requested: tuple[Column, Column] | None = None,
    checksums: DataFrame | None = None,
) -> DataFrame:
    """What each landed artifact holds, with its checks as JSON.

    ``checked`` is validate.checks() output keyed by series_name. ``requested`` adds the
    window asked for, as expressions over the manifest's columns; ``checksums``, as
    ``artifact_checksums`` gives them, adds the digest of the artifact's files.
    """
    held = landed.groupBy(*LANDING_KEYS).agg(
        F.min("observation_date").alias("first_observation"),
        F.max("observation_date").alias("last_observation"),
        F.count(F.lit(1)).alias("row_count"),
    )
    quality = checked.select(
        "series_name",
        "series_code",
        "frequency",
        "unit",
        F.col("passed").alias("quality_passed"),
        F.concat_ws(", ", failed_checks()).alias("failed_checks"),
        F.to_json("checks").alias("quality"),
    )
    manifest = held.join(quality, "series_name", "left")
    if requested is not None:
        first, last = requested
        manifest = manifest.withColumns({"requested_start_date": first, "requested_end_date": last})
    if checksums is not None:
        manifest = manifest.join(checksums, list(LANDING_KEYS), "left")
    return manifest


def file_checksums(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """SHA-256 of every landed file, one row per file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def artifact_checksums(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(series_name, extraction_date, window, data_file_sha256) of files landed per series.

    An artifact of several files has the digests of all, by file name.
    """
    def key(name: str) -> Column:
        return F.url_decode(F.regexp_extract("path", rf"/{name}=([^/]+)/", 1))

    files = file_checksums(spark, path, pattern).select(
        key("series_name").alias("series_name"), F.to_date(key("extraction_date")).alias("extraction_date"),
        key("window").alias("window"), F.struct("path", "sha256").alias("file"),
    )
    digests = F.transform(F.sort_array(F.collect_list("file")), lambda f: f["sha256"])
    return files.groupBy(*LANDING_KEYS).agg(F.array_join(digests, ",").alias("data_file_sha256"))


def write_run_summaries(summary: DataFrame, results: DataFrame, path: str) -> None:
    """Run summaries under run_date=, the per-series results beside them.

    A run may hold any number of series, so its results are lines of their own
    rather than one array in one row.
    """
    dated = summary.withColumn("run_date", F.to_date("started_at"))
    dated.write.partitionBy("run_date").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).json(f"{path}/summaries")
    lines = results.join(dated.select("run_id", "run_date"), "run_id")
    lines.hint("rebalance", "run_date").write.partitionBy("run_date").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).json(f"{path}/results")
