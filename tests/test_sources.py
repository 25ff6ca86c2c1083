"""Landed files: layout, replay, checksums, summaries, and the incremental source."""

import hashlib
import json
from datetime import date, datetime

from pyspark.sql import functions as F

from collecting import collected
from seriesmart.operators import validate
from seriesmart.schemas import OBSERVATIONS
from seriesmart.sources import landed, tables
from seriesmart.streaming.landed_stream import merge_landed_files

LANDED = "series_name string, extraction_date date, window string, observation_date date, value double"
D = date(2026, 9, 25)


def test_windows_of_one_day_do_not_overwrite_each_other(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    landed.write_landed(rows(LANDED, ("a", D, None, date(2026, 1, 1), 1.0)), path, per_series=True)
    window = "2026-02-01_2026-02-28"
    landed.write_landed(rows(LANDED, ("a", D, window, date(2026, 2, 1), 2.0)), path, per_series=True)
    landed.write_landed(rows(LANDED, ("a", D, window, date(2026, 2, 1), 3.0)), path, per_series=True)
    landed.write_landed(rows(LANDED, ("b", D, window, date(2026, 2, 1), None)), path, per_series=True)
    assert (tmp_path / "raw/series_name=a/extraction_date=2026-09-25" / f"window={window}").is_dir()
    assert collected(landed.read_landed(spark, path), "series_name", "window", "value") == sorted(
        [("a", "full", 1.0), ("a", window, 3.0), ("b", window, None)], key=repr
    )


def test_one_folder_for_all_series(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    landed.write_landed(rows(LANDED, ("a", D, None, D, 1.0), ("b", D, None, D, None)), path)
    assert (tmp_path / "raw/extraction_date=2026-09-25/window=full").is_dir()
    assert collected(landed.read_landed(spark, path), "series_name", "value") == [("a", 1.0), ("b", None)]


def write_artifact(folder, series, records):
    folder.mkdir(parents=True)
    document = {
        "schema": {"fields": [{"name": "index", "type": "datetime"}, {"name": series, "type": "number"}]},
        "data": [{"index": day, series: value} for day, value in records],
    }
    (folder / "data.json").write_text(json.dumps(document, indent=2))
    (folder / "metadata.json").write_text("{}")


def test_replay_of_artifacts_with_and_without_window(spark, tmp_path):
    write_artifact(tmp_path / "usd/extraction_date=2026-09-25", "usd", [("2026-01-01T00:00:00.000", 900.5), ("2026-01-02T00:00:00.000", None)])
    write_artifact(tmp_path / "tpm/extraction_date=2026-09-25/window=2026-01-01_2026-01-31", "tpm", [("2026-01-01T00:00:00.000", 5.25)])
    got = landed.read_table_json(spark, str(tmp_path))
    assert collected(got) == sorted(
        [
            ("usd", date(2026, 1, 1), "900.5", D, "full"),
            ("usd", date(2026, 1, 2), None, D, "full"),
            ("tpm", date(2026, 1, 1), "5.25", D, "2026-01-01_2026-01-31"),
        ],
        key=repr,
    )


def test_checksums_are_those_of_the_files(spark, rows, tmp_path):
    path = tmp_path / "raw"
    landed.write_landed(rows(LANDED, ("a", D, None, D, 1.0), ("b", D, None, D, 2.0)), str(path), per_series=True)
    expected = {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in path.rglob("part-*.json")}
    got = {r.path.removeprefix("file:"): r.sha256 for r in landed.file_checksums(spark, str(path)).collect()}
    assert got == expected and len(got) == 2


def test_manifest_describes_each_artifact(rows):
    config = rows(
        "series_name string, series_code string, frequency string, unit string, max_null_ratio double, min_value double",
        ("a", "A", "daily", "u", 0.1, None),
    )
    files = rows(LANDED, ("a", D, "full", date(2026, 1, 1), 1.0), ("a", D, "full", date(2026, 1, 3), None))
    checked = validate.checks(validate.profile(files, config, date(2026, 1, 1), date(2026, 12, 31)))
    row = landed.artifact_manifest(files, checked).head()
    assert (row.first_observation, row.last_observation, row.row_count) == (date(2026, 1, 1), date(2026, 1, 3), 2)
    assert row.quality_passed is False and row.failed_checks == "null_ratio"
    assert [c["name"] for c in json.loads(row.quality)][0] == "not_empty"


def test_summaries_and_results_are_filed_by_run_date(spark, rows, tmp_path):
    summary = rows("run_id string, status string, started_at timestamp", ("r", "success", datetime(2026, 1, 2, 3)))
    results = rows("run_id string, series_name string", ("r", "a"), ("r", "b"))
    landed.write_run_summaries(summary, results, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/summaries/run_date=2026-01-02").head().run_id == "r"
    assert spark.read.json(f"{tmp_path}/results").count() == 2


def test_clustered_rows_are_sorted_within_partitions(spark, tmp_path):
    df = spark.range(1000).select(
        F.pmod("id", F.lit(3)).cast("string").alias("m"), F.pmod(F.col("id") * 7, F.lit(50)).alias("k")
    )
    tables.clustered(df, ["m"], ["k"]).write.partitionBy("m").parquet(str(tmp_path / "t"))
    for file in (tmp_path / "t").rglob("*.parquet"):
        keys = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


def test_each_landed_file_is_merged_once(spark, rows, tmp_path):
    landing, table, memory = (str(tmp_path / n) for n in ("raw", "table", "memory"))
    config = rows("series_name string, series_code string, frequency string, unit string", ("a", "A", "daily", "u"))
    at = F.lit(datetime(2026, 9, 25))
    tables.write_observations(spark.createDataFrame([], OBSERVATIONS), table)
    # an empty table has no folders yet: give it one row
    first = rows(LANDED, ("a", D, None, date(2026, 1, 1), 1.0))
    tables.write_observations(
        first.select(
            "observation_date",
            F.lit("A").alias("series_code"),
            "series_name",
            "value",
            F.lit("daily").alias("frequency"),
            F.lit("u").alias("unit"),
            F.lit(D).alias("extraction_date"),
            at.alias("extracted_at"),
            at.alias("ingested_at"),
            F.lit("r0").alias("ingestion_run_id"),
            F.lit("bank").alias("source"),
        ),
        table,
    )

    def drain():
        seen = []
        merge_landed_files(
            spark, landing, table, config, at, F.lit("r1"), "bank", memory, lambda _i, c: seen.append(c["rows_changed"])
        ).awaitTermination()
        return seen

    landed.write_landed(rows(LANDED, ("a", D, "w1", date(2026, 1, 1), 1.0), ("a", D, "w1", date(2026, 1, 2), 2.0)), landing)
    assert drain() == [1]
    assert drain() == []
    landed.write_landed(rows(LANDED, ("a", D, "w2", date(2026, 1, 2), 2.5)), landing)
    assert drain() == [1]
    assert collected(spark.read.parquet(table), "observation_date", "value", "ingestion_run_id") == [
        (date(2026, 1, 1), 1.0, "r0"),
        (date(2026, 1, 2), 2.5, "r1"),
    ]
    # Two extractions of one day in one batch: the later window counts.
    landed.write_landed(rows(LANDED, ("a", D, "w3", date(2026, 1, 2), 3.0)), landing)
    landed.write_landed(rows(LANDED, ("a", D, "w4", date(2026, 1, 2), 4.0)), landing)
    assert drain() == [1]
    assert collected(spark.read.parquet(table), "observation_date", "value")[1] == (date(2026, 1, 2), 4.0)
