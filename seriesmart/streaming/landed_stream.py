"""Landed files as an incremental source: each new file is merged exactly once.

The batch upsert stays the unit of work; the stream only remembers which files
it has seen. ``availableNow`` drains what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.canonical import canonical_observations
from ..schemas import OBSERVATIONS_KEY
from ..sources.tables import merge_into_path


def merge_landed_files(
    spark: SparkSession,
    landing: str,
    table: str,
    config: DataFrame,
    extracted_at: Column,
    run_id: Column,
    source: str,
    checkpoint: str,
    on_counts: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Merge files that appeared under ``landing`` since the last call.

    A batch that is retried merges the same rows again, which changes nothing. Where
    one batch holds several extractions of an observation, the latest one counts, of
    the latest window among equals.
    """
    keys = "series_name string, extraction_date date, window string"
    files = spark.readStream.schema(f"observation_date date, value double, {keys}").json(landing)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        latest = F.max_by(F.struct(*batch.columns), F.struct("extraction_date", "window"))
        once = batch.groupBy("series_name", "observation_date").agg(latest.alias("row")).select("row.*")
        rows = canonical_observations(once, config, extracted_at, extracted_at, run_id, source)
        counts = merge_into_path(batch.sparkSession, table, rows, OBSERVATIONS_KEY)
        if on_counts:
            on_counts(batch_id, counts)

    return (
        files.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
