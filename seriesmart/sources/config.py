"""Series configuration and curated metadata as frames."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sets import union_all
from ..session import ensure_checkpoint_dir

CONFIG_SCHEMA = (
    "series_name string, series_code string, start_date date, frequency string, unit string, "
    "enabled boolean, max_null_ratio double, require_numeric boolean, "
    "allow_duplicate_dates boolean, min_value double"
)
# What a series configuration must fill in.
REQUIRED = ("series_name", "series_code", "start_date")


def from_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame([dict(r) for r in rows], CONFIG_SCHEMA)


def enabled(config: DataFrame) -> DataFrame:
    """Series not switched off; enabled unless it says otherwise."""
    return config.filter(F.coalesce("enabled", F.lit(True)))


def config_problems(config: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """(problem, subject): missing fields, repeated names, repeated codes."""
    missing = [
        config.filter(F.col(c).isNull()).select(
            F.lit(f"missing {c}").alias("problem"),
            F.coalesce("series_code", "series_name", F.lit("?")).alias("subject"),
        )
        for c in required
    ]
    repeated = [_repeated(config, c) for c in ("series_name", "series_code")]
    return union_all([*missing, *repeated])


def _repeated(rows: DataFrame, column: str) -> DataFrame:
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.lit(f"duplicate {column}").alias("problem"), F.col(column).alias("subject"))
    )


def curated_problems(curated: DataFrame) -> DataFrame:
    """Curated entries without a code, and codes with several entries."""
    nameless = curated.filter(F.coalesce("series_code", F.lit("")) == "").select(
        F.lit("missing series_code").alias("problem"),
        F.coalesce("series_name", F.lit("?")).alias("subject"),
    )
    return union_all([nameless, _repeated(curated.filter(F.col("series_code") != ""), "series_code")])


def checked(config: DataFrame, problems: DataFrame, report: str | None = None) -> DataFrame:
    """The configuration, or ValueError with the number of problems and where they all are.

    All problems are written to the table at ``report``, by default a new one in the
    shared folder; the error quotes the first.
    """
    spark = problems.sparkSession
    report = report or f"{ensure_checkpoint_dir(spark)}/config-problems/{uuid.uuid4().hex}"
    problems.write.mode("overwrite").parquet(report)
    written = spark.read.schema(problems.schema).parquet(report)
    found = written.count()
    if found:
        first = written.orderBy("problem", "subject").first()
        raise ValueError(f"{found} problems, listed in {report}; the first is {first.problem}: {first.subject}")
    return config
