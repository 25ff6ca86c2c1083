"""Declared table schemas, keys and audit columns.

Spark file sources do not enforce nullability, so a ``nullable=False`` field is
turned into a not-null rule by :func:`required_columns`.
"""

from __future__ import annotations

from pyspark.sql import types as T

# When or by which run a row was loaded, as opposed to what was loaded:
# change detection ignores these columns.
AUDIT_COLUMNS = (
    "extraction_date",
    "extracted_at",
    "ingested_at",
    "ingestion_run_id",
)

OBSERVATIONS_KEY = ("series_code", "observation_date")
SERIES_KEY = ("series_code",)
RUNS_KEY = ("run_id",)


_TYPES = {
    "DATE": T.DateType(),
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "BIGINT": T.LongType(),
}


def _schema(columns: str) -> T.StructType:
    """A schema from ``name TYPE [NOT NULL]`` lines; needs no session."""
    fields = []
    for line in columns.strip().split(","):
        name, dtype, *rest = line.split()
        fields.append(T.StructField(name, _TYPES[dtype], nullable=not rest))
    return T.StructType(fields)


OBSERVATIONS = _schema(
    """
    observation_date DATE NOT NULL,
    series_code STRING NOT NULL,
    series_name STRING NOT NULL,
    value DOUBLE,
    frequency STRING,
    unit STRING,
    extraction_date DATE NOT NULL,
    extracted_at TIMESTAMP NOT NULL,
    ingested_at TIMESTAMP,
    ingestion_run_id STRING,
    source STRING NOT NULL
    """
)

SERIES = _schema(
    """
    series_code STRING NOT NULL,
    series_name STRING NOT NULL,
    description STRING,
    category STRING NOT NULL,
    frequency STRING NOT NULL,
    unit STRING NOT NULL,
    source_title_es STRING,
    source_title_en STRING,
    first_observation_date DATE,
    last_observation_date DATE,
    source_updated_date DATE,
    extraction_date DATE NOT NULL,
    extracted_at TIMESTAMP NOT NULL,
    source STRING NOT NULL,
    ingestion_run_id STRING
    """
)

RUNS = _schema(
    """
    run_id STRING NOT NULL,
    source STRING NOT NULL,
    started_at TIMESTAMP NOT NULL,
    completed_at TIMESTAMP,
    status STRING NOT NULL,
    extracted_rows BIGINT,
    valid_rows BIGINT,
    rejected_rows BIGINT,
    loaded_rows BIGINT,
    error_message STRING,
    pipeline STRING NOT NULL,
    target_table STRING NOT NULL,
    exit_code BIGINT,
    rows_changed BIGINT,
    summary_uri STRING,
    parent_run_id STRING,
    airflow_dag_id STRING,
    airflow_run_id STRING,
    airflow_task_id STRING,
    airflow_try_number STRING
    """
)

# Columns a finished run overwrites, and those a crashed run overwrites.
RUN_COMPLETION_COLUMNS = (
    "status",
    "completed_at",
    "extracted_rows",
    "valid_rows",
    "rejected_rows",
    "loaded_rows",
    "error_message",
    "exit_code",
    "rows_changed",
    "summary_uri",
)
RUN_CRASH_COLUMNS = ("status", "completed_at", "error_message")

# What a run or a series frequency may be called.
RUN_STATUSES = ("running", "success", "failed", "crashed", "unknown")
FREQUENCIES = ("daily", "monthly", "quarterly", "annual")


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


def conform(df, schema: T.StructType):
    """Select the schema's columns in order, cast to its types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
