"""Warehouse tables: scans, creation, clustered writes and in-place merges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.filters import in_window
from ..operators.merge import DELETE, KEEP, merge_apply, merge_counts, merge_plan, unique_source
from ..schemas import AUDIT_COLUMNS
from ..session import folder_names, remove_folder, staged

MONTH = "observation_month"


def scan_observations(raw: DataFrame) -> DataFrame:
    """The five columns staging exposes; the rest is not read."""
    return raw.select("series_code", "observation_date", "value", "extracted_at", "ingestion_run_id")


def scan_series(raw: DataFrame) -> DataFrame:
    return raw.select(
        "series_code",
        "series_name",
        F.col("description").alias("series_description"),
        "category",
        "frequency",
        "unit",
        "source",
        "source_title_es",
        "source_title_en",
        "first_observation_date",
        "last_observation_date",
        "source_updated_date",
        "extracted_at",
    )


def scan_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> DataFrame:
    """The table, created if missing. Partition columns must be in the schema."""
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet{parts}{place}")
    return spark.table(name)


def month_of(day: Column | str) -> Column:
    """Partition value: one folder per month, not thousands of daily ones."""
    return F.date_format(day, "yyyy-MM")


def clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Rows laid out for a partitioned write, sorted by the cluster columns.

    REBALANCE lets adaptive execution split a heavy partition over several
    files and merge light ones, so one hot month is not one task.
    """
    balanced = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    return balanced.sortWithinPartitions(*partition_by, *cluster_by)


def load(df: DataFrame, name: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Insert into a table, laid out for its partitions and clustering."""
    spark = df.sparkSession
    ordered = clustered(df, partition_by, cluster_by) if (partition_by or cluster_by) else df
    ordered.select(*spark.table(name).columns).write.insertInto(name)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def materialize(df: DataFrame, how: str, target: str) -> DataFrame:
    """As a temporary view, or as a Parquet table at a path replaced as a whole."""
    if how == "view":
        df.createOrReplaceTempView(target)
        return df.sparkSession.table(target)
    if how == "table":
        df.write.mode("overwrite").parquet(target)
        return df.sparkSession.read.parquet(target)
    raise ValueError(f"unknown materialization: {how}")


def stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A month-partitioned table; the partition column is text.

    With a ``schema`` (without the month) a table that is missing or has no month
    left reads as empty.
    """
    if schema is not None and not any(n.startswith(f"{MONTH}=") for n in folder_names(spark, path)):
        fields = [f for f in schema.fields if f.name != MONTH]
        return spark.createDataFrame([], T.StructType([*fields, T.StructField(MONTH, T.StringType())]))
    table = spark.read.option("basePath", path).parquet(path)
    return table.withColumn(MONTH, F.col(MONTH).cast("string"))


def keyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, failing the job at a NULL in a key column."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    message = F.concat(F.lit("NULL in merge key: "), F.to_json(F.struct(*keys)))
    return rows.filter(F.when(missing, F.raise_error(message).cast("boolean")).otherwise(True))


def scan_window(
    spark: SparkSession, path: str, start: date, end: date, day: str = "observation_date"
) -> DataFrame:
    """Rows of an inclusive window: other months' folders are not listed for
    reading, other row groups are skipped by their statistics."""
    months = F.col(MONTH).between(f"{start:%Y-%m}", f"{end:%Y-%m}")
    return in_window(stored(spark, path).filter(months), start, end, day)


def write_observations(df: DataFrame, path: str, cluster: str = "series_code") -> None:
    """First load of an observation table, partitioned by month."""
    dated = df.withColumn(MONTH, month_of("observation_date"))
    clustered(dated, [MONTH], [cluster]).write.partitionBy(MONTH).mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)


def _replace_months(rows: DataFrame, path: str, cluster: str) -> None:
    clustered(rows, [MONTH], [cluster]).write.partitionBy(MONTH).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def _months(rows: DataFrame) -> list[str]:
    """Months present; their number is bounded by the calendar, not the data."""
    return [row[0] for row in rows.select(MONTH).distinct().collect()]


def merge_into_path(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    audit_columns: Sequence[str] = AUDIT_COLUMNS,
    update: str = "changed",
    day: str = "observation_date",
    cluster: str = "series_code",
) -> dict[str, int]:
    """Upsert into a table partitioned by month; return the change counts.

    Only months the source touches are read, and of those only months holding a
    change are rewritten, so the cost follows the batch and not the table. The
    source and the plan are each computed once. A rerun after a half-applied
    write converges: unchanged rows are kept and changed ones are set to the
    same values. A missing table is created; a NULL key fails. One writer at a time.
    """
    with staged(with_month(source, keys, day)) as batch:
        return merge_batch(spark, path, batch, keys, audit_columns, update, cluster)


def with_month(source: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """A batch as ``merge_batch`` takes it: keys checked, its month beside every row."""
    return keyed(source, [*keys, day]).withColumn(MONTH, month_of(day))


def merge_batch(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    audit_columns: Sequence[str] = AUDIT_COLUMNS,
    update: str = "changed",
    cluster: str = "series_code",
) -> dict[str, int]:
    """``merge_into_path`` for a staged batch that carries its month.

    Rows of months the table lacks meet nothing: they are inserted as they are, only
    their keys are compared with each other. One job writes them and the changed
    months, so a repeated key leaves the table as it was.
    """
    held = {n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{MONTH}=")}
    months = set(_months(batch))
    counts = {"inserted": 0, "updated": 0, "deleted": 0, "rows_changed": 0}
    target = stored(spark, path, batch.schema)
    fresh = batch.filter(F.col(MONTH).isin(sorted(months - held))).select(*target.columns)
    if months - held:
        once = unique_source(fresh.select(*keys, MONTH), [*keys, MONTH])
        counts["inserted"] = counts["rows_changed"] = once.count()
    if not months & held:
        if months:
            _replace_months(fresh, path, cluster)
        return counts
    touched = target.filter(F.col(MONTH).isin(sorted(months & held)))
    known = batch.filter(F.col(MONTH).isin(sorted(months & held))).select(*target.columns)
    with staged(merge_plan(touched, known, keys, [*audit_columns, MONTH], update)) as plan:
        found = merge_counts(plan).head().asDict()
        counts = {name: n + found[name] for name, n in counts.items()}
        dirty = _months(plan.filter(F.col("_action") != KEEP)) if found["rows_changed"] else []
        if counts["rows_changed"]:
            changed = merge_apply(plan.filter(F.col(MONTH).isin(dirty)))
            _replace_months(changed.unionByName(fresh) if months - held else changed, path, cluster)
    return counts


def sync_into_path(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    audit_columns: Sequence[str] = AUDIT_COLUMNS,
    update: str = "changed",
    day: str = "observation_date",
    cluster: str = "series_code",
) -> dict[str, int]:
    """``merge_into_path`` that also deletes the rows whose keys the source lacks.

    One plan over the whole table, and one rewrite of the months holding a change.
    """
    batch = with_month(source, keys, day)
    target = stored(spark, path, batch.schema)
    planned = merge_plan(target, batch.select(*target.columns), keys, [*audit_columns, MONTH], update, absent=DELETE)
    with staged(planned) as plan:
        counts = merge_counts(plan).head().asDict()
        if counts["rows_changed"]:
            dirty = _months(plan.filter(F.col("_action") != KEEP))
            rows = merge_apply(plan.filter(F.col(MONTH).isin(dirty)))
            left = _months(rows)
            if left:
                _replace_months(rows, path, cluster)
            for month in set(dirty) - set(left):
                remove_folder(spark, f"{path}/{MONTH}={month}")
    return counts


def delete_from_path(
    spark: SparkSession,
    path: str,
    doomed: DataFrame,
    keys: Sequence[str],
    day: str = "observation_date",
    cluster: str = "series_code",
) -> int:
    """Delete the rows whose keys are in ``doomed``; return how many went.

    Only months holding such a row are rewritten. A month left without rows is
    dropped as a folder, which an overwrite would leave as it was.
    """
    with staged(doomed.select(*keys).withColumn(MONTH, month_of(day))) as gone:
        return delete_batch(spark, path, gone, keys, cluster)


def delete_batch(
    spark: SparkSession, path: str, gone: DataFrame, keys: Sequence[str], cluster: str = "series_code"
) -> int:
    """``delete_from_path`` for staged keys that carry their month."""
    months = _months(gone)
    if not months or not any(n.startswith(f"{MONTH}=") for n in folder_names(spark, path)):
        return 0
    touched = stored(spark, path).filter(F.col(MONTH).isin(months))
    survivors = touched.join(gone, [*keys, MONTH], "left_anti").select(*touched.columns)
    with staged(survivors) as kept:
        deleted = touched.count() - kept.count()
        left = _months(kept)
        if deleted:
            _replace_months(kept, path, cluster)
            for month in set(months) - set(left):
                remove_folder(spark, f"{path}/{MONTH}={month}")
    return deleted
