"""Upserts, deletes and schema changes as DataFrame plans.

Open-source Spark has no MERGE for Parquet tables, so a merge is planned as one
DataFrame: every resulting row with an ``_action`` (insert, update, delete,
keep). The same plan yields the new table and the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..schemas import AUDIT_COLUMNS
from .joins import lookup_join
from .sets import union_all

INSERT, UPDATE, DELETE, KEEP = "insert", "update", "delete", "keep"


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source, failing the job at the second row of any key.

    The numbering streams over the exchange and sort the merge join on the same
    keys needs anyway; a repeated key stops it at once.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(F.lit("duplicate merge key: "), F.to_json(F.struct(*keys)))
    unique = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return source.withColumn("_n", number).filter(unique).drop("_n")


def changed(columns: Sequence[str], left: str = "_t", right: str = "_s") -> Column:
    """Whether any of the columns differs between two structs, NULL-safely."""
    expr = F.lit(False)
    for c in columns:
        expr = expr | ~F.col(left)[c].eqNullSafe(F.col(right)[c])
    return expr


def paired(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer pairing on the keys as structs ``_t`` and ``_s``.

    One exchange per side on the same keys; adaptive execution splits none of a full
    outer join's keys, but a key has one source row, and one target row in a table
    that merges keep.
    """
    keys = list(keys)
    t = target.select(*keys, F.struct(*target.columns).alias("_t"))
    s = source.select(*keys, F.struct(*source.columns).alias("_s"))
    return t.join(s, keys, "full_outer")


def merge_plan(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    audit_columns: Sequence[str] = AUDIT_COLUMNS,
    update: str = "changed",
    retained: DataFrame | None = None,
    checked: bool = True,
    absent: str = KEEP,
) -> DataFrame:
    """Rows of the merged table with their ``_action``.

    update="changed" rewrites a matched row only if a column other than keys
    and audit columns differs, and then all its columns; "always" rewrites every
    matched row. With ``retained`` (a frame of keys), target rows absent from
    the source are deleted unless retained; an empty source deletes nothing. Without,
    ``absent`` is their action; DELETE makes the table the source, even an empty one.
    """
    keys = list(keys)
    if update not in ("changed", "always"):
        raise ValueError(f"unknown update mode: {update}")
    if retained is not None and len(keys) != 1:
        raise ValueError("deleting unmatched rows needs a single key column")
    columns = target.columns
    source = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in columns])
    pairs = paired(target, unique_source(source, keys) if checked else source, keys)

    tracked = [c for c in columns if c not in keys and c not in audit_columns]
    update_when = F.lit(True) if update == "always" else changed(tracked)
    unmatched = F.lit(absent)
    if retained is not None:
        kept = retained.select(*keys).distinct().withColumn("_retained", F.lit(True))
        pairs = lookup_join(pairs, kept, keys)
        some_source = source.select(F.count(F.lit(1))).scalar() > 0
        unmatched = F.when(F.col("_retained").isNull() & some_source, DELETE).otherwise(KEEP)
    action = (
        F.when(F.col("_t").isNull(), INSERT)
        .when(F.col("_s").isNull(), unmatched)
        .when(update_when, UPDATE)
        .otherwise(KEEP)
    )
    row = F.when(F.col("_action").isin(INSERT, UPDATE), F.col("_s")).otherwise(F.col("_t"))
    return pairs.select(action.alias("_action"), "_t", "_s").select(
        *[row[c].alias(c) for c in columns], "_action"
    )


def merge_apply(plan: DataFrame) -> DataFrame:
    """The new target."""
    return plan.filter(F.col("_action") != DELETE).drop("_action")


def merge_counts(plan: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted and their sum; zero when nothing is new."""

    def n(action: str, name: str) -> Column:
        return F.count_if(F.col("_action") == action).alias(name)

    counted = plan.agg(n(INSERT, "inserted"), n(UPDATE, "updated"), n(DELETE, "deleted"))
    return counted.withColumn("rows_changed", F.col("inserted") + F.col("updated") + F.col("deleted"))


def unconfigured(target: DataFrame, allowed: DataFrame, key: str = "series_code") -> DataFrame:
    """The rows prune would drop."""
    keys = allowed.select(key).distinct()
    if keys.isEmpty():
        raise ValueError("refusing to prune: nothing is configured")
    return lookup_join(target, keys, key, "left_anti")


def prune(target: DataFrame, allowed: DataFrame, key: str = "series_code") -> DataFrame:
    """Target rows whose key is still configured; refuses an empty configuration."""
    keys = allowed.select(key).distinct()
    if keys.isEmpty():
        raise ValueError("refusing to prune: nothing is configured")
    return lookup_join(target, keys, key, "left_semi")


def _live_keys(staging: DataFrame, dim_series: DataFrame, day: str) -> DataFrame:
    return lookup_join(
        staging.filter(F.col("value").isNotNull()).select("series_code", day),
        dim_series.select("series_code", "series_key"),
        "series_code",
        "inner",
    ).select("series_key", day)


def delete_stale(
    fact: DataFrame,
    staging: DataFrame,
    dim_series: DataFrame,
    day: str = "observation_date",
) -> DataFrame:
    """Fact rows that still have a non-null staging observation."""
    live = _live_keys(staging, dim_series, day)
    return fact.join(live, ["series_key", day], "left_semi").select(*fact.columns)


def stale_rows(
    fact: DataFrame,
    staging: DataFrame,
    dim_series: DataFrame,
    day: str = "observation_date",
) -> DataFrame:
    """Fact rows without one: the complement of delete_stale."""
    live = _live_keys(staging, dim_series, day)
    return fact.join(live, ["series_key", day], "left_anti").select(*fact.columns)


def differing_months(
    fact: DataFrame,
    staging: DataFrame,
    dim_series: DataFrame,
    day: str = "observation_date",
) -> DataFrame:
    """Months (yyyy-MM) whose fact keys are not those staging calls for.

    Keys are counted and hashed per month on either side, combined before the
    shuffle; a month's key sets are equal where both agree.
    """
    live = _live_keys(staging, dim_series, day)

    def digest(keys: DataFrame, name: str) -> DataFrame:
        return keys.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(
            F.struct(
                F.count(F.lit(1)).alias("n"), F.expr(f"bit_xor(xxhash64(series_key, {day}))").alias("h")
            ).alias(name)
        )

    both = digest(fact, "_fact").join(digest(live, "_live"), "month", "full_outer")
    return both.filter(~F.col("_fact").eqNullSafe(F.col("_live"))).select("month")


def upsert_columns(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] = (),
) -> DataFrame:
    """Insert missing rows; overwrite only the listed columns of present ones.

    The source may carry fewer columns than the target; new rows get NULL there.
    """
    keys = list(keys)
    unknown = [c for c in update_columns if c not in source.columns]
    if unknown:
        raise ValueError(f"update columns missing from the source: {unknown}")
    pairs = paired(target, unique_source(source, keys), keys)
    out = []
    for c in target.columns:
        dtype = target.schema[c].dataType
        new = F.col("_s")[c].cast(dtype) if c in source.columns else F.lit(None).cast(dtype)
        old = F.col("_t")[c]
        if c in update_columns:
            present = F.when(F.col("_s").isNotNull(), new).otherwise(old)
        else:
            present = old
        out.append(F.when(F.col("_t").isNull(), new).otherwise(present).alias(c))
    return pairs.select(*out)


def evolve(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """Append the schema's missing columns as NULL, at the end; also their names."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    added = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    return added, [f.name for f in missing]


def backfill(df: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    """Fill NULLs of each column with its expression over the old row."""
    filled = [
        F.coalesce(F.col(c), expressions[c].cast(df.schema[c].dataType)).alias(c)
        if c in expressions
        else F.col(c)
        for c in df.columns
    ]
    return df.select(*filled)


def backfill_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows a backfill of these columns touches."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count_if(any_null).alias("rows_updated"))


def register_runs(
    runs: DataFrame,
    first_seen: DataFrame,
    source: str,
    pipeline: str,
    target_table: str,
) -> DataFrame:
    """The run table plus an 'unknown' row for each run it lacked."""
    legacy = first_seen.select(
        "run_id",
        F.lit(source).alias("source"),
        F.lit(pipeline).alias("pipeline"),
        F.lit(target_table).alias("target_table"),
        F.lit("unknown").alias("status"),
        "started_at",
    )
    return union_all([runs, legacy], allow_missing=True)


def needs_rebuild(
    steps: DataFrame,
    by: str,
    forced: bool = False,
    stale: bool = False,
) -> DataFrame:
    """Whether the marts must be rebuilt: forced, changed, unknown or stale."""
    total = F.when(F.count_if(F.col("rows_changed").isNull()) == 0, F.sum("rows_changed"))
    rolled = steps.groupBy(by).agg(total.cast("long").alias("rows_changed"))
    needed = F.lit(forced or stale) | F.col("rows_changed").isNull() | (F.col("rows_changed") > 0)
    return rolled.withColumn("needs_rebuild", needed)
