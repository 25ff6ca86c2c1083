"""Type-2 history of slowly changing metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import lookup_join
from .merge import changed, unique_source


def scd_id(key: Column, at: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), at.cast("string")))


def empty_history(source: DataFrame) -> DataFrame:
    """A history without versions, typed after the source."""
    never = F.lit(None).cast("timestamp")
    return source.filter(F.lit(False)).select(
        "*",
        F.lit(None).cast("string").alias("scd_id"),
        never.alias("updated_at"),
        never.alias("valid_from"),
        never.alias("valid_to"),
    )


def snapshot(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check_columns: Sequence[str],
    as_of: Column,
    invalidate_deletes: bool = True,
) -> DataFrame:
    """History after seeing ``source`` at ``as_of``.

    A changed check column closes the current version and opens another; a
    vanished key closes its version; a new or returned key opens one. Columns
    outside ``check_columns`` are carried but do not open versions.
    """
    as_of = as_of.cast("timestamp")
    columns = source.columns
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())
    pairs = current.select(key, F.struct(*history.columns).alias("_t")).join(
        unique_source(source, [key]).select(key, F.struct(*columns).alias("_s")), key, "full_outer"
    )
    both = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    differs = both & changed(check_columns)
    vanished = F.col("_s").isNull()
    ends = differs | (vanished & F.lit(invalidate_deletes))
    starts = F.col("_t").isNull() | differs

    new_version = F.struct(
        *[F.col("_s")[c].alias(c) for c in columns],
        scd_id(F.col("_s")[key], as_of).alias("scd_id"),
        as_of.alias("updated_at"),
        as_of.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    old_version = F.struct(
        *[
            F.when(ends, as_of).otherwise(F.col("_t")[c]).alias(c)
            if c == "valid_to"
            else F.col("_t")[c].alias(c)
            for c in history.columns
        ]
    )
    versions = F.array_compact(
        F.array(F.when(F.col("_t").isNotNull(), old_version), F.when(starts, new_version))
    )
    touched = pairs.select(F.explode(versions).alias("_v")).select(
        *[F.col("_v")[c].alias(c) for c in history.columns]
    )
    return closed.unionByName(touched)


def _refused(columns: Sequence[str], why: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{why}: "), F.to_json(F.struct(*columns)))).cast("boolean")


def fold(
    loads: DataFrame,
    key: str,
    check_columns: Sequence[str],
    as_of: str = "as_of",
    instants: DataFrame | None = None,
    invalidate_deletes: bool = True,
) -> DataFrame:
    """The history after any number of whole loads, in one pass and in any order.

    ``loads`` holds the rows of all loads, each with the instant it was taken ``as_of``;
    ``instants`` (one column of that name) names the loads, for some may have no rows.
    The result equals ``snapshot`` of one load after the other by time: a version is an
    island of consecutive loads that hold the key with the same check columns, carries
    its first load's row, and ends at the load that follows. Without
    ``invalidate_deletes`` loads that lack the key do not end it. A key has a row a load,
    so a window over one is as long as there are loads. A NULL key or instant and a
    repeated key in a load fail the job.
    """
    columns = [c for c in loads.columns if c != as_of]
    dated = loads.withColumn("_at", F.col(as_of).cast("timestamp"))
    taken = (dated.select("_at") if instants is None else instants.select(F.col(as_of).cast("timestamp").alias("_at"))).distinct()
    # One row a load.
    order = Window.orderBy("_at")
    ledger = taken.withColumns({"_before": F.lag("_at").over(order), "_after": F.lead("_at").over(order), "_known": F.lit(True)})
    missing = F.col(key).isNull() | F.col("_at").isNull()
    whole = dated.filter(F.when(missing, _refused([key, "_at"], "NULL in snapshot")).otherwise(True))
    rows = lookup_join(whole, ledger, "_at", "left")
    rows = rows.filter(F.when(F.col("_known").isNull(), _refused(["_at"], "load not among the instants")).otherwise(True))

    by_time = Window.partitionBy(key).orderBy("_at")
    state = F.struct(*check_columns)
    rows = rows.withColumns({"_last_at": F.lag("_at").over(by_time), "_last_state": F.lag(state).over(by_time)})
    repeated = F.col("_last_at") == F.col("_at")
    rows = rows.filter(F.when(repeated, _refused([key, "_at"], "duplicate key in snapshot")).otherwise(True))
    starts = F.col("_last_at").isNull() | ~F.col("_last_state").eqNullSafe(state)
    if invalidate_deletes:
        starts = starts | ~F.col("_last_at").eqNullSafe(F.col("_before"))
    islands = rows.withColumn("_start", starts).withColumn("_island", F.sum(F.col("_start").cast("int")).over(by_time))
    versions = islands.groupBy(key, "_island").agg(
        F.min_by(F.struct(*columns), "_at").alias("_row"), F.min("_at").alias("_from"), F.max_by(F.struct("_after"), "_at").alias("_to")
    )
    if invalidate_deletes:
        end = F.col("_to._after")
    else:
        end = F.lead("_from").over(Window.partitionBy(key).orderBy("_island"))
    return versions.withColumn("_end", end).select(
        *[F.col("_row")[c].alias(c) for c in columns],
        scd_id(F.col(key), F.col("_from")).alias("scd_id"),
        F.col("_from").alias("updated_at"),
        F.col("_from").alias("valid_from"),
        F.col("_end").alias("valid_to"),
    )


def insert_load(
    history: DataFrame,
    instants: DataFrame,
    load: DataFrame,
    key: str,
    check_columns: Sequence[str],
    as_of: Column,
) -> DataFrame:
    """The history with one more whole load, taken ``as_of`` some instant in the past.

    ``instants`` (one column) names the loads the history was made of. Only versions
    that hold then, or start at the load after, are paired with the load; others stay as
    they are. A held version that the load does not confirm ends there and opens again at
    the load after, if that one saw it; a new state lasts until the load after, and runs
    on into a version that starts there with the same check columns. The result equals
    ``fold`` of all loads, but that a version opened again carries, outside the check
    columns, what the version it was cut from carried.
    """
    at = as_of.cast("timestamp")
    column = F.col(instants.columns[0]).cast("timestamp")
    near = instants.agg(
        F.min(F.when(column > at, column)).alias("after"), F.coalesce(F.max(column == at), F.lit(False)).alias("taken"),
    ).head()
    if near["taken"]:
        raise ValueError("A load of that instant is part of the history.")
    after = F.lit(near["after"]).cast("timestamp")
    columns = load.columns
    ends = F.coalesce(F.col("valid_to") > at, F.lit(True))
    holds = (F.col("valid_from") < at) & ends
    follows = F.coalesce(F.col("valid_from") == after, F.lit(False))
    untouched = history.filter(~(holds | follows))
    version = F.struct(*history.columns)
    # A key has at most one version that holds and one that follows.
    touched = history.filter(holds | follows).groupBy(key).agg(
        F.max(F.when(holds, version)).alias("_held"), F.max(F.when(follows, version)).alias("_next")
    )
    new = unique_source(load, [key]).select(key, F.struct(*columns).alias("_new"))
    both = touched.join(new, key, "full_outer")

    def differs(a: str, b: str) -> Column:
        return F.col(a).isNull() | F.col(b).isNull() | changed(check_columns, a, b)

    def made(source: str, start: Column, end: Column) -> Column:
        fixed = {
            "scd_id": scd_id(F.col(source)[key], start), "updated_at": start, "valid_from": start, "valid_to": end
        }
        return F.struct(*[(fixed[c] if c in fixed else F.col(source)[c]).alias(c) for c in history.columns])

    cut = F.col("_held").isNotNull() & differs("_held", "_new")
    ended = F.struct(*[(at if c == "valid_to" else F.col("_held")[c]).alias(c) for c in history.columns])
    held = F.when(cut, ended).otherwise(F.col("_held"))
    # The load after saw the held version too if that lasts longer.
    lasts = F.lit(near["after"] is not None) & F.coalesce(F.col("_held.valid_to") > after, F.lit(True))
    again = F.when(cut & lasts, made("_held", after, F.col("_held.valid_to")))
    fresh = F.col("_new").isNotNull() & (F.col("_held").isNull() | cut)
    runs_on = fresh & ~differs("_new", "_next")
    following = F.when(runs_on, F.lit(None)).otherwise(F.col("_next"))
    opened = F.when(fresh, made("_new", at, F.when(runs_on, F.col("_next.valid_to")).otherwise(after)))
    listed = F.array_compact(F.array(held, again, opened, following))
    changed_rows = both.select(F.explode(listed).alias("_v")).select(*[F.col("_v")[c].alias(c) for c in history.columns])
    return untouched.unionByName(changed_rows)
