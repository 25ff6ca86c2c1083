"""As-of joins as one sorted stream, without a join on the key.

Rows and versions are put together and windowed per (key, time bucket): the version
that started last is carried forward to the rows behind it. What a bucket takes over
from earlier ones comes from an edge table with the last version of each key and
bucket that starts one; it enters the stream as a version at the bucket's start. So a
key costs its rows plus its versions, and no task holds more than one bucket of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

FOREVER = "9999-12-31 23:59:59.999999"


def as_of_join(
    rows: DataFrame,
    history: DataFrame,
    key: Sequence[str] | str,
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    bucket: str = "month",
) -> DataFrame:
    """Attach the version of ``history`` valid at each row's ``at`` instant.

    Validity is [valid_from, valid_to); a NULL valid_to means still current. Versions
    that end before they start are never valid. Versions of a key must not overlap
    otherwise (``windows.version_overlaps`` finds those that do): the one that started
    last counts, of several the one that ends last. ``how`` is left or inner. NULL keys
    and instants match nothing; their rows are dealt out by their other columns.
    ``bucket`` is the unit of time by which a key's rows are dealt out, as in date_trunc.
    """
    keys = [key] if isinstance(key, str) else list(key)
    added = [c for c in history.columns if c not in keys]
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported as-of join: {how}")
    if clash := set(added) & set(rows.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    instant, start = F.col(at).cast("timestamp"), F.col(valid_from).cast("timestamp")
    until = F.coalesce(F.col(valid_to).cast("timestamp"), F.lit(FOREVER).cast("timestamp"))
    known = [F.col(k).cast(rows.schema[k].dataType).alias(k) for k in keys]

    starts = start.alias("_time"), until.alias("_until"), F.struct(*added).alias("_version")
    versions = (
        history.filter(_all_set(keys) & start.isNotNull() & (until > start))
        .select(*known, F.date_trunc(bucket, start).alias("_bucket"), *starts)
    )
    dated = rows.filter(_all_set(keys) & instant.isNotNull())
    occupied = dated.select(*keys, F.date_trunc(bucket, instant).alias("_bucket")).distinct()
    carried = _carried(occupied, versions, keys)

    # Rows that match nothing get a bucket of their own by a hash of what they hold.
    hashable = [c for c in rows.columns if not isinstance(rows.schema[c].dataType, (T.MapType, T.VariantType))]
    lost = F.when(_all_set(keys) & instant.isNotNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(*hashable))

    def part(spread: Column, time: Column) -> Column:
        return F.struct(*keys, F.date_trunc(bucket, time).alias("_bucket"), spread.alias("_spread")).alias("_part")

    none = F.lit(None)
    version_type = T.StructType([f for f in history.select(*added).schema.fields])
    row_type = T.StructType(rows.schema.fields)
    first = [
        frame.select(
            part(F.lit(0).cast("long"), F.col("_time")), "_time", F.lit(kind).alias("_kind"), "_until",
            none.cast(row_type).alias("_row"), F.struct(F.col("_until").alias("until"), F.col("_version").alias("held")).alias("_start"),
        )
        for kind, frame in ((0, carried), (1, versions))
    ]
    start_type = T.StructType([T.StructField("until", T.TimestampType()), T.StructField("held", version_type)])
    last = rows.select(
        part(lost, instant), instant.alias("_time"), F.lit(2).alias("_kind"), none.cast("timestamp").alias("_until"),
        F.struct(*rows.columns).alias("_row"), none.cast(start_type).alias("_start"),
    )
    stream = first[0].unionByName(first[1]).unionByName(last).repartition("_part").withColumn("_hash", F.xxhash64("_part"))
    order = Window.partitionBy("_hash", "_part").orderBy("_time", "_kind", "_until")
    found = stream.withColumn("_found", F.last("_start", ignorenulls=True).over(order)).filter("_kind = 2")
    holds = (F.col("_part._spread") == 0) & (F.col("_time") < F.col("_found.until"))
    joined = found.withColumn("_found", F.when(holds, F.col("_found")))
    if how == "inner":
        joined = joined.filter("_found IS NOT NULL")
    return joined.select(
        *[F.col("_row")[c].alias(c) for c in rows.columns], *[F.col("_found.held")[c].alias(c) for c in added]
    )


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _carried(occupied: DataFrame, versions: DataFrame, keys: list[str]) -> DataFrame:
    """For each (keys, bucket) of rows, the last version that started in an earlier bucket
    and still holds at the start of this one. One row a key and bucket is windowed."""
    held = F.struct("_time", "_until", "_version")
    edges = versions.groupBy(*keys, "_bucket").agg(F.max_by(held, F.struct("_time", "_until")).alias("_edge"))
    both = edges.withColumn("_wanted", F.lit(False)).unionByName(
        occupied.withColumns({"_edge": F.lit(None).cast(edges.schema["_edge"].dataType), "_wanted": F.lit(True)})
    )
    line = both.groupBy(*keys, "_bucket").agg(F.any_value("_edge", True).alias("_edge"), F.max("_wanted").alias("_wanted"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    taken = line.withColumn("_before", F.last("_edge", ignorenulls=True).over(before))
    return taken.filter(F.col("_wanted") & (F.col("_before._until") > F.col("_bucket"))).select(
        *keys, "_bucket", F.col("_bucket").alias("_time"), F.col("_before._until").alias("_until"), F.col("_before._version").alias("_version")
    )
