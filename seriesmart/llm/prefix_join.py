"""Exact candidates for set similarity: the prefix filter with positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .staging import staged

#: Holders of one element that meet in a task; an element of more is salted.
BLOCK = 1_000


def candidates(grams: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different components: every one whose sets have
    ``percent`` of their union in common, and some that have less.

    ``grams`` holds (id, s), one row for each element of a set; ``groups`` holds (id,
    component). Elements are put in one order, the rarest first. Sets that are similar
    share one of their first ``n - ceil(n * percent / 100) + 1`` elements, and the first
    shared one leaves room for enough common elements behind it. An element of many
    sets is cut into blocks: a set of the one side meets one block of the other.
    """
    grams = staged(grams, "grams")
    often = staged(grams.groupBy("s").agg(F.count("*").alias("f")).where("f > 1"), "often")
    own = Window.partitionBy("id")
    ranked = grams.join(often, "s", "left").select(
        "id", "s", F.coalesce("f", F.lit(1)).alias("f"),
        F.row_number().over(own.orderBy(F.coalesce("f", F.lit(1)), "s")).alias("r"),
        F.count("*").over(own).alias("n"),
    )
    # n * percent is an integer: no rounding decides where a prefix ends.
    marks = staged(
        ranked.where(f"f > 1 AND r <= n - (n * {percent} + 99) div 100 + 1").join(groups, "id")
        .withColumn("blocks", (F.ceil(F.col("f") / BLOCK)).cast("int")),
        "prefixes",
    )
    return _meeting(marks, percent)


def similar_prefixes(prefixes: DataFrame, percent: int) -> DataFrame:
    """``candidates`` from prefixes that were cut before: (id, s, component, r, n), r from 1,
    in any one order of elements."""
    often = prefixes.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
    marks = prefixes.join(often, "s").withColumn("blocks", F.ceil(F.col("f") / BLOCK).cast("int"))
    return _meeting(marks, percent)


def _meeting(marks: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share an element and may be similar enough."""
    left = marks.select(
        F.col("id").alias("a"), "s", F.col("component").alias("ca"), F.col("n").alias("na"), F.col("r").alias("ra"),
        F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
    )
    right = marks.select(
        F.col("id").alias("b"), "s", F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("r").alias("rb"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    similar = F.expr(
        f"a < b AND ca != cb AND 100 * least(na, nb) >= {percent} * greatest(na, nb)"
        f" AND {100 + percent} * (least(na - ra, nb - rb) + 1) >= {percent} * (na + nb)"
    )
    return left.join(right, ["s", "block"]).where(similar).select("a", "b").distinct()
