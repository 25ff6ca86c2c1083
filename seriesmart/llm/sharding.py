"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 13 hexadecimal digits of a digest: 52 bits, exact in a double.
_BITS = 52


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard of each key: the one of largest ``-weight / ln(u)``, where u in (0, 1)
    comes from a digest of key and shard number; ties go to the smaller shard.

    A key's scores do not depend on the other shards. One more shard therefore takes
    keys only into itself, a lost one gives up only its own, and a changed weight
    moves keys only to or from that shard. A shard's share is its weight's share.
    Null keys count as one key, which differs from every text.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("Shards need weights above 0.")
    text = F.coalesce(key.cast("string"), F.lit("\x00null"))
    scores = []
    for shard, weight in enumerate(weights):
        digest = F.substring(F.md5(F.concat(text, F.lit(f":{shard}"))), 1, 13)
        u = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << _BITS)
        scores.append(F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("negative")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["negative"]).cast("int")


def moved(keys: DataFrame, key: str, before: list[float], after: list[float]) -> DataFrame:
    """Keys whose shard differs between two sets of weights: key, old_shard, new_shard."""
    return (
        keys.select(F.col(key), shard_of(F.col(key), before).alias("old_shard"), shard_of(F.col(key), after).alias("new_shard"))
        .where("old_shard != new_shard")
    )
