"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

1. One pass in Python tasks gives each document the size of its shingle set, a
   128-bit fingerprint of the set, and the band keys of its signature.
2. Documents of equal sets become one class, so copies cost one row from here on.
3. Within each band bucket, members are paired with the bucket's smallest id, not
   with each other. Pairs are verified on full shingle sets and joined into
   components.
4. Where a bucket still holds several components, its members meet again in finer
   buckets, of pairs of bands, each with a hub of its own: there the members agree in
   twice as many slots, so a hub is likely linked to all that are linked at all. Turns
   over different pairs of bands go on until two in a row find no new link. Every turn
   compares a member with one hub a bucket, so work stays in proportion to the members.
5. Documents of buckets that hold several components even then go through an exact
   prefix join, which finds every link that is left between two components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .piece_bpe import parts
from .prefix_join import candidates
from .shingles import mixed, shingle_sets
from .staging import components, drop_staged, staged, staged_count

_LOW = np.uint64(0xFFFFFFFF)


def superminhash(sets: list[np.ndarray], slots: int = 128) -> np.ndarray:
    """Signatures of non-empty sets, one row each.

    Every element walks a random permutation of the slots, one slot a step, and
    brings to its step-j slot the value j plus a random fraction; slots keep the
    smallest. The permutations make an element's slots exclude each other, which
    lowers the variance. A set stops as soon as its largest value cannot fall any
    more: large sets need one step. All sets of a batch take each step together.
    """
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), lengths)
    element = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    values = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = values.reshape(-1)
    order: np.ndarray | None = None
    for step in range(slots):
        draw = mixed(element + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = step + ((draw >> np.uint64(32)) % np.uint64(slots - step)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            rows = np.arange(len(element))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, step]
            order[:, step] = slot
        np.minimum.at(flat, owner * slots + slot, np.uint64(step << 32) | (draw & _LOW))
        going = values.max(1) >= np.uint64((step + 1) << 32)
        if not going.any():
            break
        kept = going[owner]
        if order is None:
            pick = pick[kept]
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(pick), 1))
            rows = np.arange(len(pick))
            order[rows, pick], order[:, 0] = 0, pick
        elif not kept.all():
            order = order[kept]
        element, owner = element[kept], owner[kept]
    return values


def band_keys(values: np.ndarray, rows: int = 4) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` slots; the band's number is part of it."""
    count, slots = values.shape
    bands = slots // rows
    cut = values[:, : bands * rows].reshape(count, bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    key = np.repeat(key, count, 0)
    for k in range(rows):
        key = mixed(key + cut[:, :, k] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return key.view(np.int64)


SIGNED = "id long, n_shingles long, set_id binary, bands array<long>"


def signatures(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, slots: int = 128, rows: int = 4
) -> DataFrame:
    """id, n_shingles, set_id (fingerprint of the shingle set) and bands of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text", 2 << 20):
                sets = shingle_sets(batch["text"].to_pylist(), size)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(superminhash(full, slots), rows)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    ],
                    ["id", "n_shingles", "set_id", "bands"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets are as similar as ``percent``.

    Both texts are joined to the pair; a hub's text travels once per member, so a
    hub never gathers its members, and the join splits it where it is skewed.
    """
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    # The small column comes along first, the hub's text last.
    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub_text, hub = None, np.empty(0, np.uint64)
        for whole in batches:
            for batch in parts(whole, "b_text"):
                a_texts = batch["a_text"].to_pylist()
                keep = []
                for a_text, other in zip(a_texts, shingle_sets(batch["b_text"].to_pylist(), size), strict=True):
                    if a_text != hub_text:
                        hub_text, hub = a_text, shingle_sets([a_text], size)[0]
                    common = len(np.intersect1d(hub, other, assume_unique=True))
                    union = len(hub) + len(other) - common
                    keep.append(union > 0 and 100 * common >= percent * union)
                chosen = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
                yield chosen

    return joined.mapInArrow(run, "a long, b long")


def finer_keys(banded: DataFrame, shifts: tuple[int, ...]) -> DataFrame:
    """One ``key`` in place of ``bands`` for each pair of bands (i, i + shift): documents that
    share it agree in twice as many slots."""

    def shifted(d: int) -> Column:
        other = lambda i: F.get(F.col("bands"), (i + d) % F.size("bands"))
        return F.transform("bands", lambda key, i: F.xxhash64(key, other(i), i, F.lit(d)))

    pairs = [shifted(d) for d in shifts]
    return banded.withColumn("key", F.explode(F.array_distinct(F.flatten(F.array(*pairs))))).drop("bands")


def shingle_rows(texts: DataFrame, size: int) -> DataFrame:
    """(id, s): one row for each distinct shingle of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                sets = shingle_sets(batch["text"].to_pylist(), size)
                ids = np.repeat(np.array(batch["id"].to_pylist(), np.int64), [len(s) for s in sets])
                flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
                for start in range(0, len(ids), 1 << 18):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[start : start + (1 << 18)]), pa.array(flat[start : start + (1 << 18)])], ["id", "s"]
                    )

    return texts.select("id", "text").mapInArrow(run, "id long, s long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 75,
    slots: int = 128,
    rows: int = 4,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents whose shingle sets have ``percent`` of their union in common are
    linked; component_id is the smallest id that links reach. With 32 bands of 4
    slots a link at 0.75 shares a bucket with probability above 0.99999.

    Null and empty texts and texts of white space have n_shingles 0 and stand
    alone. Rows without an id stand alone too: component_id null, kept true. Rows
    of one id count as one document: they share a component. Other columns of
    ``docs`` are not read.
    """
    signed = staged(signatures(docs, id_col, text, size, slots, rows), "signatures")
    classes = staged(
        signed.where("set_id IS NOT NULL AND id IS NOT NULL").groupBy("set_id").agg(F.min("id").alias("rep")), "classes"
    )
    heads = signed.join(classes, (signed["set_id"] == classes["set_id"]) & (signed["id"] == classes["rep"]), "left_semi")
    banded = staged(
        heads.dropDuplicates(["id", "set_id"]).select("id", "n_shingles", F.explode("bands").alias("key")), "bands"
    )
    shared = staged(
        banded.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high"), "buckets"
    )
    held = staged(banded.join(shared, "key"), "members")
    drop_staged(banded)
    ids = held.select("id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    texts = staged(texts.dropDuplicates(), "texts")
    sizes = held.select("id", "n_shingles").distinct()

    def near_in_size(pairs: DataFrame) -> DataFrame:
        a = sizes.select(F.col("id").alias("a"), F.col("n_shingles").alias("a_n"))
        b = sizes.select(F.col("id").alias("b"), F.col("n_shingles").alias("b_n"))
        return pairs.join(a, "a").join(b, "b").where(
            100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
        ).select("a", "b").distinct()

    tried = staged(
        near_in_size(held.where("id != low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()), "pairs"
    )
    grouped = staged(components(verified(tried, texts, size, percent)), "components")

    def joined(more: DataFrame) -> DataFrame:
        """Components after further links."""
        stars = grouped.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        return staged(components(stars.union(more)), "components")

    def in_mixed_buckets(members: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with their component."""
        now = members.join(grouped, "id", "left").withColumn("component", F.coalesce("component", "id"))
        span = now.groupBy("key").agg(
            F.min("component").alias("c0"), F.max("component").alias("c1")
        ).where("c0 != c1")
        return now.join(span.select("key"), "key", "left_semi")

    # Buckets of more than one component: their members meet in finer buckets.
    open_members = staged(in_mixed_buckets(held.select("key", "id")).select("id").distinct(), "open")
    open_heads = heads.join(open_members, "id", "left_semi").select("id", "n_shingles", "bands")
    # Sizes come along with the members, so that no pair is joined with them: the smallest
    # and the largest, where rows of one id differ.
    spans = open_heads.groupBy("id").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    open_bands = staged(open_heads.select("id", "bands").distinct().join(spans, "id"), "open-bands")
    shifts = list(range(1, slots // rows // 2 + 1))
    idle = 0
    for turn in range(0, len(shifts), 2):
        labelled = open_bands.join(grouped, "id", "left").withColumn("component", F.coalesce("component", "id"))
        fine = finer_keys(labelled, tuple(shifts[turn : turn + 2]))
        # The hub is of the bucket's smallest component, in the next turn of its largest.
        pick = F.min_by if turn % 4 == 0 else F.max_by
        hubs = fine.groupBy("key").agg(
            F.min("component").alias("c0"), F.max("component").alias("c1"),
            pick(F.struct("id", "low", "high"), "component").alias("hub"),
            (F.min if turn % 4 == 0 else F.max)("component").alias("hub_component"),
        ).where("c0 != c1").select("key", "hub", "hub_component")
        pairs = fine.join(hubs, "key").where("component != hub_component").where(
            (100 * F.col("high") >= percent * F.col("hub.low")) & (100 * F.col("hub.high") >= percent * F.col("low"))
        ).select(F.least("hub.id", "id").alias("a"), F.greatest("hub.id", "id").alias("b")).distinct()
        fresh = staged(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more, n = staged_count(verified(fresh, texts, size, percent), "links")
        tried = staged(tried.union(fresh), "tried")
        idle = 0 if n else idle + 1
        if n:
            grouped = joined(more)
        if idle == 2:
            break

    # What is left: every link between components among documents of mixed buckets.
    rest, n = staged_count(in_mixed_buckets(held.select("key", "id")).select("id", "component").distinct(), "rest")
    if n:
        rest_texts = texts.join(rest.select("id"), "id", "left_semi")
        last = candidates(shingle_rows(rest_texts, size), rest, percent).join(tried, ["a", "b"], "left_anti")
        more, n = staged_count(verified(staged(last, "pairs"), texts, size, percent), "links")
        if n:
            grouped = joined(more)

    placed = classes.join(grouped, classes["rep"] == grouped["id"], "left").select(
        "set_id", F.coalesce("component", "rep").alias("component_id")
    )
    return signed.join(placed, "set_id", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
