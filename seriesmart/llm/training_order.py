"""Token ids in training order: fixed-stride binary shards.

Texts become 16-bit ids (32-bit for larger vocabularies), each with an end id. All
ids form one stream that is cut into sequences of equal length. A keyed Feistel
permutation gives every sequence its slot in training order; ranges of slots are
shards. A shard file is a row of records of equal size, so slot s is found by
arithmetic and a reader resumes anywhere.

Layout below the target path: ``shard=N/part-*.txt`` with records of
``seq_len * width + 2`` bytes, the ids little-endian and two closing bytes, and
``_manifest`` (one row of Parquet) with the parameters a reader needs.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .piece_bpe import parts
from .shingles import mixed
from .staging import settings, staged

CLOSING = "\r\n"
ROUNDS = 6
#: Turns in which shards are written. The pieces of one turn's shards are shuffled at a time,
#: so that disk holds the ids twice and a part of them, not three times.
TURNS = 2


class RankCoder:
    """Byte-level BPE ids as raw little-endian bytes. Texts are encoded whole: most words of
    a corpus are rare, and looking each up in a cache takes longer."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.kind = np.dtype("<u2") if self.end < 1 << 16 else np.dtype("<u4")

    def raw(self, text: str) -> bytes:
        return np.array(self.coding.encode_ordinary(text), self.kind).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text and the end id; a null text gives the end id alone."""
        return (self.raw(text) if text else b"") + self.end.to_bytes(self.kind.itemsize, "little")


@lru_cache(maxsize=2)
def rank_coder(ranks_path: str, pattern: str) -> RankCoder:
    """One coder a Python worker."""
    return RankCoder(ranks_path, pattern)


def feistel(index: np.ndarray, count: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. count-1, each number on its own.

    Six Feistel rounds permute the smallest even-bit domain that holds ``count``;
    numbers that land outside walk on along their cycle until they are inside.
    """
    half = max(1, ((max(count - 1, 1)).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    secrets = [mixed(np.array([(key + r * 0x9E3779B97F4A7C15) & (2**64 - 1)], np.uint64)) for r in range(1, ROUNDS + 1)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for secret in secrets[::-1] if inverse else secrets:
            if inverse:
                left, right = right ^ (mixed(left + secret) & low), left
            else:
                left, right = right, left ^ (mixed(right + secret) & low)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    outside = np.flatnonzero(out >= np.uint64(count))
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= np.uint64(count)]
    return out.astype(np.int64)


def permuted(index: Column, count: int, key: int, inverse: bool = False) -> Column:
    """``feistel`` of a column, by Arrow batches."""

    @F.arrow_udf("long")
    def slot(x: pa.Array) -> pa.Array:
        return pa.array(feistel(x.to_numpy(zero_copy_only=False), count, key, inverse))

    return slot(index)


def token_stream(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (raw bytes), part and start: the place of a text's first id in its part.

    A part is one input partition; a task counts along as it encodes, so no shuffle
    is needed to place the ids, and a task that is run again gives the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = rank_coder(ranks_path, pattern), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in parts(whole, "text"):
                raw = [coder.encode(t) for t in batch["text"].to_pylist()]
                lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // coder.kind.itemsize
                starts = at + np.cumsum(lengths) - lengths
                at += int(lengths.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(raw, pa.binary()), pa.array(np.full(len(raw), part)), pa.array(starts), pa.array(lengths)],
                    ["doc_id", "ids", "part", "start", "n"],
                )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "doc_id long, ids binary, part long, start long, n long")


def materialise(
    docs: DataFrame,
    path: str,
    ranks_path: str,
    pattern: str,
    seq_len: int = 1024,
    rows_per_shard: int = 4096,
    key: int = 20_240_601,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write the shards below ``path``; returns which part of which text stands where:
    doc_id, seq, slot, shard, place (first id within the sequence), n (ids).

    Null and empty texts put only their end id into the stream; rows without an id
    are written too. The last sequence is filled with end ids. An empty table
    writes no shard. Other columns are not read. Texts, and so pieces, are spread by
    sequence: neither a long text nor a hot id meets in one task. Shards are written in
    ``TURNS`` turns, the manifest last: without it the shards are not whole.
    """
    spark = docs.sparkSession
    coder = rank_coder(ranks_path, pattern)
    width = coder.kind.itemsize
    stream = staged(token_stream(docs, ranks_path, pattern, id_col, text), "tokens", "zstd")
    # One row per input partition: sums on the driver stay small at any size of the table.
    totals = {r["part"]: r["n"] for r in stream.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    offsets, at = [], 0
    for part in sorted(totals):
        offsets.append((part, at))
        at += totals[part]
    count = -(-at // seq_len)
    if not count:
        return spark.createDataFrame([], "doc_id long, seq long, slot long, shard long, place int, n int")
    placed = stream.join(F.broadcast(spark.createDataFrame(offsets, "part long, offset long")), "part").select(
        "doc_id", "ids", "n", (F.col("start") + F.col("offset")).alias("first")
    )
    span = F.sequence(F.floor(F.col("first") / seq_len), F.floor((F.col("first") + F.col("n") - 1) / seq_len))
    begin = F.greatest(F.col("first"), F.col("seq") * seq_len)
    finish = F.least(F.col("first") + F.col("n"), (F.col("seq") + 1) * seq_len)
    pieces = (
        placed.withColumn("seq", F.explode(span))
        .withColumn("slot", permuted(F.col("seq"), count, key))
        .withColumn("shard", F.floor(F.col("slot") / rows_per_shard))
        .withColumn("place", (begin - F.col("seq") * seq_len).cast("int"))
        .withColumn("n", (finish - begin).cast("int"))
    )
    offset = (F.col("seq") * seq_len + F.col("place") - F.col("first")) * width + 1
    filler = bytes(np.array([coder.end], coder.kind).tobytes() * seq_len)
    shards = -(-count // rows_per_shard)
    body = F.expr("aggregate(held, cast('' AS binary), (acc, x) -> acc || x.ids)")
    record = F.substring(F.concat(body, F.lit(filler)), 1, seq_len * width).cast("string")
    turns = min(TURNS, shards)
    # Else the files of a turn's shuffle stay until the driver collects garbage.
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        for turn in range(turns):
            mine = pieces.where(F.col("shard") % turns == turn).select(
                "shard", "slot", "place", F.substring(F.col("ids"), offset.cast("int"), F.col("n") * width).alias("ids")
            )
            gathered = mine.repartition(-(-shards // turns), "shard").groupBy("shard", "slot").agg(
                F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("held")  # at most seq_len pieces
            )
            (
                gathered.select("shard", "slot", record.alias("value"))
                .sortWithinPartitions("shard", "slot").select("shard", "value")
                .write.mode("append" if turn else "errorifexists")
                .partitionBy("shard").option("lineSep", CLOSING).text(path)
            )
    manifest = [(seq_len, width, seq_len * width + len(CLOSING), rows_per_shard, count, at, key, coder.end)]
    spark.createDataFrame(
        manifest, "seq_len int, width int, stride int, rows_per_shard int, sequences long, tokens long, key long, end_id int"
    ).coalesce(1).write.parquet(f"{path}/_manifest")
    return pieces.select("doc_id", "seq", "slot", "shard", "place", "n")


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """slot, shard, byte_offset and ids (raw bytes) of the records from slot ``first``
    up to but not including ``last``; only the shards that hold them are read."""
    manifest = spark.read.parquet(f"{path}/_manifest").first()
    if manifest is None:
        raise ValueError(f"{path} has no manifest")
    per, stride = manifest["rows_per_shard"], manifest["stride"]
    last = manifest["sequences"] if last is None else min(last, manifest["sequences"])
    files = spark.read.format("binaryFile").option("basePath", path).load(f"{path}/shard=*").where(
        F.col("shard").between(first // per, max(last - 1, 0) // per)
    )
    return (
        files.select("content", F.col("shard").cast("long").alias("shard"), F.explode(F.sequence(F.lit(0), (F.length("content") / stride).cast("int") - 1)).alias("row"))
        .select(
            (F.col("shard") * per + F.col("row")).alias("slot"), "shard",
            (F.col("row") * stride).cast("long").alias("byte_offset"),
            F.substring(F.col("content"), F.col("row") * stride + 1, F.lit(manifest["seq_len"] * manifest["width"])).alias("ids"),
        )
        .where(F.col("slot").between(first, last - 1))
    )
