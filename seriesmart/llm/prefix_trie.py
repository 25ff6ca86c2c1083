"""Prefix trie of conversations, built as a burst trie.

A turn's id is a 128-bit hash of role and text, so a conversation is a sequence of ids.
Equal sequences are merged first, however many there are. A container holds sequences
that share their first turns, and with them a whole subtree. It starts as one container
of all. Each round, containers of more than ``limit`` turns burst: the turns all members
share become trie nodes (their number is that of the smallest and the largest sequence),
and the members go to new containers by their next turn. Containers that are small
enough leave the rounds; each is dealt to a shard, sorted and swept once, which yields
its nodes with their whole subtrees. Sums of burst containers come up from the last round.

Every round splits every burst container, so their number is that of the branchings
above ``limit`` turns, not of the turns that a crowd of conversations shares. A
conversation's turn ids are one row; a task holds one container's nodes, at most
``limit`` turns or one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .staging import drop_staged, ship, staged, staged_count

#: SHA-256 of no bytes.
NO_ENDS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: Turns of a container that is swept by one task.
LIMIT = 65_536
#: Members whose ids are put together in the first of two steps.
BLOCK = 4096
#: Rows of an output batch, at least.
OUT_ROWS = 8192

TURNS = "array<struct<id:binary,bytes:bigint>>"


def sequences(rows: DataFrame, conv: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns as an array of (id, bytes of the text).

    By ``order``, NULL first; ties go by the turn's id. NULL roles and texts are empty.
    """
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    ident = F.unhex(F.substring(F.sha2(whole, 256), 1, 32))
    slim = rows.select(F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(order).alias("at"), ident.alias("id"), F.octet_length(text).cast("long").alias("bytes")).alias("turn"))
    listed = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).cast(TURNS).alias("turns"))


def nodes(seqs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of (conv_id, turns), one row a node.

    A node is a distinct sequence of first turns; the root has depth 0. Columns: conv_id,
    the smallest member; depth; parent_conv_id, the parent's conv_id (NULL at the root);
    n_convs, the members; n_children; n_leaves, the childless nodes of its subtree;
    saved_tokens, what storing each node's last text once saves in its subtree, in bytes;
    ends_sha256, over the comma-joined ids of the members that end there. Subtrees
    include their top. Conversations without turns end at the root; rows with a NULL
    conv_id are left out, as they have no smallest member; a conv_id stands for one
    member a row; NULL turns are none. Other columns are not read. Without rows there are
    no nodes, not even a root. ``limit`` changes the work, not the nodes.
    """
    ship(seqs.sparkSession)
    active = staged(_distinct(seqs).withColumns({
        "container": F.unhex(F.lit("")), "top": F.lit(0), "parent": F.lit(None).cast("binary"), "parent_conv": F.lit(None).cast("long"),
    }), "trie-members")
    kept, rounds = [], []
    while True:
        sizes = active.groupBy("container").agg(F.sum(F.size("turns") - F.col("top")).alias("n"), F.count("*").alias("members"))
        big, bursts = staged_count(sizes.where((F.col("n") > limit) & (F.col("members") > 1)).select("container"), "trie-oversized")
        if not bursts:
            kept.append(active)
            drop_staged(big)
            break
        kept.append(staged(active.join(big, "container", "left_anti"), "trie-kept"))
        heads = staged(_heads(active.join(big, "container")), "trie-heads")
        drop_staged(big)
        split = active.join(heads.select("container", "bottom", F.col("conv_id").alias("head_conv")), "container")
        ending = staged(split.where(F.size("turns") == F.col("bottom")).select("container", "ends"), "trie-ends")
        following = F.get("turns", F.col("bottom"))["id"]
        below = F.sha2(F.concat(F.col("container"), following), 256)
        children = split.where(F.size("turns") > F.col("bottom")).select(
            "conv_id", "turns", "members", "ends", F.unhex(F.substring(below, 1, 32)).alias("container"),
            (F.col("bottom") + 1).alias("top"), F.col("container").alias("parent"), F.col("head_conv").alias("parent_conv"),
        )
        following_round = staged(children, "trie-members")
        drop_staged(active)
        active = following_round
        rounds.append((heads, ending))
    members = kept[0]
    for part in kept[1:]:
        members = members.unionByName(part)
    swept = _swept(members)
    if not rounds:
        return swept.drop("parent")
    swept = staged(swept, "trie-nodes")
    for part in kept:
        drop_staged(part)
    return _with_heads(swept, rounds)


def _distinct(seqs: DataFrame) -> DataFrame:
    """One row a distinct sequence: smallest id, turns, number of members, digest of their ids.

    The ids of a sequence are joined in blocks first, so copies of one conversation do
    not meet in one task row by row.
    """
    turns = F.coalesce("turns", F.array().cast(TURNS))
    keyed = seqs.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turns.alias("turns"))
    key = F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.hex(t["id"]))), 256)
    blocks = keyed.groupBy(key.alias("key"), F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(
        F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"), F.count("*").alias("members"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    listed = F.transform(F.sort_array(F.collect_list(F.struct("block", "ids"))), lambda b: b["ids"])
    return blocks.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"), F.sum("members").alias("members"),
        F.sha2(F.array_join(listed, ","), 256).alias("ends"),
    ).drop("key")


def _heads(rows: DataFrame) -> DataFrame:
    """One row a burst container: the depths ``top`` to ``bottom`` that its members share."""
    found = rows.groupBy("container").agg(
        F.min("turns").alias("low"), F.max("turns").alias("high"), F.sum("members").alias("members"), F.min("conv_id").alias("conv_id"),
        F.first("top").alias("top"), F.first("parent").alias("parent"), F.first("parent_conv").alias("parent_conv"),
    )
    same = F.zip_with("low", "high", lambda a, b: a["id"].eqNullSafe(b["id"]))
    bottom = (F.array_position(same, False) - 1).cast("int")
    # The root's last text is none.
    sizes = F.concat(F.array(F.lit(0).cast("long")), F.transform("low", lambda t: t["bytes"]))
    return found.withColumn("bottom", bottom).withColumn(
        "sizes", F.slice(sizes, F.col("top") + 1, F.col("bottom") - F.col("top") + 1)
    ).drop("low", "high")


NODE = T.StructType([
    T.StructField("parent", T.BinaryType()),
    T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()), T.StructField("parent_conv_id", T.LongType()),
    T.StructField("n_convs", T.LongType()), T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()),
    T.StructField("saved_tokens", T.LongType()), T.StructField("ends_sha256", T.StringType()),
])


def _swept(members: DataFrame) -> DataFrame:
    """The nodes of containers, each sorted and swept; ``parent`` only at a container's top node."""
    sorted_rows = members.select(
        "container", "parent", "parent_conv", "top", "conv_id", "members", "ends", "turns"
    ).repartition("container").sortWithinPartitions("container", "turns")
    names = [f.name for f in NODE.fields]
    kinds = pa.schema([
        ("parent", pa.binary()), *[(n, pa.int64()) for n in names[1:-1]], ("ends_sha256", pa.string()),
    ])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, current, rows = None, None, []
        for batch in batches:
            turns = batch.column("turns")
            offsets, values = turns.offsets.to_pylist(), turns.values
            ids, sizes = values.field("id").to_pylist(), values.field("bytes").to_pylist()
            columns = [batch.column(n).to_pylist() for n in ("container", "parent", "parent_conv", "top", "conv_id", "members", "ends")]
            for i, (container, parent, parent_conv, top, conv, count, ends) in enumerate(zip(*columns, strict=True)):
                if sweep is None or container != current:
                    if sweep is not None:
                        rows += sweep.finished()
                    if len(rows) >= OUT_ROWS:
                        yield _batch(rows, kinds)
                        rows = []
                    sweep, current = Sweep(parent, parent_conv, top), container
                part = slice(offsets[i], offsets[i + 1])
                sweep.add(ids[part], sizes[part], conv, count, ends)
        if sweep is not None:
            yield _batch(rows + sweep.finished(), kinds)

    return sorted_rows.mapInArrow(tasks, NODE)


def _batch(rows: list[list], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds
    )


class Sweep:
    """Nodes of one container, from its distinct sequences in ascending order."""

    def __init__(self, parent: bytes | None, parent_conv: int | None, top: int):
        self._parent, self._parent_conv, self._top = parent, parent_conv, top
        self._path: list[bytes] = []
        # Open nodes from the top down: row, bytes of the last text, rows of closed children.
        self._open: list[tuple[list, int, list[list]]] = []
        self._rows: list[list] = []

    def add(self, ids: list[bytes], sizes: list[int], conv: int, count: int, ends: str) -> None:
        common, most = self._top, min(len(ids), len(self._path))
        while common < most and ids[common] == self._path[common]:
            common += 1
        if self._open:
            self._close(common)
            first = common + 1
        else:
            first = self._top
        for depth in range(first, len(ids) + 1):
            row = [None, conv, depth, None, 0, 0, 0, 0, NO_ENDS]
            self._open.append((row, sizes[depth - 1] if depth else 0, []))
        last = self._open[-1][0]
        last[4], last[8] = last[4] + count, ends
        last[1] = min(last[1], conv)
        self._path = ids

    def _close(self, depth: int) -> None:
        """Close the open nodes below ``depth``."""
        while self._open and self._open[-1][0][2] > depth:
            row, size, children = self._open.pop()
            row[5] = len(children)
            row[6] += not children
            row[7] += (row[4] - 1) * size
            for child in children:
                child[3] = row[1]
            self._rows.append(row)
            if self._open:
                above, _, siblings = self._open[-1]
                siblings.append(row)
                above[1] = min(above[1], row[1])
                above[4] += row[4]
                above[6] += row[6]
                above[7] += row[7]

    def finished(self) -> list[list]:
        self._close(self._top - 1)
        top = self._rows[-1]
        top[0], top[3] = self._parent, self._parent_conv
        return self._rows


def _with_heads(swept: DataFrame, rounds: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The swept nodes and those of the burst containers, summed up from the last round."""
    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("parent").alias("container")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below")
        )

    tops = swept.where(F.col("parent").isNotNull()).select("parent", "n_leaves", "saved_tokens")
    out = swept.drop("parent")
    for heads, ending in reversed(rounds):
        full = staged(heads.join(sums(tops), "container").join(ending, "container", "left"), "trie-sums")
        own = (F.col("members") - 1) * F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s)
        mine = full.select("parent", "n_leaves", (F.col("below") + own).alias("saved_tokens"))
        tops = tops.unionByName(mine.where(F.col("parent").isNotNull()))
        chain = full.select("*", F.posexplode("sizes").alias("step", "bytes")).withColumn("depth", F.col("top") + F.col("step"))
        last = F.col("depth") == F.col("bottom")
        deeper = F.sum((F.col("members") - 1) * F.col("bytes")).over(Window.partitionBy("container").orderBy(F.desc("depth")))
        out = out.unionByName(chain.select(
            "conv_id", F.col("depth").cast("long").alias("depth"),
            F.when(F.col("step") == 0, F.col("parent_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            F.col("members").alias("n_convs"), F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
            "n_leaves", (F.col("below") + deeper).alias("saved_tokens"),
            F.when(last, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
        ))
    return out
