"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Nearness is the largest inner product. For the graph, every vector gets one more
component that brings all to equal length, so that near vectors are near both ways.

The graph is built by iterative joins. In each round a node's neighbours, and a
bounded sample of the nodes that have it as a neighbour, meet: every pair of them
with a fresh member is compared, for neighbours of neighbours are likely neighbours.
Nodes are dealt into blocks; a block's task gets its nodes' lists and each vector named
in them once. Blocks are as large as the vectors they name allow (``block_count``): where
a block names nearly every vector, more blocks would only send all vectors more often.
What a task finds is cut to the best per node before
it is shuffled, and merged into the nodes' lists. A round's lists are written to the
shared folder; rounds end when few lists change.

A search keeps a beam of the best nodes per query and expands the best that are not
yet expanded, one join with the graph and the vectors a round, until none is left.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .staging import drop_staged, staged, staged_count

#: Nodes of a block and queries of a block: as many where each names vectors of its own,
#: and as many at most.
BLOCK_NODES, MOST_NODES = 8192, 32_768
BLOCK_QUERIES, MOST_QUERIES = 512, 4096
#: Blocks that smaller tables are dealt into, to keep as many tasks busy.
TASKS = 4
GROUP_NODES = 512
LISTED = "block int, node long, ids array<long>, scores array<float>, fresh array<boolean>"


def block_count(members: int, nodes: int, named: int, least: int, most: int) -> int:
    """Blocks for ``members``, each of which names up to ``named`` of the ``nodes``.

    A task may hold the ``least * named`` vectors that ``least`` members name at most. A
    block of n members chosen by hash names about ``nodes * (1 - exp(-n * named / nodes))``
    different ones, fewer where they name the same; it gets as many members, up to
    ``most``, as that allows. So the vectors that all blocks get grow with the table.
    """
    held = least * named
    size = most if nodes <= held else min(most, max(least, int(-math.log1p(-held / nodes) * nodes / named)))
    return max(1, -(-members // size), min(TASKS, -(-members // least)))


def valid_vectors(table: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id, v (doubles): rows with an id whose vector is not null or zero, has only finite
    components and as many as the most frequent length (the smaller of equals)."""
    v = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def best(node: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (node, other, score), each node's k largest scores with different others,
    sorted by node and falling score; ties go to the smaller other."""
    order = np.lexsort((-score, other, node))
    node, other, score = node[order], other[order], score[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, score = node[new], other[new], score[new]
    order = np.lexsort((other, -score, node))
    node, other, score = node[order], other[order], score[order]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.empty(0, int)
    rank = np.arange(len(node)) - np.repeat(starts, np.diff(np.r_[starts, len(node)]))
    top = rank < k
    return node[top], other[top], score[top]


def local_join(
    lists: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Better neighbours found among the members of ``lists``.

    Each list holds row numbers of ``x`` and whether they are fresh. Pairs with a
    fresh member whose score is above the ``floor`` of one side are kept for that side.
    """
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    pending = 0
    floor = floor.copy()

    def settle() -> None:
        nonlocal pending
        merged = best(*(np.concatenate(c) for c in zip(*kept, strict=True)), k)
        kept[:] = [merged]
        pending = 0
        ends = np.flatnonzero(np.r_[merged[0][1:] != merged[0][:-1], True]) if len(merged[0]) else np.empty(0, int)
        starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
        full = ends - starts + 1 == k
        floor[merged[0][ends[full]]] = np.maximum(floor[merged[0][ends[full]]], merged[2][ends[full]])

    for start in range(0, len(lists), 128):
        chunk = lists[start : start + 128]
        width = max(len(m) for m, _ in chunk)
        rows = np.full((len(chunk), width), -1, np.int64)
        fresh = np.zeros((len(chunk), width), bool)
        for i, (m, f) in enumerate(chunk):
            rows[i, : len(m)], fresh[i, : len(m)] = m, f
        vectors = x[rows]
        scores = np.matmul(vectors, vectors.transpose(0, 2, 1))
        there = rows >= 0
        use = (fresh[:, :, None] | fresh[:, None, :]) & there[:, :, None] & there[:, None, :]
        use &= rows[:, :, None] != rows[:, None, :]
        use &= scores > floor[rows][:, :, None]
        at = np.nonzero(use)
        kept.append((rows[at[0], at[1]], rows[at[0], at[2]], scores[at]))
        pending += len(at[0])
        if pending > 1_000_000:
            settle()
    if not kept:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
    settle()
    return kept[0]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as rows of 32-bit floats."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return flat.reshape(len(rows), -1) if len(rows) else np.empty((0, 0), np.float32)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row each belongs to."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return rows.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(rows)), lengths)


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as one array each."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.split(rows.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)[:-1]) if len(rows) else []


def _listed(block: int, nodes: np.ndarray, others: np.ndarray, scores: np.ndarray, fresh: np.ndarray) -> pa.Table:
    """Rows of LISTED from values sorted by node."""
    starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else np.empty(0, int)
    ends = pa.array(np.r_[starts, len(nodes)].astype(np.int32))
    cut = lambda values, kind: pa.ListArray.from_arrays(ends, pa.array(values, kind))
    return pa.table({
        "block": pa.array(np.full(len(starts), block), pa.int32()), "node": pa.array(nodes[starts], pa.int64()),
        "ids": cut(others, pa.int64()), "scores": cut(scores, pa.float32()), "fresh": cut(fresh, pa.bool_()),
    })


def _in_group(table: pa.Table, k: int) -> pa.Table:
    """Each node's k nearest within one random group."""
    ids, x = table["node"].to_numpy(), _matrix(table["x"])
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    most = min(k, len(ids) - 1)
    top = np.argsort(-scores, 1, kind="stable")[:, :most]
    n = np.repeat(np.arange(len(ids)), most)
    return pa.table({"node": ids[n], "other": ids[top.ravel()], "score": scores[n, top.ravel()]})


def _met(key: tuple, lists: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The local join of one block: its nodes' members and the vectors they name."""
    empty = pa.table({"node": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "score": pa.array([], pa.float32())})
    if not len(lists) or not len(vectors):
        return empty
    ids = vectors["node"].to_numpy()
    order = np.argsort(ids)
    ids, x = ids[order], _matrix(vectors["x"])[order]
    floor = vectors["floor"].to_numpy()[order].astype(np.float32)
    node, member, fresh = (lists[c].to_numpy(zero_copy_only=False) for c in ("node", "member", "fresh"))
    row = np.minimum(np.searchsorted(ids, member), len(ids) - 1)
    order = np.lexsort((~fresh, row, node))
    node, row, fresh = node[order], row[order], fresh[order]
    new = np.r_[True, (node[1:] != node[:-1]) | (row[1:] != row[:-1])]
    node, row, fresh = node[new], row[new], fresh[new]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    cuts = np.r_[starts, len(node)]
    groups = [(row[a:b], fresh[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if fresh[a:b].any()]
    if not groups:
        return empty
    a, b, score = local_join(groups, x, floor, k)
    return pa.table({"node": ids[a], "other": ids[b], "score": score.astype(np.float32)})


def _merged(key: tuple, lists: pa.Table, found: pa.Table, k: int) -> pa.Table:
    """A block's lists with what was found; only what was not listed before is fresh."""
    old, at = _flat(lists["ids"])
    old_scores, _ = _flat(lists["scores"])
    owner = lists["node"].to_numpy()[at]
    node, other, score = best(
        np.r_[owner, found["node"].to_numpy()], np.r_[old, found["other"].to_numpy()],
        np.r_[old_scores, found["score"].to_numpy()].astype(np.float32), k,
    )
    pair = np.dtype([("a", np.int64), ("b", np.int64)])
    before, now = np.empty(len(owner), pair), np.empty(len(node), pair)
    before["a"], before["b"], now["a"], now["b"] = owner, old, node, other
    return _listed(key[0].as_py(), node, other, score, ~np.isin(now, before))


def build_graph(
    nodes: DataFrame, k: int = 32, sample: int = 16, rounds: int = 12, settled: float = 0.005, groups: int = 4
) -> DataFrame:
    """block, node, ids, scores, fresh: up to k neighbours of every node.

    ``nodes`` has node and x (floats of one length). The first lists come from
    ``groups`` random groupings; rounds end when fewer than ``settled`` of all list
    entries are new, or after ``rounds``.
    """
    nodes, count = staged_count(nodes.select("node", F.col("x").cast("array<float>").alias("x")), "nodes")
    blocks = block_count(count, count, k + 2 * sample, BLOCK_NODES, MOST_NODES)
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    crowd = max(1, -(-count // (GROUP_NODES // 2)))
    seeds = F.explode(F.array(*[F.pmod(F.xxhash64(F.col("node"), F.lit(g)), F.lit(crowd)) * groups + g for g in range(groups)]))
    first = nodes.withColumn("g", seeds).groupBy("g").applyInArrow(
        lambda group: _in_group(group, k), "node long, other long, score float"
    )
    bare = nodes.select(block.alias("block"), "node").selectExpr(
        "block", "node", "cast(array() as array<long>) ids", "cast(array() as array<float>) scores", "cast(array() as array<boolean>) fresh"
    )

    def merge(lists: DataFrame, found: DataFrame) -> DataFrame:
        dealt = found.withColumn("b", block)
        return lists.groupBy("block").cogroup(dealt.groupBy("b")).applyInArrow(
            lambda key, a, b: _merged(key, a, b, k), LISTED
        )

    lists = staged(merge(bare, first), "lists")
    for turn in range(rounds):
        edges = lists.select(
            "node", F.explode(F.arrays_zip("ids", "fresh")).alias("e")
        ).select("node", F.col("e.ids").alias("member"), F.col("e.fresh").alias("fresh"))
        # A bounded sample of the nodes that list a node; a hub's others are cut before the shuffle.
        order = Window.partitionBy("member", "fresh").orderBy(F.xxhash64("node", F.lit(turn)))
        back = edges.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample).select(
            F.col("member").alias("node"), F.col("node").alias("member"), "fresh"
        )
        members = staged(edges.union(back).withColumn("block", block), "members")
        floors = lists.select("node", F.when(F.size("ids") >= k, F.element_at("scores", -1)).otherwise(F.lit(-3.0e38)).cast("float").alias("floor"))
        named = members.select("block", F.col("member").alias("node")).distinct()
        vectors = named.join(nodes.join(floors, "node"), "node").select(F.col("block").alias("b"), "node", "x", "floor")
        found = members.groupBy("block").cogroup(vectors.groupBy("b")).applyInArrow(
            lambda key, a, b: _met(key, a, b, k), "node long, other long, score float"
        )
        after = staged(merge(lists, found), "lists")
        new = after.agg(F.sum(F.size(F.filter("fresh", lambda f: f))).alias("n")).first()["n"] or 0
        drop_staged(members)
        drop_staged(lists)
        lists = after
        if new <= settled * count * k:
            break
    return lists


def _hop(key: tuple, state: pa.Table, near: pa.Table, beam: int, expand: int) -> pa.Table:
    """One round of a block of queries: score the new candidates, keep the beam.

    ``near`` holds lists of the expanded nodes (x null) and vectors of candidates.
    """
    if not len(state):
        return STATE.empty_table()
    q = state["q"].to_numpy()
    x = _matrix(state["x"])
    kinds = near["x"].is_null().to_numpy(zero_copy_only=False)
    vectors = near.filter(pa.array(~kinds))
    ids = vectors["node"].to_numpy()
    order = np.argsort(ids)
    ids, y = ids[order], _matrix(vectors["x"])[order]
    lists = near.filter(pa.array(kinds))
    listed = dict(zip(lists["node"].to_pylist(), _arrays(lists["ids"]), strict=True))
    state_ids, state_scores, state_done, state_next = (_arrays(state[c]) for c in ("ids", "scores", "done", "next"))
    out: dict[str, list] = {c: [] for c in ("q", "block", "x", "ids", "scores", "done", "next")}
    for i in range(len(q)):
        held, scores, done, asked = state_ids[i], state_scores[i], state_done[i].astype(bool), state_next[i]
        done = done | np.isin(held, asked)
        offered = [listed[n] for n in asked.tolist() if n in listed]
        new = np.setdiff1d(np.unique(np.concatenate(offered)), held) if offered else np.empty(0, np.int64)
        at = np.searchsorted(ids, new)
        held, scores = np.r_[held, ids[at]], np.r_[scores, y[at] @ x[i] if len(at) else np.empty(0, np.float32)]
        done = np.r_[done, np.zeros(len(at), bool)]
        top = np.lexsort((held, -scores))[:beam]
        held, scores, done = held[top], scores[top].astype(np.float32), done[top]
        for c, v in zip(out, (q[i], key[0].as_py(), x[i], held, scores, done, held[~done][:expand]), strict=True):
            out[c].append(v)
    return pa.table({c: pa.array(out[c], STATE.field(c).type) for c in out}, STATE)


STATE = pa.schema([
    ("q", pa.int64()), ("block", pa.int32()), ("x", pa.list_(pa.float32())), ("ids", pa.list_(pa.int64())),
    ("scores", pa.list_(pa.float32())), ("done", pa.list_(pa.bool_())), ("next", pa.list_(pa.int64())),
])
STATE_SQL = "q long, block int, x array<float>, ids array<long>, scores array<float>, done array<boolean>, next array<long>"


def search(
    graph: DataFrame, nodes: DataFrame, queries: DataFrame, beam: int = 320, expand: int = 40, entries: int = 16,
    sample: int = 24, rounds: int = 40,
) -> DataFrame:
    """q, ids, scores: the ``beam`` nearest nodes found for each query (q, x, start).

    ``start`` may name the query's own node; besides, every query enters at the same
    ``entries`` nodes of smallest hash. A node is expanded to its neighbours and to
    up to ``sample`` of those that list it, nearest first.
    """
    nodes = nodes.select("node", F.col("x").cast("array<float>").alias("x"))
    edges = graph.select("node", F.explode(F.arrays_zip("ids", "scores")).alias("e")).select(
        "node", F.col("e.ids").alias("other"), F.col("e.scores").alias("score")
    )
    nearest = Window.partitionBy("other").orderBy(F.desc("score"), "node")
    back = edges.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= sample).select(
        F.col("other").alias("node"), F.col("node").alias("other")
    )
    both, listing = staged_count(
        edges.select("node", "other").union(back).groupBy("node").agg(F.collect_set("other").alias("ids")), "graph"
    )
    longest = both.agg(F.max(F.size("ids"))).first()[0] or 1
    doors = [r["node"] for r in nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(entries).collect()]
    count = queries.count()
    blocks = block_count(count, listing, expand * longest, BLOCK_QUERIES, MOST_QUERIES)
    opening = F.array_distinct(F.filter(F.concat(F.array("start"), F.array(*[F.lit(d) for d in doors]).cast("array<long>")), lambda n: n.isNotNull()))
    state = staged(
        queries.select(
            "q", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"), F.col("x").cast("array<float>").alias("x"),
            F.expr("cast(array() as array<long>) ids"), F.expr("cast(array() as array<float>) scores"),
            F.expr("cast(array() as array<boolean>) done"), opening.alias("next"),
        ), "state",
    )
    for _ in range(rounds):
        asked = state.select("block", F.explode("next").alias("node")).distinct()
        lists = asked.join(both, "node").select("block", "node", "ids")
        offered = lists.select("block", F.explode("ids").alias("node")).distinct()
        vectors = offered.join(nodes, "node").select("block", "node", F.expr("cast(null as array<long>) ids"), "x")
        near = lists.select("block", "node", "ids", F.expr("cast(null as array<float>) x")).union(vectors).select(
            F.col("block").alias("b"), "node", "ids", "x"
        )
        after = staged(
            state.groupBy("block").cogroup(near.groupBy("b")).applyInArrow(
                lambda key, a, b: _hop(key, a, b, beam, expand), STATE_SQL
            ), "state",
        )
        drop_staged(state)
        state = after
        if state.where(F.size("next") > 0).limit(1).count() == 0:
            break
    return state.select("q", "ids", "scores")


def nearest(
    table: DataFrame, queries: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 20, **graph: int
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``queries`` holds, its ``k``
    nearest other rows by inner product, ties to the smaller id.

    Vectors that are null, zero, not finite or of another length than most take no
    part. Equal vectors are one node of the graph, of which the k + 1 smallest ids are
    known, so a vector that a third of the rows share costs one node. Other columns
    are not read; fewer than k candidates give fewer rows.
    """
    rows = valid_vectors(table, id_col, vector).withColumn("node", F.xxhash64("v"))
    rows = staged(rows, "vectors")
    by_id = Window.partitionBy("node").orderBy("id")
    copies = rows.select("node", "id").distinct().withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    copies = staged(copies.groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("copies")), "copies")
    heads = rows.join(copies.select("node", F.get("copies", F.lit(0)).alias("id")), ["node", "id"], "left_semi").dropDuplicates(["node"])
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = heads.agg(F.max(square)).first()[0] or 0.0
    level = F.sqrt(F.greatest(F.lit(0.0), F.lit(float(largest)) - square))
    nodes = staged(heads.select("node", F.concat("v", F.array(level)).alias("x")), "nodes")
    listed = build_graph(nodes, **graph)
    asked = rows.where(queries).select(F.col("id").alias("q"), F.col("node").alias("start"), "v").dropDuplicates(["q"])
    found = search(listed, nodes, asked.select("q", F.concat("v", F.array(F.lit(0.0))).alias("x"), "start"))
    # The nearest nodes hold the nearest rows; a query's own node may be among them.
    slim = found.select("q", F.explode(F.slice("ids", 1, 3 * k)).alias("node"))
    pairs = slim.join(copies, "node").join(heads.select("node", F.col("v").alias("w")), "node").join(asked.select("q", "v"), "q")
    exact = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = pairs.select(F.col("q").alias("query_id"), exact.alias("score"), F.explode("copies").alias("vec_id")).where(
        "vec_id != query_id"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
