"""Reply trees as conversations: every branch from the root to a leaf, ranked, formatted.

Messages name the message they answer. Joining the links "message, ancestor 2^k above"
with themselves doubles their reach, so a tree of depth d needs about log2 d self-joins.
The same links, longest first, then walk from every leaf: after each join the rows found
so far are joined once more, and in the end every message of a branch has one row. All
joins are on (tree, message); only ids and scores move through them. Branches are ranked
by the sum of their messages' scores with numbers dealt out by ranges, so a tree with
most of the rows has no task of its own. Texts join the chosen branches alone.

A formatted conversation is one string, made by one task from the rows of its branch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .staging import drop_staged, numbered, staged, staged_count


@dataclass(frozen=True)
class Template:
    """How a turn is written: ``head`` role ``body`` text ``tail``.

    Control strings (the three marks and ``others``) never stand in a written role or
    text: a backslash goes in after their first character, one more where backslashes
    already are there, and reading takes one out again.
    """

    head: str = "[INST]"
    body: str = "[/INST]"
    tail: str = "</s>"
    others: tuple[str, ...] = ("<s>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    learnt_role: str = "assistant"

    def __post_init__(self) -> None:
        controls = self.controls
        openings = {c[:1] for c in controls}
        if any(len(c) < 2 or "\\" in c or openings & set(c[1:]) for c in controls) or len({self.head, self.body, self.tail}) < 3:
            raise ValueError("Control strings need an opening character of their own, no backslash, and different marks.")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.head, self.body, self.tail, *self.others)

    def _pattern(self, between: str) -> str:
        """First characters of control strings, with ``between`` right behind them."""
        rests = {c[0]: "|".join(re.escape(x[1:]) for x in self.controls if x[0] == c[0]) for c in self.controls}
        return "|".join(rf"({re.escape(first)}){between}(?=\\*(?:{rest}))" for first, rest in rests.items())

    @property
    def _firsts(self) -> str:
        """All groups of the pattern, of which one matched."""
        return "".join(f"${k}" for k in range(1, len({c[0] for c in self.controls}) + 1))

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(""), self._firsts + r"\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\"), self._firsts)

    def write(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.head), self.escape(role), F.lit(self.body), self.escape(text), F.lit(self.tail))

    def read(self, formatted: Column) -> Column:
        """The turns of a formatted conversation as an array of (role, text)."""
        turns = F.split(formatted, re.escape(self.tail))

        def turn(x: Column) -> Column:
            parts = F.split(F.substr(x, F.lit(len(self.head) + 1)), re.escape(self.body))
            return F.struct(self.unescape(parts[0]).alias("role"), self.unescape(parts[1]).alias("text"))

        return F.transform(F.slice(turns, 1, F.size(turns) - 1), turn)

    def read_learnt(self, formatted: Column, loss: Column) -> Column:
        """The texts under the loss mask, one element a span."""
        return F.transform(loss, lambda s: self.unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


LLAMA = Template()


def chains(rows: DataFrame, tree: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as reply trees: (tree, node, parent, role, text).

    Each row answers the one before it by ``order``, NULL first; ties go by role, then
    text. Nodes are numbered from 0. A NULL ``tree`` is one conversation.
    """
    place = F.row_number().over(Window.partitionBy(tree).orderBy(order, role, text)) - 1
    return rows.select(F.col(tree).alias("tree"), place.alias("node"), F.col(role).alias("role"), F.col(text).alias("text")).select(
        "tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), "role", "text"
    )


def branches(links: DataFrame) -> DataFrame:
    """Every message of every branch: (tree, leaf, steps, node, score) of (tree, node, parent, score).

    ``steps`` counts from the leaf. ``node`` is unique within its tree. A parent that is
    NULL or not in the tree makes a root. Messages whose ancestors form a circle have no
    root and so no branch. NULL trees are a tree; rows with a NULL node are left out.
    """
    links = links.where(F.col("node").isNotNull())
    nodes = links.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("score").alias("up_score"))
    first = links.join(nodes, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n"))).select(
        "tree", "node", F.col("parent").alias("up"), "up_score"
    )
    jump, rows = staged_count(first, "reply-links")
    jumps, reach = [], rows.bit_length()
    # A link as long as there are links goes round in a circle.
    while rows and len(jumps) <= reach:
        jumps.append(jump)
        upper = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("top"), F.col("up_score").alias("top_score"))
        twice = jump.join(upper, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n"))).select(
            "tree", "node", F.col("top").alias("up"), F.col("top_score").alias("up_score")
        )
        jump, rows = staged_count(twice, "reply-links")

    answered = links.where(F.col("parent").isNotNull()).select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    walks = links.join(answered, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti").select(
        "tree", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("steps"), "node", "score"
    )
    if rows:
        rootless = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"))
        walks = walks.join(rootless, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("n")), "left_anti")
    parts = [staged(walks, "reply-walks")]
    for power in reversed(range(len(jumps))):
        found = parts[0]
        for part in parts[1:]:
            found = found.union(part)
        upper = jumps[power].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up", "up_score")
        further = found.join(upper, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", (F.col("steps") + (1 << power)).alias("steps"), F.col("up").alias("node"), F.col("up_score").alias("score")
        )
        parts.append(staged(further, "reply-walks"))
        drop_staged(jumps[power])
    if rows == 0:
        drop_staged(jump)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def conversations(
    messages: DataFrame, score: str | None = None, best: int | None = None, template: Template = LLAMA, repeats: bool = True
) -> DataFrame:
    """One formatted conversation a branch of (tree, node, parent, role, text).

    Columns: tree, leaf, rank (from 1 within the tree), score, n_turns, formatted and
    ``loss``, the (start, length) in characters of every text of the learnt role. The
    score of a branch is the sum over its messages of the column ``score``, NULL being
    0; equal ones are ranked by leaf. ``best`` keeps that many branches a tree, None
    keeps all. NULL roles and texts are empty. Of rows with the same tree and node the
    smallest (by parent, score, role, text) counts; ``repeats=False`` says that there are
    none, as in ``chains``, and spares an exchange of the texts. Other columns are not
    read; an empty table has no conversations. What else holds of links stands at
    ``branches``.
    """
    points = F.lit(0.0) if score is None else F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    row = ["parent", points.alias("score"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")]
    if repeats:
        unique = messages.groupBy("tree", "node").agg(F.min(F.struct(*row)).alias("row")).select("tree", "node", "row.*")
    else:
        unique = messages.select("tree", "node", *row)
    unique = staged(unique, "reply-messages")
    walks = branches(unique.select("tree", "node", "parent", "score"))
    scored = walks.groupBy("tree", "leaf").agg(F.sum("score").alias("score")).withColumn("less", -F.col("score"))
    ranked = numbered(scored, ["less", "leaf"], "tree", "rank", "reply-ranks").select(
        F.col("tree").alias("t"), F.col("leaf").alias("l"), (F.col("rank") + 1).alias("rank"), F.col("score").alias("total")
    )
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    chosen = walks.drop("score").join(ranked, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))).drop("t", "l")

    texts = unique.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = chosen.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
        "tree", "leaf", "rank", "total", (-F.col("steps")).alias("turn"), template.write(F.col("role"), F.col("text")).alias("piece"),
        (F.col("role") == template.learnt_role).alias("learnt"),
        (F.char_length(template.escape(F.col("role"))) + len(template.head) + len(template.body)).cast("long").alias("before"),
    )
    after = F.sum(F.char_length("piece").cast("long")).over(Window.partitionBy("tree", "leaf").orderBy("turn"))
    start = F.col("after") - F.char_length("piece") + F.col("before")
    length = F.col("after") - len(template.tail) - start
    span = F.when(F.col("learnt"), F.struct("turn", start.alias("start"), length.alias("length")))
    return turns.withColumn("after", after).groupBy("tree", "leaf").agg(
        F.first("rank").alias("rank"), F.first("total").alias("score"), F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("turn", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(span)).alias("spans"),
    ).select(
        "tree", "leaf", "rank", "score", "n_turns",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
    )
