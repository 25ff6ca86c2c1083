"""Benchmark text in documents, found by spaced seeds and verified with substitutions.

A seed looks at seven of twelve token positions and ignores the rest, so a changed
word at an ignored position does not hide a passage. The three seeds were chosen by
exhaustive search: any stretch of 12 to 20 tokens in which at most 15 % (rounded
down) differ is hit by one of them. Hits name a document, an item and a diagonal
(document position less item position); the tokens on that diagonal are compared.

Only DataFrame functions: positions are generated and hashed inside one generated
code stage and meet the benchmark's hashes in a broadcast join of proven size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .staging import staged

# Token positions each seed looks at.
SEEDS = ((0, 2, 6, 7, 8, 10, 11), (0, 1, 3, 4, 5, 10, 11), (0, 1, 4, 5, 7, 8, 10))
SPAN = 12
#: Windows of the benchmark that are broadcast at once: 16 bytes and row overhead each.
BLOCK_ROWS = 400_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null gives none."""
    cut = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(cut, lambda w: w != "")


def _hash(words: Column, at: Column, places: tuple[int, ...], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.get(words, at + p) for p in places])


def _windows(frame: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """One row per position and seed: the frame's columns, ``at`` and ``h``.

    ``lengths`` are those of items shorter than a seed; they are hashed whole.
    """
    n, at = F.size(words), F.col("at")
    placed = frame.withColumn("at", F.explode(F.sequence(F.lit(0), n - 1))).where(f"size({words}) > 0")
    hashes = [
        F.when(at + (max(places) + 1) <= n, _hash(F.col(words), at, places, seed)) for seed, places in enumerate(SEEDS)
    ] + [F.when(at + k <= n, _hash(F.col(words), at, tuple(range(k)), 100 + k)) for k in lengths]
    return placed.withColumn("h", F.explode(F.array(*hashes))).where("h IS NOT NULL")


def hits(docs: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """key, item, diagonal of every seed hit, each once.

    ``items`` (item, words) must be staged. Their windows are counted; they are
    broadcast if they fit one block, else in as many blocks as they fill, each
    joined with all documents.
    """
    windows = _windows(items, "words", lengths).select("h", "item", F.col("at").alias("item_at"))
    blocks = max(1, -(-windows.count() // BLOCK_ROWS))
    windows = windows.withColumn("block", F.pmod(F.col("h"), F.lit(blocks)))
    placed = _windows(docs.select("key", "words"), "words", lengths)
    found = [
        placed.join(F.broadcast(windows.where(F.col("block") == b)), "h").select(
            "key", "item", (F.col("at") - F.col("item_at")).alias("diagonal")
        )
        for b in range(blocks)
    ]
    return reduce(DataFrame.union, found).distinct()


def overlaps(found: DataFrame, docs: DataFrame, items: DataFrame, window: int = 20, tolerance: float = 0.15) -> DataFrame:
    """key, item, diagonal, matched: hits whose tokens agree.

    On the diagonal, document and item are laid over each other; some stretch of
    ``window`` tokens (of the whole item, if it is shorter) must lie in both with at
    most ``tolerance`` of its tokens different. ``matched`` is the most equal
    tokens in such a stretch.
    """
    low = F.greatest(F.lit(0), F.col("diagonal"))
    high = F.least(F.size("words"), F.col("diagonal") + F.size("item_words"))
    laid = (
        found.join(items.select("item", F.col("words").alias("item_words")), "item")
        .join(docs.select("key", "words"), "key")
        .select(
            "key", "item", "diagonal", F.least(F.lit(window), F.size("item_words")).alias("w"),
            F.slice("words", low + 1, high - low).alias("x"),
            F.slice("item_words", low - F.col("diagonal") + 1, high - low).alias("y"),
        )
        .where("size(x) >= w")
    )
    same = F.zip_with("x", "y", lambda a, b: (a == b).cast("int"))
    summed = F.aggregate(
        "same", F.array(F.lit(0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s))
    )
    w = F.col("w")
    best = F.array_max(
        F.transform(
            F.sequence(w, F.size("same")), lambda e: F.get(F.col("sums"), e) - F.get(F.col("sums"), e - w)
        )
    )
    return (
        laid.withColumn("same", same).withColumn("sums", summed).withColumn("matched", best)
        .where(F.col("w") - F.col("matched") <= F.when(w >= SPAN, F.floor(w * tolerance)).otherwise(0))
        .select("key", "item", "diagonal", "matched")
    )


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, contaminated, item_ids, matched of every row; see ``flagged``."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return flagged(picked, items).select("doc_id", "contaminated", "item_ids", "matched")


def flagged(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with contaminated, item_ids (sorted) and matched (most equal tokens).

    Null and empty texts hold nothing; items without tokens are in no document.
    Rows of one id share a verdict; rows without an id are judged by their text.
    Repeated items count once each id. Extra columns stay; columns of the new names
    are replaced. An item that a third of the documents hold gives one row per
    document, item and diagonal before anything is shuffled by document.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    source = docs.drop("contaminated", "item_ids", "matched").withColumn("__key", key)
    cut = source.select(F.col("__key").alias("key"), tokens(F.col(text)).alias("words"))
    bench = staged(
        items.select(F.col(item_col).alias("item"), tokens(F.col(item_text)).alias("words"))
        .where("size(words) > 0 AND item IS NOT NULL").distinct(),
        "benchmark",
    )
    lengths = [r[0] for r in bench.where(F.size("words") < SPAN).select(F.size("words")).distinct().collect()]  # 11 at most
    found = staged(hits(cut, bench, sorted(lengths)), "hits")
    holding = staged(cut.join(found.select("key").distinct(), "key", "left_semi").distinct(), "holding")
    proven = overlaps(found, holding, bench)
    verdicts = proven.groupBy(F.col("key").alias("__key")).agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"), F.max("matched").cast("long").alias("matched")
    )
    return (
        source.join(staged(verdicts, "verdicts"), "__key", "left").drop("__key")
        .withColumn("contaminated", F.col("item_ids").isNotNull())
        .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<long>")))
        .withColumn("matched", F.coalesce("matched", F.lit(0)).cast("long"))
    )
