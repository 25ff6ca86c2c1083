"""Toxicity by the nearest labelled examples in exact TF-IDF cosine.

Learning uses a bounded sample of labelled rows (``Limits``): it picks the terms
that tell the classes apart and gives the examples. Term statistics of the corpus,
the document frequencies in TF-IDF, are counted over every document.

Examples stand in a block-max inverted index: postings are grouped into blocks of
examples, one matrix each, and each term keeps its largest weight in each block. These
give a bound per query and block. A batch of queries goes through its blocks together,
each query's best block first, and leaves out blocks that can no longer hold a nearer
neighbour, so the neighbours found are exact.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .piece_bpe import parts
from .staging import staged

_WORD = re.compile(r"[^\W_]+")
BLOCK = 64
#: Queries searched together: a matrix of their cosines with all examples is held.
TOGETHER = 256
CACHED_QUERIES = 20_000
CACHED_WORDS = 100_000
# Lengths of word beginnings that are terms of their own.
STEMS = (4, 6)


@dataclass(frozen=True)
class Limits:
    """What bounds the labelled sample and what is learnt from it."""

    examples_per_class: int = 4000
    terms: int = 20_000
    least_evidence: float = 14.0  # log-likelihood ratio of a term
    neighbours: int = 25


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits of a whole text."""
    return _WORD.findall(text.lower()) if text else []


def terms_of(word: str) -> set[str]:
    """A word's terms: itself and its beginnings, marked with ``*``, which stand for inflected forms."""
    return {word, *(word[:n] + "*" for n in STEMS if len(word) > n)}


class Known(dict):
    """Numbers of the learnt terms of a word, by word, kept up to a fixed number of words."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        known = tuple(self.vocabulary[t] for t in terms_of(word) if t in self.vocabulary)
        if len(word) <= 40:
            self[word] = known
        return known

    def counts(self, text: str | None) -> Counter[int]:
        """Occurrences of learnt terms; every other word counts for one more term, the
        last number, so that a few telling words weigh little in a long text."""
        found = list(map(self.__getitem__, words_of(text)))
        told = Counter(chain.from_iterable(found))
        if told:
            told[len(self.vocabulary)] = found.count(())
        return told


@dataclass
class Index:
    """Unit vectors of labelled examples, in blocks, with their labels and class weights."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: list[int]
    labels: np.ndarray
    weights: np.ndarray
    rate_without_terms: float
    prior: float
    blocks: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    tops: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def vector(self, counts: Counter[int]) -> tuple[tuple[int, ...], np.ndarray]:
        """Terms and unit-length TF-IDF weights; empty where no term is known."""
        terms = tuple(sorted(t for t, n in counts.items() if n))
        w = np.array([(1 + math.log(counts[t])) * self.idf[t] for t in terms])
        norm = math.sqrt(float(w @ w))
        return (terms, w / norm) if norm else ((), w[:0])

    def fill(self, vectors: list[tuple[tuple[int, ...], np.ndarray]]) -> None:
        """Group the vectors' postings by block, as the block's terms and a matrix of
        weights (terms by rows), and keep each term's largest weight in each block."""
        self.blocks = []
        self.tops = np.zeros((len(self.idf), -(-len(vectors) // BLOCK)))
        for b in range(self.tops.shape[1]):
            held = vectors[b * BLOCK : (b + 1) * BLOCK]
            terms = np.unique(np.concatenate([np.array(t, np.int64) for t, _ in held]))
            weights = np.zeros((len(terms), len(held)))
            for row, (t, w) in enumerate(held):
                weights[np.searchsorted(terms, np.array(t, np.int64)), row] = w
            self.blocks.append((terms, weights))
            self.tops[terms, b] = weights.max(axis=1, initial=0.0)

    def nearest(self, terms: tuple[int, ...], w: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k rows of largest cosine above 0, nearest first, ties to the smaller row."""
        return self.nearest_of([(terms, w)], k, [without])[0]

    def nearest_of(
        self, queries: list[tuple[tuple[int, ...], np.ndarray]], k: int, without: list[int] | None = None
    ) -> list[list[tuple[float, int]]]:
        """``nearest`` of many queries, ``TOGETHER`` at a time."""
        found: list[list[tuple[float, int]]] = []
        for at in range(0, len(queries), TOGETHER):
            some = queries[at : at + TOGETHER]
            found += self._nearest(some, k, without[at : at + TOGETHER] if without else [-1] * len(some))
        return found

    def _nearest(self, queries: list, k: int, without: list[int]) -> list[list[tuple[float, int]]]:
        if not self.blocks:
            return [[] for _ in queries]
        dense = np.zeros((len(queries), len(self.idf)))
        for i, (terms, w) in enumerate(queries):
            dense[i, list(terms)] = w
        bounds = dense @ self.tops
        cosines = np.zeros((len(queries), len(self.blocks) * BLOCK))
        best = np.zeros((len(queries), k))  # of each query the k largest cosines so far
        left_out = np.array(without)

        def visit(b: int, rows: np.ndarray) -> None:
            terms, weights = self.blocks[b]
            score = dense[np.ix_(rows, terms)] @ weights
            here = np.flatnonzero(left_out[rows] // BLOCK == b)
            score[here, left_out[rows[here]] % BLOCK] = 0.0
            cosines[rows, b * BLOCK : b * BLOCK + score.shape[1]] = score
            joined = np.concatenate([best[rows], score], axis=1)
            best[rows] = np.partition(joined, joined.shape[1] - k, axis=1)[:, -k:]

        first = bounds.argmax(axis=1)
        for b in np.unique(first):
            visit(int(b), np.flatnonzero((first == b) & (bounds[:, b] > 0)))
        for b in np.argsort(-bounds.max(axis=0), kind="stable"):
            # Cosines are rounded below; what a bound falls short by must be more than that.
            open_ = (first != b) & (bounds[:, b] > 0) & (bounds[:, b] >= best.min(axis=1) - 1e-11)
            if open_.any():
                visit(int(b), np.flatnonzero(open_))

        # Rounded for ties: equal vectors are equally near whatever the order of sums.
        cosines = np.round(cosines, 12)
        least = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, -k] if cosines.shape[1] > k else np.zeros(len(queries))
        out = []
        for row, bound in zip(cosines, least, strict=True):
            at = np.flatnonzero((row >= bound) & (row > 0))
            at = at[np.lexsort((at, -row[at]))][:k]
            out.append(list(zip(row[at].tolist(), at.tolist(), strict=True)))
        return out

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of the positive label among neighbours, each with its cosine squared and class weight."""
        if not near:
            return self.rate_without_terms
        rows = [r for _, r in near]
        w = np.array([s * s for s, _ in near]) * self.weights[rows]
        smooth = 0.05 * float(w.mean())  # a twentieth of a neighbour, at the classes' own rate
        return float((w @ self.labels[rows] + smooth * self.prior) / (w.sum() + smooth))

    def score(self, near: list[tuple[float, int]]) -> float:
        """The vote on the calibration curve."""
        return float(np.interp(self.vote(near), *self.curve)) if near else self.rate_without_terms

    def calibrate(self, votes: np.ndarray) -> None:
        """A rising curve from votes to label rates (pooled adjacent violators), from
        each example's neighbours without itself."""
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # weight, positive weight, vote weight
        for i in order:
            pools.append([self.weights[i], self.weights[i] * self.labels[i], self.weights[i] * votes[i]])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        if pools:
            one = float(np.mean(self.weights))
            rates = np.array([(p[1] + 0.5 * one * self.prior) / (p[0] + 0.5 * one) for p in pools])
            self.curve = (np.array([p[2] / p[0] for p in pools]), np.maximum.accumulate(rates))


def sampled(labels: DataFrame, limit: int, id_col: str, label: str, learn: Column) -> DataFrame:
    """id, y: per class the ``limit`` labelled ids of smallest hash, where ``learn`` holds.

    An id with several labels counts as positive if any is. Null labels are left out.
    """
    clean = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & learn)
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label)).cast("int").alias("y"))
    )
    picked = [clean.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(limit) for y in (0, 1)]
    return picked[0].union(picked[1])


def learn(
    docs: DataFrame, labels: DataFrame, learn_where: Column | None = None, limits: Limits = Limits(),
    id_col: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Index:
    """The index of labelled examples over the corpus ``docs``; see ``score``."""
    where = F.lit(True) if learn_where is None else learn_where
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    chosen = sampled(labels, limits.examples_per_class, id_col, label, where)
    # At most two classes of examples_per_class ids are broadcast; texts stay where they are.
    examples = staged(
        named.where("id IS NOT NULL").join(F.broadcast(chosen), "id")
        .groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("key"))
        .agg(F.first("text").alias("text"), F.min("id").alias("id"), F.max("y").alias("y")),
        "examples",
    )
    size = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    totals = {
        r["y"]: r["n"]
        for r in labels.where(F.col(label).isNotNull() & where).groupBy(F.col(label).cast("int").alias("y"))
        .agg(F.count("*").alias("n")).collect()
    }
    vocabulary = _telling_terms(examples, size.get(1, 0), size.get(0, 0), limits)
    documents, frequency = _document_frequencies(named, vocabulary)
    # The last term stands for all other words: it is in every document, so its idf is 1.
    idf = np.array([math.log((1 + documents) / (1 + frequency.get(t, 0))) + 1 for t in range(len(vocabulary))] + [1.0])

    rows = _example_counts(examples, vocabulary)
    share = {y: totals.get(y, 0) / size[y] for y in size}
    prior = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    bare = {0: 0.0, 1: 0.0}
    told, plain, last = [], [], len(vocabulary)
    for _, number, y, counts in rows:
        if counts:
            told.append((number, y, counts))
        else:
            bare[y] += share[y]
            plain.append((number, y, Counter({last: 1})))
    # Examples without a learnt term have one and the same vector: more than the first
    # ``neighbours`` of them can never be among the nearest.
    told += plain[: limits.neighbours]
    # Blocks hold examples of the same heaviest term, so that few blocks are visited.
    told.sort(key=lambda x: max((n * idf[t], t) for t, n in x[2].items() if t != last or len(x[2]) == 1)[::-1])
    index = Index(
        vocabulary, idf, [n for n, _, _ in told], np.array([float(y) for _, y, _ in told]),
        np.array([share[y] for _, y, _ in told]), (bare[1] + prior) / (bare[0] + bare[1] + 1), prior,
    )
    vectors = [index.vector(c) for _, _, c in told]
    index.fill(vectors)
    near = index.nearest_of(vectors, limits.neighbours, list(range(len(vectors))))
    index.calibrate(np.array([index.vote(n) for n in near]))
    return index


def _telling_terms(examples: DataFrame, positives: int, negatives: int, limits: Limits) -> dict[str, int]:
    """Terms whose presence differs between the classes, numbered.

    A term counts once for each different place it is first met in, that is the word
    and its neighbours, so that a family of copies does not make its words telling.
    """

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                out: tuple[list, list, list] = ([], [], [])
                for text, y in zip(batch["text"].to_pylist(), batch["y"].to_pylist(), strict=True):
                    words = ["", *words_of(text), ""]
                    first: dict[str, int] = {}
                    for i in range(1, len(words) - 1):
                        around = zlib.crc32(f"{words[i - 1]} {words[i]} {words[i + 1]}".encode())
                        for term in terms_of(words[i]):
                            first.setdefault(term, around)
                    out[0].extend(first)
                    out[1].extend([y] * len(first))
                    out[2].extend(first.values())
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64())], ["term", "y", "around"])

    contexts = examples.select("text", "y").mapInArrow(seen, "term string, y int, around long").distinct()
    counts = contexts.groupBy("term").agg(
        F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b")
    )
    n1, n0 = float(max(positives, 1)), float(max(negatives, 1))
    rate = (F.col("a") + F.col("b")) / (n1 + n0)

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("a"), rate * n1) + part(F.col("b"), rate * n0))
    best = (
        counts.withColumn("ratio", ratio).where(F.col("ratio") >= limits.least_evidence)
        .orderBy(F.desc("ratio"), "term").limit(limits.terms)
    )
    return {r["term"]: i for i, r in enumerate(best.select("term").collect())}


def _document_frequencies(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[int, dict[int, int]]:
    """Number of all documents, and of those that hold each term of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, rows = Known(shared.value), Counter(), 0
        for whole in batches:
            for batch in parts(whole, "text"):
                rows += batch.num_rows
                for text in batch["text"].to_pylist():
                    total.update(set(known.counts(text)))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *total], pa.int32()), pa.array([rows, *total.values()], pa.int64())], ["term", "n"])

    summed = docs.select("text").mapInArrow(counted, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in summed.collect()}  # at most one row a term of the vocabulary
    return found.pop(-1, 0), found


def _example_counts(examples: DataFrame, vocabulary: dict[str, int]) -> list[tuple]:
    """key, id, label and term counts of the sampled examples, in the order of their keys."""
    shared = examples.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for whole in batches:
            for batch in parts(whole, "text"):
                found = [known.counts(t) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["id"], batch["y"],
                     pa.array([list(c) for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                    ["key", "id", "y", "terms", "counts"],
                )

    schema = "key string, id long, y int, terms array<int>, counts array<int>"
    rows = examples.select("key", "id", "y", "text").mapInArrow(counted, schema).orderBy("key").collect()
    return [(r["key"], r["id"], r["y"], Counter(dict(zip(r["terms"], r["counts"], strict=True)))) for r in rows]


def score(docs: DataFrame, index: Index, neighbours: int = Limits.neighbours, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, evidence for every row of ``docs``; see ``annotate``."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return annotate(picked, index, neighbours, "text").select(
        "doc_id", F.col("toxicity").alias("score"), F.col("toxicity_evidence").alias("evidence")
    )


def annotate(docs: DataFrame, index: Index, neighbours: int = Limits.neighbours, text: str = "text") -> DataFrame:
    """``docs`` with toxicity and toxicity_evidence, every row.

    ``toxicity`` is the calibrated share of the positive label among the nearest
    examples; the evidence holds the nearest three as (doc_id, label, cosine). A text
    without any learnt term, null and empty ones too, gets the smoothed rate of
    such texts and no evidence. Without labels every score is 0.5. Only the text is
    looked at. Other columns stay; columns of the new names are replaced. No
    shuffle: the bounded index is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    base = docs.drop("toxicity", "toxicity_evidence")
    evidence_type = T.ArrayType(T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("cosine", T.DoubleType()),
    ]))
    schema = T.StructType([
        *base.schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("toxicity_evidence", evidence_type),
    ])
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cache = shared.value, {}
        known = Known(index.vocabulary)
        for whole in batches:
            for batch in parts(whole, text):
                counts = [known.counts(t) for t in batch[text].to_pylist()]
                keys = [tuple(sorted(c.items())) for c in counts]
                if len(cache) + len(keys) > CACHED_QUERIES:
                    cache.clear()
                new = {key: c for key, c in zip(keys, counts, strict=True) if key not in cache}
                # A text without terms has no vector and so no neighbours.
                near = index.nearest_of([index.vector(c) for c in new.values()], neighbours)
                for key, n in zip(new, near, strict=True):
                    cache[key] = (index.score(n), [
                        {"doc_id": index.ids[r], "label": int(index.labels[r]), "cosine": s} for s, r in n[:3]
                    ])
                scores, evidence = [cache[key][0] for key in keys], [cache[key][1] for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                    [*batch.schema.names, "toxicity", "toxicity_evidence"],
                )

    return base.mapInArrow(run, schema)
