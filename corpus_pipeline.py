"""The corpus pipeline: stages that each filter or rewrite documents, in order.

Every stage works on all that the one before kept and is written to the shared
folder before the next reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.llm import fuzzy_lines, minhash_docs, piece_bpe, spaced_seeds, toxicity
from seriesmart.llm.queries import held_out, table, vocabulary
from seriesmart.llm.staging import ship, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECT_FROM = 0.7


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``REJECT_FROM``.

    Labels are learnt from as in op6_toxicity. Rows without an id are scored too.
    """
    index = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.annotate(docs, index).where(F.col("toxicity") < REJECT_FROM).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line holds.

    A document that had lines and keeps none says nothing new and goes; one that was
    blank from the start stays. ``n_chars`` follows the text.
    """
    cut = fuzzy_lines.dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_lines") > 0) & (F.size("dropped") >= F.col("n_lines"))
    return cut.where(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Null texts and texts without words are like nothing and stay, as do rows without an
    id. Rows of one id stay or go together. No rows give no rows.
    """
    ship(spark)
    judged = minhash_docs.near_duplicates(docs)
    gone = staged(judged.where("NOT kept").select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark text; rows without an id are judged by their text."""
    judged = spaced_seeds.flagged(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept text, and whether decoding them gives the text again.

    Null and empty texts have the end id alone; repeated rows are encoded each. Other
    columns than those of documents are not read. No rows give no rows.
    """
    ship(spark)
    model = vocabulary("piece_bpe_32k.model")
    return piece_bpe.encode(docs.select(*COLUMNS), model, decoded="decoded").select(
        "doc_id", "lang", "source", "tokens",
        F.size("tokens").cast("long").alias("n_tokens"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", dedup_documents),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]
#: Scores, signatures and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
