"""A training corpus in five stages, each on all rows that the one before kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame.  All but the last return the columns of
``documents`` (doc_id, text, lang, source, n_chars), with ``n_chars`` as long
as the text they return; the last returns the packed pieces.  ``run`` writes
every stage's result as Parquet and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import jaccard, lines, packing, pii, toxicity
from quarry.llm.common import WorkFolder


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose clauses score 0.7 or more go; learned from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, labels, WorkFolder(spark), threshold=0.7)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on over 8 % of their source's different texts go; every document
    stays, and copies keep their text for the stage that leaves one of them."""
    return _measured(lines.drop_boilerplate(docs, "source", "text", WorkFolder(spark), ratio=0.08, min_pages=3,
                                            copies=False))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays (5-word shingles, 0.8)."""
    return jaccard.drop_near_duplicates(docs, WorkFolder(spark), k=5, percent=80)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, disguised or not, is replaced by its kind."""
    return _measured(pii.redact_pii(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids."""
    return packing.pack(docs, WorkFolder(spark), capacity=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_pii),
    ("packing", pack),
]

#: No SQL: the stages score, deobfuscate, tokenise and solve; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    work = WorkFolder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = None
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
        if held is not None:
            work.drop(held)
        held = docs
    return docs
