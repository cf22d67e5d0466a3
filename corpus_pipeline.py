"""The corpus pipeline: five stages over the documents table, each on all that its predecessor kept.

Toxic documents go, then those of low quality, then exact copies, then all but one document of each
near-duplicate class; what is left is packed into training sequences. Every stage but the last
returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemoor.llm import quality, toxicity
from lakemoor.llm.exact_dedup import keep_first
from lakemoor.llm.near_dedup import keep_one
from lakemoor.llm.packing import pack
from lakemoor.llm.shared import discard, materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the weakly supervised classifier calls toxic (fitted on labelled documents of the input)."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose probability of an acceptable grade is below one half."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id stays."""
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest doc_id stays."""
    return keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: SQL cannot express the fitted stages; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is a table in the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "-"))
            if i:
                discard(before)
    return docs
