"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stanzaflow.llm import exact, langid, mixing, piece, simhash
from stanzaflow.llm.common import Scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (3): documents that it rejects go."""
    return langid.keep_known(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup (10): of equal texts the row with the largest doc_id stays."""
    return exact.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (1): of each group the document with the smallest doc_id stays."""
    return simhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources (9): a row for each time a document is taken; one not taken goes."""
    return mixing.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece (4): ids and decoded texts as counts and digests."""
    return piece.digests(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: Language ID and SentencePiece have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs, name)
            if i:
                scratch.drop(STAGES[i - 1][0])
    return docs
