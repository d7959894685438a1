"""Corpus pipeline: documents through five operators, each stage written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor
kept. The first four return the columns of documents; the last returns the encoding.
Null and empty texts are documents like any other: they are never toxic, equal each
other, and have no pieces. An empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessitura.llm import decontam, exact, pieces, simhash, toxicity
from tessitura.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine, fitted on the labelled ones, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one with the largest doc_id."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near fingerprints, the one with the smallest doc_id."""
    return simhash.one_per_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised or not."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts, digests of ids and of the decoded text."""
    return pieces.piece_counts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding and decoding", encode),
]

#: A string-kernel machine and fingerprints have no SQL form; tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name.split()[0].lower()}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
