"""Documents to packed training sequences, a stage at a time.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; each result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstrata.llm import decontamination, jaccard, language_id, line_dedup, packing
from matchstrata.llm.common import scan
from matchstrata.session import stage

#: Similar documents share four fifths of their five-word shingles. (op9 keeps the rule of its SQL.)
SIMILAR = jaccard.Rule(words=5, at_least=80)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language that the classifier is sure of, go."""
    return language_id.in_known_language(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated long lines go; a document that consists of nothing else goes as a whole."""
    kept = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_equal") + F.col("n_near") > 0) & ~F.col("text").rlike(r"\S")  # blank lines may be left
    changed = F.col("n_equal") + F.col("n_near") > 0
    counted = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.where(~emptied | F.col("text").isNull()).withColumn("n_chars", counted).select(*docs.columns)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    return jaccard.one_of_each(docs, SIMILAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.without_benchmark(docs, scan(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their place in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("jaccard_join", one_of_similar),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Not expressible in SQL: a trained network and a tokenizer take part.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = scan(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}").df
    return docs
