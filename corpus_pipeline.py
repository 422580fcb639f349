"""The corpus pipeline: stages applied to ``documents`` in order.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is what the stage
before it kept (written as Parquet and read again), and returns the rows that
stay with the columns of ``documents``; the last returns the tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover.llm import decontam, exact_dedup, langid, ngram_join, sentencepiece
from rxcover.llm.common import read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return langid.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, one stays."""
    return exact_dedup.keep_first_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles (Jaccard 0.8 or more), one stays."""
    return ngram_join.keep_representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, and whether they decode to its text."""
    out = sentencepiece.encode(docs, ["doc_id", "lang", "source"])
    return out.withColumn("n_pieces", F.size("pieces").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece encoding and decoding", tokenize),
]

# The classifier and the tokenizer have no SQL form; tests/llm/test_pipeline.py
# holds the pipeline against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
