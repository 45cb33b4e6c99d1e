"""From raw documents to packed training sequences: five stages, each one operator of ``flightlake.llm``.

Every stage works on all that its predecessor kept. It is written as Parquet and read back as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flightlake.llm import contamination, cotrain, jaccard, lines, packing
from flightlake.llm.common import stage
from flightlake.llm.queries import table, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good and not toxic."""
    return cotrain.accepted(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    return lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, similarity 0.8."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the spans cut out that they share with benchmark items."""
    return contamination.without_spans(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of the documents stand in sequences of 1024 tokens."""
    return packing.packed_documents(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]
#: Training, hashing and tokenizing are beyond SQL; the stages are tested one by one and together.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
