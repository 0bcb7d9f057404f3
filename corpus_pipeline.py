"""The corpus pipeline: quality, exact dedup, near dedup, decontamination, packing.

Each stage works on all that the one before kept, written as Parquet and read again. All but the last return the
columns of ``documents``; the last returns the pieces of packed sequences.

Defined results, in every stage: a null text is empty; an empty or very long text is judged whole like any other; null
ids, languages, sources and counts change nothing; extra columns pass through all stages but the last, whatever their
names; of repeated rows one stays after exact dedup; an empty table gives an empty result. Empty texts have no shingles
and match no benchmark item, so the near-dedup and decontamination stages keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tielens.llm import decontaminate, jaccard_join, packing, quality, quotient_dedup, tokens
from tielens.sources.shared import landed


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return quotient_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by shingles join."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences."""
    return packing.pack(docs, tokens.default_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: SQL can't express the classifier, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = landed(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
