"""A corpus pipeline of five training-data operators, each stage a function (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import byte_bpe, exact_dedup, jaccard_join, mixing, quality
from skyledger.llm._common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by shared shingles the one with the smallest id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row, encoded and decoded again."""
    return byte_bpe.digests(docs, byte_bpe.default_path())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", encoding),
]

#: Mixing and tokenizing can't be written in SQL; the whole is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
