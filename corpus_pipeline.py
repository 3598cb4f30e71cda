"""The corpus pipeline: judge, de-duplicate, mix and pack documents.

Each stage works on all rows its predecessor kept and is written before the
next one reads it.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm.exact import drop_exact_duplicates
from loomwork.llm.minhash import drop_near_duplicates
from loomwork.llm.mixing import apply_mix, mix, quality_weights
from loomwork.llm.packing import packed_documents
from loomwork.llm.quality import keep_good, trusted_documents
from loomwork.session import stage

# Hashed n-grams are beyond SQL that two engines share.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs, trusted_documents(_labels(spark, sf_dir)))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id."""
    return drop_exact_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return apply_mix(docs, mix(docs, quality=quality_weights(_labels(spark, sf_dir))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: pieces, sequences and offsets."""
    return packed_documents(docs)


STAGES = [
    ("quality_rules", judge),
    ("exact_dedup", dedup_exact),
    ("near_dedup", dedup_near),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace("_", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
