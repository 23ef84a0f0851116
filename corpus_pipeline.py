"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and returns a DataFrame.

quality rules -> SimHash near-duplicates -> secret scans -> source mixing -> byte-level BPE.
All but the last return the columns of ``documents``; ``run`` writes each stage's
result as Parquet to the shared folder and hands the reread table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citymotion.llm import bpe, mixing, quality, secret_scan, simhash
from citymotion.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_first(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by ``[kind]`` in the text; all documents stay."""
    return secret_scan.redact(docs, length_col="n_chars")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that tokens follow the target weights."""
    return mixing.sample(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its number of tokens and the digests of its ids and decoded bytes."""
    return bpe.with_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("byte_level_bpe", byte_level_bpe),
]

# The tokeniser measures and the fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
