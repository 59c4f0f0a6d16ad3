"""From raw documents to tokens: language, quality, near-duplicates, benchmark contamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonelens.llm import stages
from zonelens.llm.common import read, stage

STAGES = [
    ("language_id", stages.language),
    ("quality_rules", stages.quality),
    ("simhash_near_dedup", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("byte_bpe", stages.tokens),
]

# Language models, fingerprints and merges have no SQL form; tests compare the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; every stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
