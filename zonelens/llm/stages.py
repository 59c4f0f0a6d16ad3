"""The stages of the corpus pipeline: each takes and returns documents with their columns, the last adds tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm import byte_bpe, decontaminate, language_id, quality_rules, simhash
from zonelens.llm.common import column, free_name, read

# A text is rejected by language if it has none, or if this share of it, weighed by how sure the model is, is not in
# one language.
LEAST_SURE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language."""
    model = language_id.learn(docs.filter(~language_id.held_out(F.col("doc_id"))))
    name = free_name(docs, "language")
    found = language_id.identify(docs, model, out=name)
    sure = (F.col(name)["lang_pred"] != language_id.UNKNOWN) & (F.col(name)["score"] >= LEAST_SURE)
    return found.filter(sure).select(*map(column, docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark items."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every document; ids are little-endian unsigned 32-bit integers."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, pattern).drop("text")
    both = byte_bpe.decode(encoded, path, pattern)
    return both.select(
        "doc_id", "lang", "source", byte_bpe.n_ids(F.col("ids")).alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )
