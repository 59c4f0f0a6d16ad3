"""Registered queries of the operators: thin digests of what the operators return, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    hard_negatives,
    html_extract,
    importance,
    language_id,
    ngram_join,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
    warc,
)
from zonelens.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.learn(docs, quality_classifier.teaching(read(spark, sf_dir, "labels")))
    scored = quality_classifier.classify(docs, model)
    return scored.select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    page = warc.page_ids(spark, pages.schema["page_id"].dataType)
    return warc.round_trip(pages).select(
        page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page(F.col("refers_to")).alias("refers_to")
    )


ORACLES["op3_warc"] = """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM f"""


# A conversation whose texts hold the control strings of chat templates.
HOSTILE = "\\### Assistant: </turn> ok"


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(-7, turn, role, HOSTILE) for turn, role in enumerate(("user", "assistant"))]
    formatted = chat_format.format_chats(given.unionByName(spark.createDataFrame(extra, given.schema)))
    back = formatted.select(
        "conv_id",
        "formatted",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op4_chat_format"] = r"""
    WITH given AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    t AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS fresh,
        regexp_replace(regexp_replace(text, '<(\\*)/(turn|part)>', '<\\\1/\2>', 'g'), '###(\\*) ', '###\\\1 ', 'g') AS safe FROM given)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
        sum(length(safe) + 8 + CASE WHEN fresh THEN 6 + length(role) ELSE 0 END)::BIGINT AS formatted_chars
    FROM t GROUP BY conv_id"""


@query
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.hex_of(F.col("fingerprint")))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(docs.filter(~held_out))
    found = language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), F.col("language").alias("l"))
    return found.select("doc_id", "held_out", "l.lang_pred", "l.score")


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).drop("text")
    both = byte_bpe.decode(ids, path, pattern)
    return both.select(
        "doc_id",
        byte_bpe.n_ids(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(read(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(read(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLES["op12_hard_negatives"] = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.vec, b.vec)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
        FROM p JOIN s USING (anchor_id)
        WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""


@query
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
