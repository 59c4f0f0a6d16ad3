"""The pipeline against plain Python, stage by stage, and the registered queries of this subpackage."""

import base64
import hashlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_quality_rules import slow_counts, slow_distance
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.oracle_check import compare, duck
from zonelens.llm import decontaminate, language_id, quality_rules, queries, stages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 10_000)
    odd = spark.createDataFrame([(None, None, "en", None, None), (20_000, "", None, "s", 0), (20_001, "123 456 " * 60, "en", "s", 480)], docs.schema)
    first = docs.orderBy("doc_id").limit(2)
    return docs.unionByName(more).unionByName(odd).unionByName(first)


def kept_by_language(docs, rows):
    model = language_id.learn(docs.filter(~language_id.held_out(F.col("doc_id"))))
    words = language_id.Words(model)
    found = [language_id.label(words, r["text"]) for r in rows]
    return [r for r, (lang, score, _) in zip(rows, found, strict=True) if lang != "und" and score >= stages.LEAST_SURE]


def kept_by_quality(rows):
    limits = quality_rules.Limits()
    counts = [slow_counts(r["text"]) for r in rows]
    total = lambda at, kind: [sum(x) for x in zip(*(counts[i][kind] for i in at), strict=True)]
    out = []
    for r, c in zip(rows, counts, strict=True):
        own = [i for i, x in enumerate(rows) if x["lang"] is not None and x["lang"] == r["lang"]]
        use = own if sum(counts[i]["n_words"] for i in own) >= limits.reference_words else range(len(rows))
        n = c["n_words"]
        failed = n < 50 or 100 * c["n_repeat_words"] > 50 * n
        if not failed:
            failed = c["word_chars"] >= limits.class_chars and slow_distance(c["classes"], total(use, "classes")) > limits.max_class_distance + limits.class_noise / n**0.5
            failed |= slow_distance(c["common"], total(use, "common")) > limits.max_word_distance + limits.word_noise / n**0.5
        if not failed:
            out.append(r)
    return out


def kept_once(rows):
    classes = {(k, fp): least for k, fp, least in slow_components([r["doc_id"] for r in rows], [slow_fingerprint(r["text"]) for r in rows])}
    seen, out = set(), []
    for r in rows:
        least = classes[r["doc_id"], slow_fingerprint(r["text"])]
        if r["doc_id"] == least and least not in seen:
            seen.add(least)
            out.append(r)
    return out


def kept_clean(spark, rows):
    items = [decontaminate.tokens_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [i for i in items if len(i) >= decontaminate.MIN_MATCH]
    hit = lambda words: any(decontaminate.coverage(i, [words]) >= decontaminate.THRESHOLD for i in items)
    return [r for r in rows if not hit(decontaminate.tokens_of(r["text"]))]


def test_stages_equal_plain_python(spark, documents):
    from zonelens.llm.common import stage

    docs, rows = documents, documents.collect()
    expected = [lambda d, r: kept_by_language(d, r), lambda _, r: kept_by_quality(r), lambda _, r: kept_once(r), lambda _, r: kept_clean(spark, r)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_near_dedup", "decontamination", "byte_bpe"]
    for (name, apply), plain in zip(corpus_pipeline.STAGES, expected, strict=False):
        rows = plain(docs, rows)
        docs = stage(apply(spark, docs, SF), f"test-{name}")
        assert docs.columns == documents.columns
        key = lambda r: (r["doc_id"] or -1, r["text"] or "")
        assert sorted(map(key, docs.collect())) == sorted(map(key, rows)), name
        assert len(rows) > 50, name
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert len(last) == len(rows)
    for r in rows:
        got = last[r["doc_id"]]
        assert bytes(got["ids"]) == array("I", library.encode_ordinary(r["text"])).tobytes()
        assert got["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_empty_documents_pass_every_stage(spark, documents):
    for name, apply in corpus_pipeline.STAGES:
        assert apply(spark, documents.filter("doc_id < -5"), SF).count() == 0, name


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)} and len(queries.QUERIES) == 13
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF) == ""
