"""Token counts of texts by a sentencepiece BPE model, without ids.

The model never merges across a boundary between a piece's end and the next white-space mark, nor across a line break,
so a text is cut there into pre-tokens and its count is the sum over them.  The steps:

1. All documents give the corpus frequency of every distinct pre-token (partial counts in tasks, one shuffle).
2. Every distinct pre-token is counted once by the library and the table of counts is written.
3. Every document gives its pre-token frequencies.  The most frequent pre-tokens, a stated number, are answered from a
   broadcast of that size at most; all others are joined to the table and summed.  The result is the same for any size.

Defined results: null counts as empty, with no tokens; rows that repeat are counted one by one; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.llm.common import pick, ship, stage

# The mark that the library puts for a space.
MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
# Pre-tokens answered without a join; about 20 MB in a worker.
FREQUENT = 400_000
# Distinct pre-tokens a task holds before it hands them on.
HELD = 800_000


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


@lru_cache(maxsize=2)
def processor(blob: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=blob)


def count_each(model: sentencepiece.SentencePieceProcessor, tokens: list[str]) -> list[int]:
    """Number of pieces of each pre-token, as a part of a longer text.

    The library puts a mark before every text.  A pre-token that begins with a mark leaves that one out; any other
    follows a line break, so it is counted behind one, whose two tokens (mark and break) are taken off.
    """
    texts = [t[1:] if t[0] == MARK else "\n" + t for t in tokens]
    found = model.encode(texts, num_threads=1)
    return [max(1, len(ids)) if t[0] == MARK else len(ids) - 2 for t, ids in zip(tokens, found, strict=True)]


def usable(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether the model's pieces keep to the boundaries of :data:`PRE_TOKEN` and its texts are taken as they are."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    cut = any(MARK in p.lstrip(MARK) or ("\n" in p and p != "\n") for p in pieces)
    probes = ["a", " a", "a  b", "a\nb \n c ", "\n", " ", "ﬁ é", "the cat\tsat"]
    return not cut and all(len(model.encode(p)) == sum(count_each(model, pre_tokens(p))) for p in probes)


def distinct_pre_tokens(docs: DataFrame, text: str) -> DataFrame:
    """pre_token, n: corpus frequency of every distinct pre-token."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for t in batch["text"]:
                held.update(pre_tokens(t or ""))
                if len(held) >= HELD:
                    yield pd.DataFrame({"pre_token": list(held), "n": list(held.values())})
                    held = Counter()
        yield pd.DataFrame({"pre_token": pd.Series(list(held), dtype=object), "n": pd.Series(list(held.values()), dtype="int64")})

    rows = pick(docs, text=text).select(F.col("text").cast("string")).mapInPandas(partial, "pre_token string, n long")
    return rows.groupBy("pre_token").agg(F.sum("n").alias("n"))


def counted_pre_tokens(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """pre_token, n, pieces: the table of step 2, written to the shared folder."""
    ship(docs.sparkSession)
    with open(model_file, "rb") as f:
        blob = f.read()
    if not usable(processor(blob)):
        raise ValueError("the model does not keep to pre-token boundaries")
    shared = docs.sparkSession.sparkContext.broadcast(blob)

    @F.pandas_udf("int")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = processor(shared.value)
        for tokens in batches:
            yield pd.Series(count_each(model, list(tokens)), dtype="int32")

    found = distinct_pre_tokens(docs, text)
    return stage(found.select("pre_token", "n", pieces("pre_token").alias("pieces")), "pre-token-counts")


def frequent_pre_tokens(table: DataFrame, most: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, at most ``most`` of them.

    The least frequency that counts comes from a histogram over eighths of a power of two, so nothing is sorted and
    never more than ``most`` rows reach the driver.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    sizes = sorted(((r["step"], r["size"]) for r in table.groupBy(step.alias("step")).agg(F.count("*").alias("size")).collect()), reverse=True)
    least, total = None, 0
    for at, size in sizes:
        total += size
        if total > most:
            break
        least = at
    if least is None:
        return {}
    rows = table.filter(step >= least).select("pre_token", "pieces").toLocalIterator()
    return {r["pre_token"]: r["pieces"] for r in rows}


def count_tokens(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every document.

    A document sends one row with its bytes and the sum that the broadcast knows; that row's pre-token matches nothing
    (no pre-token has a line break followed by more) and differs by row, so such rows spread evenly.
    """
    table = counted_pre_tokens(docs, model_file, text)
    known = docs.sparkSession.sparkContext.broadcast(frequent_pre_tokens(table, frequent))
    narrow = pick(docs, id=doc_id, text=text)
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("id", narrow.schema["id"].dataType),
            T.StructField("pre_token", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
        ]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = known.value.get
        for batch in batches:
            row, tokens, counts, sizes = [], [], [], []
            keys = batch.column("key")
            for i, t in enumerate(batch.column("text").to_pylist()):
                total = 0
                for token, n in Counter(pre_tokens(t or "")).items():
                    pieces = find(token)
                    if pieces is None:
                        row.append(i)
                        tokens.append(token)
                        counts.append(n)
                        sizes.append(0)
                    else:
                        total += pieces * n
                row.append(i)
                tokens.append(f"\n{keys[i]}")
                counts.append(total)
                sizes.append(len((t or "").encode("utf-8")))
            at = pa.array(row, pa.int32())
            columns = [keys.take(at), batch.column("id").take(at), pa.array(tokens, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "id", "pre_token", "n", "n_bytes"])

    keyed = narrow.select(F.monotonically_increasing_id().alias("key"), "id", F.col("text").cast("string"))
    rows = keyed.mapInArrow(split, schema)
    joined = rows.join(table.select("pre_token", "pieces"), "pre_token", "left")
    worth = F.col("n") * F.coalesce("pieces", F.lit(1))
    out = joined.groupBy("key", "id").agg(F.sum("n_bytes").alias("n_bytes"), F.sum(worth).alias("n_tokens"))
    return out.select(F.col("id").alias(doc_id), "n_bytes", "n_tokens")
