"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

Tokens are words and runs of other signs.  A word written in capitals counts as one special word.  A token's hash gives
its row among a fixed number of rows, so the vocabulary takes the same memory for any corpus.  Every row has a fixed
sparse random index vector.  The word vector of a row is the sum of the index vectors of the tokens around its
occurrences in *all* documents, brought to unit length, with its own index vector beside it.

A document is the mean and the spread of its word vectors, with the logarithm of its length.  The network is fitted on
a bounded, stated sample of labelled documents (``sample_docs`` in expectation, chosen by a hash of the id); one part
of the sample only sets the temperature that calibrates the probabilities.

Defined results: null and empty texts, and texts without tokens, are a document of length zero and are scored like any
other; rows whose label or id is null teach nothing; a document with several labels teaches each; without labels, or
with one label only, every score is the share of label 1 (0.5 without labels); repeated rows give repeated rows; an
empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm.common import chunks, column, crc_mod, free_name, pick, ship

TOKENS = re.compile(r"\w+|[^\w\s]+")
ROWS = 1 << 14
DIM = 32
# Ones and minus ones in an index vector.
SIGNS = 4
# Tokens on each side that count as around.
REACH = 2
SEED = 20240101
# Labelled documents that the network is fitted on, in expectation.
SAMPLE_DOCS = 20_000
HIDDEN = 32
EPOCHS = 60
BATCH = 64
RATE = 0.01
DECAY = 1e-4
# Share of the sample that sets the temperature.
CALIBRATION = 0.2
THRESHOLD = 0.7
REMEMBERED = 500_000
CHUNK_CHARS = 1_000_000
# Word vectors are summed in this many parts.
PARTS = 64


def index_vectors() -> np.ndarray:
    """Sparse vectors of ones and minus ones, the same everywhere; the row after the last is the blank between texts."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((ROWS + 1, DIM), np.int8)
    places = np.argsort(rng.random((ROWS, DIM)), axis=1)[:, :SIGNS]
    signs = np.where(np.arange(SIGNS) % 2, -1, 1)
    out[np.arange(ROWS)[:, None], places] = signs
    return out


class TokenRows(dict):
    """Token -> row."""

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        name = "\\x00capitals" if len(token) > 1 and token.isupper() else token.lower()
        self[token] = row = zlib.crc32(name.encode("utf-8")) % ROWS
        return row


def rows_of(text: str | None, rows: TokenRows) -> np.ndarray:
    found = TOKENS.findall(text) if text else []
    return np.fromiter(map(rows.__getitem__, found), np.int32, len(found))


def add_contexts(total: np.ndarray, ids: list[np.ndarray], index: np.ndarray) -> None:
    """Add to every row the index vectors of the tokens around its occurrences; texts do not see one another."""
    blank = np.full(REACH, ROWS, np.int32)
    line = np.concatenate([x for own in ids for x in (own, blank)] or [blank])
    vectors = index[line].astype(np.int16)
    around = np.zeros_like(vectors)
    for k in range(1, REACH + 1):
        around[k:] += vectors[:-k]
        around[:-k] += vectors[k:]
    order = np.argsort(line, kind="stable")
    ordered = line[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=-1))
    total[ordered[starts]] += np.add.reduceat(around[order], starts, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The word vectors over all documents, ROWS x 2 DIM; their size does not depend on the corpus.

    A task sums its documents and sends PARTS blocks; blocks of one part meet in one task, which adds them one by one.
    """
    ship(docs.sparkSession)
    width = ROWS // PARTS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, rows = index_vectors(), TokenRows()
        total = np.zeros((ROWS + 1, DIM), np.int64)
        for batch in batches:
            for texts in chunks((t for t in batch.column(0).to_pylist() if t), CHUNK_CHARS):
                add_contexts(total, [rows_of(t, rows) for t in texts], index)
        blocks = [total[k * width : (k + 1) * width].tobytes() for k in range(PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(blocks, pa.binary())], ["part", "block"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(block, np.int64)
                sums[part] = sums[part] + values if part in sums else values
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "block"])

    schema = "part int, block binary"
    blocks = pick(docs, text=text).select(F.col("text").cast("string")).mapInArrow(partial, schema)
    summed = blocks.repartition(PARTS, "part").mapInArrow(add, schema)
    total = np.zeros((ROWS, DIM))
    for r in summed.collect():  # ROWS x DIM numbers in all
        total[r["part"] * width : (r["part"] + 1) * width] += np.frombuffer(r["block"], np.int64).reshape(width, DIM)
    length = np.linalg.norm(total, axis=1, keepdims=True)
    own = index_vectors()[:ROWS] / np.sqrt(SIGNS)
    return np.hstack([total / np.maximum(length, 1e-9), own]).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of a document, and the logarithm of its length."""
    width = vectors.shape[1]
    out = np.zeros(2 * width + 1, np.float32)
    if len(ids):
        seen, counts = np.unique(ids, return_counts=True)
        share = (counts / len(ids)).astype(np.float32)
        own = vectors[seen]
        mean = share @ own
        out[:width] = mean
        out[width:-1] = np.sqrt(np.maximum(share @ (own * own) - mean * mean, 0))
        out[-1] = np.log1p(len(ids))
    return out


@dataclass
class Network:
    """Standardising shift and scale, two layers, and the temperature; without layers, a constant score."""

    shift: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float
    constant: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.shift) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), self.constant)
        return sigmoid(self.logits(features.astype(np.float64)) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def loss_of(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit(features: np.ndarray, labels: np.ndarray) -> Network:
    """Adam on the log loss; then the temperature of least log loss on the part that was not fitted on."""
    if not len(labels) or labels.min() == labels.max():
        return Network(np.zeros(0), np.ones(0), (), 1.0, float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(labels))
    features, labels = features[order].astype(np.float64), labels[order].astype(np.float64)
    held = int(len(labels) * CALIBRATION)
    x, y, x_held, y_held = features[held:], labels[held:], features[:held], labels[:held]
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - shift) / scale
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = shuffled[at : at + BATCH]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            error = (sigmoid(hidden @ params[2] + params[3]) - y[rows]) / len(rows)
            back = error[:, None] * params[2] * (1 - hidden * hidden)
            grads = [z[rows].T @ back + DECAY * params[0], back.sum(axis=0), hidden.T @ error + DECAY * params[2], error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(shift, scale, tuple(params), 1.0, 0.5)
    if held and y_held.min() != y_held.max():
        logits = net.logits(x_held)
        choices = np.exp(np.linspace(np.log(0.25), np.log(20), 200))
        net.temperature = float(min(choices, key=lambda t: loss_of(logits / t, y_held)))
    return net


def sample_features(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Pooled features and labels of the sample; ``docs`` has id and text, ``labels`` id and label."""
    known = labels.filter("id IS NOT NULL AND label IS NOT NULL")
    total = known.count()
    if not total:
        return np.zeros((0, 0)), np.zeros(0)
    chance = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(11)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    chosen = known.filter(chance < min(1.0, sample_docs / total))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    @F.pandas_udf("binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rows = TokenRows()
        for texts in batches:
            yield pd.Series([pooled(rows_of(t, rows), shared.value).tobytes() for t in texts], dtype=object)

    joined = docs.join(chosen, "id").select("id", F.col("label").cast("double").alias("label"), features("text").alias("f"))
    got = sorted((r["id"], r["label"], bytes(r["f"])) for r in joined.collect())
    if not got:
        return np.zeros((0, 0)), np.zeros(0)
    return np.stack([np.frombuffer(f, np.float32) for _, _, f in got]), np.array([y for _, y, _ in got])


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", label_id: str = "doc_id", sample_docs: int = SAMPLE_DOCS,
) -> Classifier:
    """Word vectors from all of ``docs``; the network from the rows of ``labels``, all of which may teach."""
    vectors = word_vectors(docs, text)
    narrow = pick(docs, id=doc_id, text=text).select("id", F.col("text").cast("string"))
    return Classifier(vectors, fit(*sample_features(narrow, pick(labels, id=label_id, label=label), vectors, sample_docs)))


def scorer(spark: SparkSession, model: Classifier):
    """A column function: text -> score."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rows = TokenRows()
        for texts in batches:
            held = shared.value
            features = [pooled(rows_of(t, rows), held.vectors) for t in texts]
            yield pd.Series(held.network.scores(np.stack(features)) if features else np.zeros(0))

    return score


def classify(df: DataFrame, model: Classifier, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score of every whole text."""
    return df.withColumn(out, scorer(df.sparkSession, model)(column(text).cast("string")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 4) == 2, F.lit(False))


def teaching(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``labels`` that are not held out."""
    name = free_name(labels, "held_out")
    return labels.withColumn(name, held_out(column(doc_id))).filter(~F.col(name)).drop(name)
