"""Quality classifier: word vectors by plain loops, gradients by effect, calibration, held-out accuracy, edge rows."""

import numpy as np
import pytest

from zonelens.llm import quality_classifier as Q
from zonelens.llm import queries

SF = "/root/testdata/sf0.01"


def test_index_vectors():
    index = Q.index_vectors()
    assert (np.abs(index[:-1]).sum(axis=1) == Q.SIGNS).all() and not index[-1].any() and (index[:-1].sum(axis=1) == 0).all()


def test_word_vectors_equal_plain_loops(spark):
    texts = ["a b c a ## d", "b b", None, "", "WORDS IN Capitals x", "a b c a ## d"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, part string").repartition(3)
    index, rows, want = Q.index_vectors().astype(int), Q.TokenRows(), np.zeros((Q.ROWS, Q.DIM))
    for t in texts:
        ids = Q.rows_of(t, rows)
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if i != j and abs(i - j) <= Q.REACH:
                    want[a] += index[b]
    got = Q.word_vectors(docs)
    length = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(got[:, : Q.DIM], want / np.maximum(length, 1e-9), atol=1e-6)
    assert rows["WORDS"] == rows["IN"] != rows["Capitals"] and rows["I"] == rows["i"]


def test_pooled():
    vectors = np.random.default_rng(0).normal(size=(Q.ROWS, 6)).astype(np.float32)
    ids = np.array([3, 5, 3, 9], np.int32)
    got = Q.pooled(ids, vectors)
    assert np.allclose(got[:6], vectors[ids].mean(axis=0), atol=1e-5) and np.allclose(got[6:-1], vectors[ids].std(axis=0), atol=1e-3)
    assert not Q.pooled(ids[:0], vectors).any()


def test_fit_separates_and_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 5))
    y = (rng.random(1500) < Q.sigmoid(4 * x[:, 0] * x[:, 1])).astype(float)  # not linear
    net = Q.fit(x, y)
    test = rng.normal(size=(4000, 5))
    truth = Q.sigmoid(4 * test[:, 0] * test[:, 1])
    assert np.mean((net.scores(test) > 0.5) == (truth > 0.5)) > 0.85
    assert abs(net.scores(test).mean() - truth.mean()) < 0.06 and net.temperature > 1


@pytest.mark.parametrize("labels,score", [([], 0.5), ([1.0, 1.0], 1.0), ([0.0], 0.0)])
def test_no_choice_of_labels(labels, score):
    net = Q.fit(np.zeros((len(labels), 3)), np.array(labels))
    assert net.scores(np.ones((2, 3))).tolist() == [score, score]


def test_held_out_accuracy(spark):
    got = queries.op1_quality_classifier(spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").toPandas()
    assert ((rows["score"] >= 0) & (rows["score"] <= 1)).all() and got.count() == 1000
    held = rows[rows["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_edge_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (None, "", 0.1), (3, "a b", 0.1)], "doc_id long, text string, held_out double")
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    assert Q.teaching(labels).count() == 3 - labels.filter(Q.held_out(labels["doc_id"])).count()
    model = Q.learn(docs, labels)
    got = [r["score"] for r in Q.classify(docs, model).collect()]
    assert got == [1.0, 1.0, 1.0]
    assert Q.classify(docs.limit(0), model).count() == 0
    empty = Q.learn(docs.limit(0), labels.limit(0))
    assert [r["score"] for r in Q.classify(docs, empty).collect()] == [0.5] * 3
