"""Hard negatives: Strassen products against plain ones, mined rows against a plain loop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonelens.llm import hard_negatives as hn

FIELDS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (9, 64, 17), (33, 65, 70), (64, 64, 64), (7, 300, 90)])
def test_strassen(m, k, n):
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(10**5), 10**5, (m, k)), rng.integers(-(10**5), 10**5, (k, n))
    assert (hn.strassen(a, b, 4) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = random.Random(1)
    entries = [(rng.randrange(-3, 4), rng.randrange(50)) for _ in range(200)]
    heaps = hn.Heaps(2, 5)
    for at in range(0, 200, 4):
        part = np.array(entries[at : at + 4])
        heaps.merge(np.array([1]), part[None, :, 0], part[None, :, 1])
    at, scores, ids = heaps.rows()
    assert set(at) == {1} and list(zip(scores, ids)) == sorted(entries, key=lambda e: (-e[0], e[1]))[:5]


def slow(data, every, kept=5):
    good = []
    for k, (vec_id, vec, label) in enumerate(data):
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        good.append((k, vec_id, [math.floor(256 * x) for x in vec], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for k, anchor, vec, label in good:
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(vec, w)), i, j, lab) for j, i, w, lab in good]
        positives = sorted(s[:2] for s in scores if s[3] == label and s[2] != k)[:kept]
        for ps, pid in positives:
            window = sorted(s[:2] for s in scores if s[3] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps)[:kept]
            out += [(anchor, pid, r, i, -ps, -s) for r, (s, i) in enumerate(window, 1)]
    return sorted(out)


def vectors(rng, n, dim):
    data = []
    for k in range(n):
        vec = [rng.uniform(-0.3, 0.5) for _ in range(dim)] if k % 9 else [0.25] * dim  # many ties
        data.append((k, vec, rng.randrange(3)))
    data += [(n, None, 1), (n + 1, [None] * dim, 1), (n + 2, [float("nan")] * dim, 0), (n + 3, [float("inf")] * dim, 0)]
    data += [(n + 4, vec, None), (None, vec, 1), (10, data[10][1], data[10][2]), (8, data[3][1], 2), (n + 5, [0.5, 0.5], 1), (n + 6, [], 0)]
    return data


@pytest.mark.parametrize("block", [3, 8192])
def test_mined_rows_equal_a_loop(rows, block):
    data = vectors(random.Random(block), 300, 11)
    df = rows("vec_id long, embedding array<double>, label int, row int, id int, score int", *[(*r, 1, 2, 3) for r in data]).repartition(5)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hn.mine(df, F.col("id") % 10 == 0, label=label, block=block).select(*FIELDS)
    assert sorted(map(tuple, found.collect())) == slow(data, 10)


def test_nothing_to_mine(rows):
    schema = "vec_id long, embedding array<float>, label int"
    assert hn.mine(rows(schema), F.col("id") % 10 == 0).collect() == []
    assert hn.mine(rows(schema, (0, [1.0], 1), (1, [1.0], 2)), F.col("id") % 10 == 0).collect() == []


def test_vectors_too_large_are_an_error(rows):
    df = rows("vec_id long, embedding array<double>, label int", (0, [1e30], 1), (1, [1.0], 1))
    with pytest.raises(Exception, match="too large"):
        hn.mine(df, F.col("id") % 10 == 0).collect()
