"""Importance resampling: weights, scores and ranks against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from zonelens.llm import importance


def slow_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def slow(docs, target, longest=1, percent=10, least=20):
    parts = [slow_features(text, longest) for _, text in docs]
    s = Counter(b for _, found in parts for b in found)
    t = Counter(b for text in target for b in slow_features(text, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for (k, _), (words, found) in zip(docs, parts):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in out)


def texts(rng, n):
    words = ["alpha", "Beta", "γάμμα", "x1", "it's", "a-b", "\x00", "{", "É"]
    return ["", None, " \t", "!!!", "one"] + [" ".join(rng.choices(words, k=rng.randrange(0, 60))) for _ in range(n)]


FIELDS = ("doc_id", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("longest, runs, percent", [(1, 64, 10), (2, 3, 50), (3, 1, 100)])
def test_ranks_equal_a_plain_sort(rows, longest, runs, percent):
    rng = random.Random(runs)
    docs = list(enumerate(texts(rng, 400)))
    docs += [docs[50]] * 30 + [(None, docs[60][1])]  # repeated rows and a null id
    target = texts(rng, 20)
    found = importance.ranked(
        rows("doc_id long, text string, score int, id string", *[(*d, 1, "x") for d in docs]).repartition(4),
        rows("item_id long, text string", *enumerate(target)), longest=longest, runs=runs, percent=percent,
    )
    assert Counter(tuple(r) for r in found.select(*FIELDS).collect()) == slow(docs, target, longest, percent)


def test_blocks_do_not_change_features(monkeypatch):
    text = " ".join(f"w{k % 7}" for k in range(500))
    whole = {n: sorted(slow_features(text, n)[1]) for n in (1, 2, 3)}
    monkeypatch.setattr(importance, "BLOCK", 5)
    for n, expected in whole.items():
        assert sorted(b for part in importance.feature_buckets(text, n, importance.Buckets(10_000)) for b in part) == expected


def test_resample_keeps_all_columns(rows):
    rng = random.Random(9)
    docs = [(k, t, "s", k) for k, t in enumerate(texts(rng, 100))]
    df = rows("doc_id long, text string, row string, score int", *docs)
    target = rows("item_id long, text string", (1, "alpha beta"))
    drawn = importance.resample(df, target)
    ranks = importance.ranked(df, target).filter("rank is not null")
    assert drawn.columns == df.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in ranks.collect())


def test_empty_tables(rows):
    none, some = rows("doc_id long, text string"), rows("doc_id long, text string", (1, "a " * 30))
    assert importance.ranked(none, some).collect() == []
    assert [tuple(r[c] for c in FIELDS) for r in importance.ranked(some, none, percent=100).collect()] == [tuple(next(iter(slow([(1, "a " * 30)], [], percent=100))))]


def test_sort_ranks_with_one_score_everywhere(rows, spark):
    df = spark.range(5000).selectExpr("1L as down", "id % 3 as id", "id as nr")
    found = importance.sort_ranks(df, ["down", "id", "nr"], runs=8).collect()
    assert sorted((r["rank"], r["id"], r["nr"]) for r in found) == [(k + 1, i, n) for k, (i, n) in enumerate(sorted((n % 3, n) for n in range(5000)))]
