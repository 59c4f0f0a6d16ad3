"""Decontamination: tiling against a plain search, pairs against brute force, reordered passages, edge rows."""

import random

import numpy as np
import pytest

from zonelens.llm import decontaminate as D


def slow_tiles(item, stretches, k):
    """Marks the longest run that is free on both sides, first in the item, then first in the text."""
    used, taken, tiles = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for s, words in enumerate(stretches):
                for t in range(len(words)):
                    n = 0
                    while i + n < len(item) and t + n < len(words) and item[i + n] == words[t + n] and i + n not in used and (s, t + n) not in taken:
                        n += 1
                    if n >= k and (best is None or n > best[3]):
                        best = (i, s, t, n)
        if best is None:
            return tiles
        i, s, t, n = best
        used |= {i + j for j in range(n)}
        taken |= {(s, t + j) for j in range(n)}
        tiles.append(best)


def test_tiles_equal_plain_search():
    rng = random.Random(8)
    for _ in range(150):
        letters = "abcdefgh"[: rng.randint(2, 8)]
        item = [rng.choice(letters) for _ in range(rng.randint(0, 14))]
        stretches = [[rng.choice(letters) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(0, 3))]
        k = rng.randint(2, 4)
        assert D.tile(item, stretches, k) == slow_tiles(item, stretches, k)


def material():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    items = [[word() for _ in range(n)] for n in (30, 40, 12, 24, 3)]
    filler = lambda n: [word() for _ in range(n)]
    docs = []
    for i, item in enumerate(items):
        docs.append(filler(20) + item + filler(20))
        half = len(item) // 2
        docs.append(filler(5) + item[half:] + filler(30) + item[:half])  # reordered
        docs.append(filler(50) + item[: len(item) // 3])
    docs += [filler(100), filler(3), items[0][:20] + items[1][:25]]
    text = lambda words: " ".join(w.upper() + "," if k % 7 == 3 else w for k, w in enumerate(words))
    return [" ".join(i) for i in items], [*map(text, docs), None, "", "  ", text(docs[0])]


@pytest.mark.parametrize("bits", [1 << 25, 64])
def test_pairs_equal_brute_force(spark, bits):
    items, texts = material()
    bench = spark.createDataFrame([(100 + i, t, "z") for i, t in enumerate(items)] + [(99, items[0], "z"), (None, None, "z")], "item_id long, text string, key string")
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[0], "s")], "doc_id long, text string, seeds string")
    got = {r["doc_id"]: r for r in D.judge(docs, bench, bloom_bits=bits).collect()}
    for i, t in [*enumerate(texts), (None, texts[0])]:
        words = D.tokens_of(t)
        cover = {100 + k: (D.coverage(D.tokens_of(x), [words]) if len(x.split()) >= D.MIN_MATCH else 0.0) for k, x in enumerate(items)}
        hits = {k: c for k, c in cover.items() if c >= D.THRESHOLD}
        if 100 in hits:
            hits[99] = hits[100]
        row = got[i]
        assert row["contaminated"] == bool(hits) and row["n_items"] == len(hits)
        if hits:
            top = max(hits.values())
            assert row["coverage"] == pytest.approx(top) and row["item_id"] == min(k for k, c in hits.items() if c == top)
    assert got[1]["contaminated"] and got[4]["contaminated"] and not got[2]["contaminated"] and not got[15]["contaminated"]
    cleaned = D.clean(docs, bench, bloom_bits=bits)
    assert cleaned.columns == docs.columns
    assert sorted(r["doc_id"] for r in cleaned.collect()) == sorted(k for k, r in got.items() if not r["contaminated"])


def test_empty_tables(spark):
    items, texts = material()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.judge(docs, none).filter("contaminated").count() == 0 and D.clean(docs, none).count() == len(texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert D.judge(docs.limit(0), bench).count() == 0 and D.clean(docs.limit(0), bench).count() == 0


def test_seed_hashes_roll():
    hashes = D.TokenHashes()
    a, b = D.seed_hashes(list("xabcdy"), hashes, 4), D.seed_hashes(list("abcd"), hashes, 4)
    assert a[1] == b[0] and len(a) == 3 and D.seed_hashes(["a"], hashes, 4).dtype == np.uint64
