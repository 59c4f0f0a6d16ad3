"""SimHash: fingerprints by the contract's words, components against all pairs."""

import random
import re

import pytest
import xxhash

from zonelens.llm import simhash
from zonelens.llm.components import least_members


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, distance=4):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return {(k, fps[i], least.get(find(i))) for i, k in enumerate(ids)}


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "A b\x0bc", "A b c d", "Ä É a b C d e e e e", "x " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) & (1 << 64) - 1 == slow_fingerprint(text)


def planted(rng):
    """Chains and clumps of fingerprints, with copies and one crowded segment."""
    fps = []
    for _ in range(12):
        fp = rng.getrandbits(64)
        for _ in range(8):
            fps.append(fp)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                fp ^= 1 << b
    low = rng.getrandbits(21)
    fps += [low | rng.getrandbits(43) << 21 for _ in range(40)]
    return fps + fps[:5] + [0, 0, 1]


@pytest.mark.parametrize("segments,crowded", [(None, 4096), (3, 4), (2, 4096), (2, 3), (4, 1)])
def test_components_equal_all_pairs(spark, segments, crowded):
    rng = random.Random(7)
    fps = planted(rng)
    ids = [*rng.sample(range(10_000), len(fps) - 1), None]
    rows = [(i, simhash.signed(f)) for i, f in zip(ids, fps, strict=True)]
    marked = spark.createDataFrame(rows, "id long, fp long")
    found = simhash.components(marked, 4, segments, crowded)
    got = {(r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in marked.join(found, "fp").collect()}
    assert got == slow_components(ids, fps)


@pytest.mark.parametrize("distance", [1, 3])
def test_odd_distances(spark, distance):
    rng = random.Random(3)
    fps = planted(rng)
    marked = spark.createDataFrame([(i, simhash.signed(f)) for i, f in enumerate(fps)], "id long, fp long")
    for crowded in (4096, 1):
        found = simhash.components(marked, distance, 3, crowded)
        got = {(r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in marked.join(found, "fp").collect()}
        assert got == slow_components(list(range(len(fps))), fps, distance)


def test_whole_operator_and_edge_rows(spark):
    texts = ["the quick brown fox jumps over it", "The Quick brown fox jumps over it", "", None, "  ", "else", None]
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(None, "else", "y", 6), (1, texts[1], "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component int")
    got = sorted((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert [x[2] for x in got] == [0, 0, 0, 2, 2, 2, 5, 2, 5]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 5]
    none = docs.filter("doc_id < 0")
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_rows_without_any_id_leave_one(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "other words entirely here now")], "doc_id long, text string")
    assert sorted(r["doc_id"] or 0 for r in simhash.keep_one(docs).collect()) == [0, 4]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501)], "a long, b long")
    got = {r["node"]: r["component"] for r in least_members(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}
