"""Grouped prefix join: components against all pairs."""

import random
import re

import pytest

from zonelens.llm import ngram_join


def slow_set(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def slow_components(docs, percent=90):
    sets = [slow_set(text) for _, text in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(docs, sets))), key=str)


def planted(rng):
    """Unrelated texts, copies, chains of edits, a crowd around one text, and texts whose edits leave the prefix alone."""
    texts = [" ".join(rng.choices("abcdefghij", k=rng.randrange(0, 60))) for _ in range(60)]
    base = [f"w{k}" for k in range(120)]
    for _ in range(80):  # mostly near the limit from each other, nearer to the middle
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    chain = [f"c{k}" for k in range(200)]
    for k in range(12):
        chain[7 * k] = f"d{k}"
        texts.append(" ".join(chain))
    common = "t u v w x y z".split()
    for k in range(40):  # a rare start that all share, and an end of common words that differs
        tail = [common[(k >> (i % 6)) & 1] for i in range(6)]
        texts.append(" ".join([f"r{i}" for i in range(60)] + tail))
    texts += ["", None, " \t", "one", "One", "two words", "a b c", "a b c a b c"] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, pivots, percent", [(1, 16, 90), (2, 1, 90), (3, 2, 80)])
def test_components_equal_all_pairs(rows, seed, pivots, percent):
    rng = random.Random(seed)
    docs = list(enumerate(planted(rng)))
    docs[5] = (None, docs[5][1])
    docs[6] = (docs[7][0], docs[6][1])
    df = rows("doc_id long, text string", *docs)
    found = ngram_join.components(df, pivots=pivots, percent=percent).collect()
    assert sorted(map(tuple, found), key=str) == slow_components(docs, percent)


def test_groups_hold_members_of_one_prefix(rows, spark):
    """Sets with one prefix and size in the frame that pairs groups: all members of a group are compared."""
    rng = random.Random(4)
    rare, common = [f"r{i}" for i in range(30)], ["p", "q"]
    docs = [(k, " ".join(rare + rng.choices(common, k=3) + rare[:2])) for k in range(60)]
    docs += [(100 + k, " ".join(rng.choices(common, k=5) * 8)) for k in range(100)]
    found = ngram_join.components(rows("doc_id long, text string", *docs), pivots=1).collect()
    assert sorted(map(tuple, found), key=str) == slow_components(docs)


def test_empty_table_and_other_columns(rows):
    assert ngram_join.components(rows("doc_id long, text string")).collect() == []
    df = rows("doc_id string, text string, cls int, n int, prefix int, k1 string, component_id int", ("b", "x y z", 1, 2, 3, "k", 4), ("a", "X y z", 1, 2, 3, "k", 4))
    assert sorted(map(tuple, ngram_join.components(df).collect())) == [("a", 1, "a"), ("b", 1, "a")]


def test_prefix_length():
    """None only if no other set can link; otherwise the rest of the set is too small for the least overlap."""
    for percent in (50, 80, 90, 95):
        for n in range(1, 120):
            overlaps = [o for m in range(1, 3 * n) for o in range(min(n, m) + 1) if o < max(n, m) and 100 * o >= percent * (n + m - o)]
            length = ngram_join.prefix_length(n, percent)
            assert (length > 0) == bool(overlaps) and (not overlaps or n - length < min(overlaps))


def test_long_text(rows):
    words = [f"w{k % 5000}" for k in range(300_000)]
    other = list(words)
    other[10] = "z"
    found = ngram_join.components(rows("doc_id long, text string", (1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:100])))).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 3)}
