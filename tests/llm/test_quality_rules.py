"""Quality rules: base counts by plain Python, distances by plain formulas, edge rows."""

import math
import random
import re
from collections import Counter

import pytest

from zonelens.llm import quality_rules as Q


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    classes = [0] * 6
    for w in words:
        for c in w:
            kind = 4 if c in Q.SYMBOLS else 1 if c.isupper() else 2 if c.isdecimal() else 3 if c in ".,;:!?'\"()-" else 0
            classes[kind] += 1
    classes[5] = len(text) - sum(classes[:5])
    found = Counter(w.lower() for w in words)
    common = [found[b] for b in Q.bins()]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": classes[4], "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered), "classes": classes, "common": [*common, len(words) - sum(common)],
    }


def texts():
    rng = random.Random(11)
    made = [None, "", "   \n\t", "a", "a b", "a b c", "a a a a a", "x\n\nx\n x\n#\n#", "the of THE É ß 1２ | <> $$", "a b c a b c", "a b c d a b c"]
    for _ in range(60):
        vocabulary = rng.sample(["the", "The", "of", "und", "é!", "#", "x1", "LA", "más", "z-z"], rng.randint(1, 9))
        made.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randint(1, 120))))
    return made


def test_counts(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, counts int, counted_words string")
    got = {r["doc_id"]: r["c"].asDict() for r in Q.with_counts(docs, out="c").collect()}
    for i, t in rows:
        assert got[i] == slow_counts(t), (i, t)


def slow_distance(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    h = lambda v: -sum(x * math.log2(x) for x in v if x > 0)
    return math.sqrt(max(0.0, h([(a + b) / 2 for a, b in zip(p, q, strict=True)]) - (h(p) + h(q)) / 2))


def corpus(spark):
    rng = random.Random(2)
    rows = []
    for i in range(160):
        lang = ["en", "de", None, "en"][i % 4] if i != 3 else "rare"
        words = ["the", "of", "house", "and", "green"] if lang != "de" else ["der", "die", "Haus", "und", "grün"]
        text = " ".join(rng.choice(words) for _ in range(30 if lang == "rare" else 150))
        if i in (8, 9):
            text = " ".join(w.upper() + "!!" + str(k) for k, w in enumerate(text.split()))
        rows.append((i, text, lang))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_verdict_equals_plain_formulas(spark):
    rows, docs = corpus(spark)
    limits = Q.Limits(max_repeat_percent=100, reference_words=500)
    counts = {i: slow_counts(t) for i, t, _ in rows}

    def reference(ids, kind):
        return [sum(x) for x in zip(*(counts[i][kind] for i in ids), strict=True)]

    every = [i for i, _, _ in rows]
    got = {r["doc_id"]: r for r in Q.measure(docs, limits=limits).collect()}
    for i, _, lang in rows:
        own = [k for k, _, x in rows if x == lang]
        use = own if lang and sum(counts[k]["n_words"] for k in own) >= 500 else every
        c = counts[i]
        far = {kind: slow_distance(c[kind], reference(use, kind)) for kind in ("classes", "common")}
        failed = c["n_words"] < 50
        assert got[i]["base_failed"] == failed
        assert (got[i]["class_distance"] is None) == (c["word_chars"] < 200) and (got[i]["word_distance"] is None) == failed
        if not failed:
            assert got[i]["word_distance"] == pytest.approx(far["common"], abs=1e-7)
            assert got[i]["class_distance"] == pytest.approx(far["classes"], abs=1e-7)
            root = math.sqrt(c["n_words"])
            most = limits.max_class_distance + limits.class_noise / root, limits.max_word_distance + limits.word_noise / root
            assert got[i]["kept"] == (far["classes"] <= most[0] and far["common"] <= most[1])
    assert not got[8]["kept"] and not got[9]["kept"] and got[0]["kept"]


def test_edge_tables(spark):
    _, docs = corpus(spark)
    docs = docs.selectExpr("*", "1 AS quality_counts", "'x' AS ref_lang", "null AS kept")
    kept = Q.keep_good(docs, limits=Q.Limits(max_repeat_percent=100))
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    none = docs.filter("doc_id < 0")
    assert Q.measure(none).count() == 0 and Q.keep_good(none).count() == 0
    nulls = spark.createDataFrame([(None, None, None), (None, None, None)], "doc_id long, text string, lang string")
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in Q.measure(nulls).collect()] == [(0, True, False)] * 2


def test_sampling_error(spark):
    rng = random.Random(3)
    for shares, n in (([0.5, 0.3, 0.2], 200), ([0.4] + [0.02] * 30, 60), ([0.9] + [0.001] * 100, 80)):
        drawn = [Counter(rng.choices(range(len(shares)), shares, k=n)) for _ in range(2000)]
        mean = sum(slow_distance([d[i] for i in range(len(shares))], shares) ** 2 for d in drawn) / len(drawn)
        row = spark.createDataFrame([(shares, n)], "q array<double>, n int").select(Q.sampling_error(Q.F.col("q"), Q.F.col("n")).alias("e")).first()
        assert row["e"] == pytest.approx(mean, rel=0.1)


def test_short_junk_is_judged_by_both_distances(spark):
    """Short table rows whose distances each pass their own limit are rejected, and clean texts of that length stay."""
    rng = random.Random(5)
    plain = [*Q.COMMON_WORDS["en"], *(f"{a}{b}" for a in ("ston", "reat", "hous", "lind") for b in ("ing", "er", "ed", "es", "ly", "al"))]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(n)), "en") for i, n in enumerate([60, 90, 120, 180, 400] * 40)]
    junk = [(1000 + i, " ".join("|" if k % 4 == 0 else rng.choice(plain) for k in range(n)), "en") for i, n in enumerate([90, 100, 120, 150] * 5)]
    junk = [(i, " ".join(w if w not in plain[:5] else "data" for w in t.split()), lang) for i, t, lang in junk]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    limits = Q.Limits(max_repeat_percent=100)
    got = {r["doc_id"]: r for r in Q.measure(docs, limits=limits).collect()}
    assert all(got[i]["kept"] for i, _, _ in rows)
    passing = [
        i for i, _, _ in junk
        if got[i]["class_distance"] <= limits.max_class_distance + limits.class_noise / math.sqrt(got[i]["n_words"])
        and got[i]["word_distance"] <= limits.max_word_distance + limits.word_noise / math.sqrt(got[i]["n_words"])
    ]
    assert len(passing) >= 10 and not any(got[i]["kept"] for i in passing), [got[i] for i in passing]
