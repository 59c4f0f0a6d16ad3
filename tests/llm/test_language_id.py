"""Language identification: Viterbi against all paths, mixed texts, accuracy on held-out documents, edge rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonelens.llm import language_id as L
from zonelens.llm import queries

SF = "/root/testdata/sf0.01"
SAID = {
    "en": "the house and the garden are near to the old river and we walk there with them every morning of the week",
    "de": "das haus und der garten sind nahe an dem alten fluss und wir gehen dort jeden morgen der woche spazieren",
    "ru": "дом и сад находятся рядом со старой рекой и мы гуляем там каждое утро недели вместе с друзьями",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, SAID[k], k) for i, k in enumerate(list(SAID) * 6)] + [(90, "x", "rare"), (91, None, "en"), (None, "y", "en")]
    return L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    for n, langs, penalty in [(1, 2, 1.0), (6, 3, 2.0), (7, 2, 0.5), (5, 3, 50.0)] * 12:
        scores = rng.normal(0, 2, (n, langs)).astype(np.float32)
        worth = lambda p: sum(scores[t, k] for t, k in enumerate(p)) - penalty * sum(a != b for a, b in itertools.pairwise(p))
        best = max(map(worth, itertools.product(range(langs), repeat=n)))
        assert worth(L.viterbi(scores, penalty)) == pytest.approx(best, abs=1e-4)


def test_viterbi_is_exact_where_the_best_language_is_second_everywhere():
    scores = np.array([[0, -3, -9]] * 3 + [[-9, -3, 0]] * 3, np.float32)
    assert list(L.viterbi(scores, 8.0)) == [0, 0, 0, 2, 2, 2]
    rng = np.random.default_rng(2)
    for k in range(10_000):
        n, langs, penalty = int(rng.integers(1, 9)), int(rng.integers(2, 5)), float(rng.choice([1, 4, 8]))
        scores = rng.integers(-9, 1, (n, langs)).astype(np.float32)
        value = scores[0].astype(float)
        for t in range(1, n):
            value = np.maximum(value, value.max() - penalty) + scores[t]
        path = L.viterbi(scores, penalty)
        worth = scores[np.arange(n), path].sum() - penalty * (np.diff(path) != 0).sum()
        assert worth == value.max(), k


def test_spans_end_at_the_last_letter(model):
    text = "  " + SAID["en"] + " 12 ... "
    (start, end, lang), = L.label(L.Words(model), text)[2]
    assert lang == "en" and start == 2 and text[start:end].strip(" .!?0123456789") == text[start:end]


def test_languages_and_spans(model):
    assert model.langs == ["de", "en", "ru"]
    words = L.Words(model)
    for lang, text in SAID.items():
        got, score, spans = L.label(words, text)
        assert got == lang and score > 0.9 and [s[2] for s in spans] == [lang]
    mixed = SAID["en"] + " " + SAID["de"] + " " + SAID["ru"]
    got, score, spans = L.label(words, mixed)
    assert [s[2] for s in spans] == ["en", "de", "ru"] and score < 0.6
    assert abs(spans[1][0] - len(SAID["en"])) < 15 and spans[2][1] == len(mixed)
    assert L.label(words, "мы the")[2][0][2] in ("en", "ru")


@pytest.mark.parametrize("text", [None, "", " 12 3.4 _", "²³", "\n"])
def test_no_letters(model, text):
    assert L.label(L.Words(model), text) == ("und", 0.0, [])


def test_unknown_script_and_long_text(model):
    words = L.Words(model)
    assert L.label(words, "日本語 한국어")[1] == 0.0 and L.label(words, "日本語")[0] in model.langs
    lang, score, spans = L.label(words, (SAID["de"] + " ") * 3000)
    assert lang == "de" and len(spans) == 1


def test_forgetting_changes_nothing(spark, model, monkeypatch):
    monkeypatch.setattr(L, "REMEMBERED", 3)
    words = L.Words(model)
    for _ in range(3):
        for lang, text in SAID.items():
            if len(words) > L.REMEMBERED:
                words.forget()
            assert L.label(words, text)[0] == lang


def test_frame_and_edge_tables(spark, model):
    docs = spark.createDataFrame([(1, "the house", "q"), (None, None, "q"), (1, "the house", "q")], "doc_id long, text string, lang_pred string")
    got = L.identify(docs, model, out="found").collect()
    assert sorted(r["found"]["lang_pred"] for r in got) == ["en", "en", "und"] and all(r["lang_pred"] == "q" for r in got)
    none = L.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert none.langs == [] and L.identify(docs, none, out="found").filter("found.lang_pred <> 'und'").count() == 0
    assert L.identify(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    got = queries.op7_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(docs, "doc_id").filter("lang IS NOT NULL")
    share = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97
