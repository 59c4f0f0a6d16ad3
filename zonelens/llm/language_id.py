"""Language identification with spans.

A word is scored by the character trigrams of each learned language.  The script of its letters narrows the candidates:
only languages that were seen with that script compete.  A Viterbi pass over the words of a text, with a penalty for
every switch of language, labels spans of mixed-language text.  The language of the text is the one whose spans hold
most letters.

The trigram model is learned from a bounded, stated sample of labelled documents (``sample_docs`` of each language in
expectation, chosen by a hash of the id), counted by Spark.

Defined results: a null text, and a text without letters, is ``und`` with score 0 and no spans; words in a script that
no learned language has carry no evidence, and a text of only such words gets the language with most training words and
score 0; without any learned language every text is ``und``; a language with fewer than ``min_docs`` labelled documents
is not learned; repeated rows give repeated rows; an empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm.common import column, crc_mod, pick, ship

UNKNOWN = "und"
# Runs of letters (and of numerals that are no decimal digits, which are left out below).
LETTERS = re.compile(r"[^\W\d_]+")
# Documents learned from, for each language, in expectation.
SAMPLE_DOCS = 4000
MIN_DOCS = 5
# Cost of a switch of language, in nats.
SWITCH = 10.0
# A script belongs to a language that has this share of its letters in it.
SCRIPT_SHARE = 0.01
# Words a worker remembers before it starts anew.
REMEMBERED = 150_000
# Steps of the Viterbi pass whose scores are numbers of Python at once.
STEPS = 1 << 14

# First and last code point of the ranges of each script.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
NAMES = [*SCRIPTS, "other"]


@lru_cache(maxsize=100_000)
def script_of(letter: str) -> int:
    point = ord(letter)
    for k, ranges in enumerate(SCRIPTS.values()):
        if any(a <= point <= b for a, b in ranges):
            return k
    return len(SCRIPTS)


def trigrams(word: str) -> list[str]:
    """Trigrams of the lower-case word between blanks."""
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)] or [padded]


@dataclass
class Model:
    """Log probabilities of trigrams by language; the last row is for a trigram never seen."""

    langs: list[str]
    rows: dict[str, int]
    logs: np.ndarray
    scripts: np.ndarray  # languages x scripts: whether the language is written in it
    most: int = 0  # the language with most training words
    version: str = field(default="")


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, min_docs: int = MIN_DOCS) -> Model:
    """Learn from all rows given that have a text, a language and an id (see ``sample_docs``)."""
    ship(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text, lang=lang).filter("text IS NOT NULL AND lang IS NOT NULL AND id IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).collect()}
    if not sizes:
        return Model([], {}, np.zeros((1, 0), np.float32), np.zeros((0, len(NAMES)), bool))
    # A few numbers inside the expression, so that no text is shuffled to be chosen.
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n))])
    chance = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(7)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    sample = rows.filter(chance < shares[F.col("lang")]).select("lang", F.col("text").cast("string"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter[str]] = {}
        for batch in batches:
            for name, t in zip(batch["lang"], batch["text"], strict=True):
                words.setdefault(name, Counter()).update(LETTERS.findall(t.lower()))
        grams: Counter[tuple[str, str]] = Counter()
        for name, found in words.items():
            for word, n in found.items():
                for g in trigrams(word):
                    grams[name, g] += n
                for c in word:
                    if c.isalpha():
                        grams[name, f"\n{script_of(c)}"] += n
        yield pd.DataFrame([(a, b, n) for (a, b), n in grams.items()], columns=["lang", "gram", "n"])

    counted = sample.mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sizes)
    at = {name: k for k, name in enumerate(langs)}
    is_script = counted["gram"].str.startswith("\n") & (counted["gram"].str.len() > 1) & counted["gram"].str[1:].str.isdecimal()
    written = np.zeros((len(langs), len(NAMES)))
    for r in counted[is_script].itertuples():
        written[at[r.lang], int(r.gram[1:])] += r.n
    grams = counted[~is_script]
    names = sorted(set(grams["gram"]))
    rows_of = {g: k for k, g in enumerate(names)}
    table = np.full((len(names) + 1, len(langs)), 0.5)
    for r in grams.itertuples():
        table[rows_of[r.gram], at[r.lang]] += r.n
    logs = np.log(table / table.sum(axis=0)).astype(np.float32)
    has = written >= SCRIPT_SHARE * np.maximum(1, written.sum(axis=1, keepdims=True))
    return Model(langs, rows_of, logs, has & (written > 0), int(written.sum(axis=1).argmax()))


class Words(dict):
    """Word -> row of :attr:`scores`; new words wait in a list until :meth:`settle` scores them together."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.scores = np.zeros((1024, len(self.model.langs)), np.float32)
        self.weight = np.zeros(1024, np.int32)
        self.settled = 0
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = self.settled + len(self.waiting)
        self.waiting.append(word)
        return at

    def settle(self) -> None:
        """Score the waiting words: log probabilities below the best, per candidate language."""
        n = len(self.waiting)
        if not n:
            return
        while self.settled + n > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.weight = np.concatenate([self.weight, np.zeros_like(self.weight)])
        model, unseen = self.model, len(self.model.logs) - 1
        flat: list[int] = []
        starts = np.zeros(n, np.int64)
        letters = np.zeros(n, np.int32)
        script = np.zeros(n, np.int32)
        find = model.rows.get
        for k, word in enumerate(self.waiting):
            starts[k] = len(flat)
            low = word.lower()
            flat += [find(g, unseen) for g in trigrams(low)]
            if word.isalpha():
                letters[k] = len(word)
                script[k] = script_of(word[0])
            else:
                own = [c for c in word if c.isalpha()]
                letters[k] = len(own)
                script[k] = script_of(own[0]) if own else len(SCRIPTS)
        got = np.add.reduceat(model.logs[np.array(flat)], starts, axis=0)
        allowed = model.scripts[:, script].T
        some = allowed.any(axis=1) & (letters > 0)
        # A language not written in the script cannot win against one that is; no candidate at all is no evidence.
        got = np.where(allowed, got, got.min(axis=1, keepdims=True) - SWITCH)
        got = np.where(some[:, None], got - got.max(axis=1, keepdims=True), 0)
        part = slice(self.settled, self.settled + n)
        self.scores[part] = got
        self.weight[part] = letters
        self.settled += n
        self.waiting = []


def viterbi(scores: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best language of each word, where every switch costs ``penalty``."""
    n, langs = scores.shape
    total = scores.sum(axis=0, dtype=np.float64)
    best = int(total.argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, langs)), gain[:-1]]), axis=0)
    # A path that visits the best language pays a switch for every stretch of another one.  A path that never does pays
    # one switch less than it has stretches, of which one begins and one ends the text.
    ends = gain[:-1].max() + (gain[-1] - gain[:-1].min(axis=0)).max() if n > 1 else 0.0
    if max((gain - low).max(initial=0.0), ends) <= penalty:
        return np.full(n, best, dtype=np.int16)
    # Few languages: numbers of Python cost less than arrays of that length.  Blocks bound what a long text holds of them.
    value = scores[0].tolist()
    back = np.zeros((n, langs), dtype=np.int16)
    for start in range(1, n, STEPS):
        came: list[list[int]] = []
        for row in scores[start : start + STEPS].tolist():
            high = max(value)
            top, moved = value.index(high), high - penalty
            came.append([k if v >= moved else top for k, v in enumerate(value)])
            value = [(v if v >= moved else moved) + s for v, s in zip(value, row, strict=True)]
        back[start : start + STEPS] = came
    path = np.empty(n, dtype=np.int16)
    path[-1] = value.index(max(value))
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def label(words: Words, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
    """Language, score and spans (first and end code point, language) of one text."""
    model = words.model
    found = LETTERS.findall(text) if text else []
    if not found or not model.langs:
        return UNKNOWN, 0.0, []
    at = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    words.settle()
    weight = words.weight[at]
    if not weight.any():
        return UNKNOWN, 0.0, []
    scores = words.scores[at]
    seen = scores.any(axis=1)
    if not seen.any() and len(model.langs) > 1:
        return model.langs[model.most], 0.0, []
    path = viterbi(scores)
    held = np.bincount(path, weights=weight * seen if len(model.langs) > 1 else weight, minlength=len(model.langs))
    best = int(held.argmax())
    total = scores.sum(axis=0, dtype=np.float64)
    sure = 1.0 / np.exp(np.minimum(total - total[best], 50.0)).sum()
    turns = np.flatnonzero(np.diff(path)) + 1
    spans = []
    if len(turns):
        places = [m.span() for m in LETTERS.finditer(text)]
        for a, b in zip([0, *turns], [*turns, len(path)], strict=True):
            spans.append((places[a][0], places[b - 1][1], model.langs[path[a]]))
    else:
        spans.append((LETTERS.search(text).start(), text.rfind(found[-1]) + len(found[-1]), model.langs[best]))
    return model.langs[best], float(held[best] / weight.sum() * sure), spans


LABEL = "lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"


def labeller(spark: SparkSession, model: Model):
    """A column function: text -> struct of lang_pred, score, spans."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(LABEL)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = Words(shared.value)
        for texts in batches:
            out = []
            for t in texts:
                if len(words) > REMEMBERED:
                    words.forget()
                lang, score, spans = label(words, t)
                out.append((lang, score, [{"start": int(a), "end": int(b), "lang": x} for a, b, x in spans]))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "spans"])

    return run


def identify(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Add lang_pred, score and spans of every whole text as a struct."""
    return df.withColumn(out, labeller(df.sparkSession, model)(column(text).cast("string")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 3) == 1, F.lit(False))
