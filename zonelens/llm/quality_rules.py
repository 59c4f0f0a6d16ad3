"""Quality rules by distribution divergence, in DataFrame expressions only.

Every document gets two histograms: its code points by character class, and its words by a list of common words.  All
documents of a language (the ``lang`` column) give the reference histograms of that language.  A document is rejected
when the Jensen-Shannon distance (base 2, 0 to 1) to its language's reference is above a limit, for either histogram;
each comparison is made only for texts that are long enough for a histogram to mean something (length guards).  Both
distances to the text's own language are also judged together: each is measured against a limit that grows with the
sampling error of its histogram (from the reference's shares and the length), and their squares may not sum to more
than 1.  So a short text that is somewhat far in both is rejected, though each distance alone could be chance.  A
language with too few words to be a reference, and a null language, use the histograms of all documents together.

Base counts come with it: words are runs of characters that are not space or code points 9 to 13.

Defined results: null text counts as empty; fewer words than ``min_words`` fail the base rule, so empty texts are not
kept; a document compared with a reference that has no mass is kept by that comparison; repeated rows give repeated
rows; an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import WORD, column, free_name, pick, stage

# Frequent function words by language; together they are the bins of the word histogram.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "are", "this", "by"),
    "de": ("der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht"),
    "fr": ("le", "la", "de", "et", "les", "des", "en", "un", "une", "du", "dans", "est", "que", "pour", "qui", "par"),
    "es": ("el", "los", "las", "que", "y", "del", "se", "por", "con", "para", "una", "su", "al", "lo", "como", "más"),
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Limits of the verdict."""

    min_words: int = 50
    max_repeat_percent: int = 50
    # Jensen-Shannon distances above which a document is rejected, for a text without end.  A short text is farther
    # from its language by chance alone, so each limit is raised by its noise term over the root of the word count.
    max_class_distance: float = 0.15
    class_noise: float = 0.9
    max_word_distance: float = 0.20
    word_noise: float = 1.1
    # Both together, for a text with a reference of its own language: distances at which a text without end is
    # rejected if the other distance is 0, and how many times the expected sampling error is added to each (in squares).
    # Characters of one word go together, so their error is a multiple of that of independent draws.
    joint_class_distance: float = 0.30
    joint_class_noise: float = 4.0
    joint_word_distance: float = 0.20
    joint_word_noise: float = 1.18
    # Guards: shorter texts are not compared.
    class_chars: int = 200
    word_words: int = 50
    # A language is a reference of its own from this many words on.
    reference_words: int = 2000


def bins() -> list[str]:
    """The distinct common words, in the order of the lists."""
    return list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))


def others(text: Column, kept: str) -> Column:
    """Number of characters that belong to the class ``kept``."""
    return F.char_length(F.regexp_replace(text, f"[^{kept}]+", ""))


def with_counts(df: DataFrame, text: str = "text", out: str = "counts") -> DataFrame:
    """Add a struct of the base counts and the two histograms of every whole text.

    Three-word windows are compared by 64-bit hashes; only texts in which some hash repeats are sorted.
    """
    base = [column(c) for c in df.columns]
    of = {k: free_name(df, f"counted_{k}") for k in ("text", "words", "windows", "sorted", "starts", "common", "lines", "classes")}
    col = {k: F.col(name) for k, name in of.items()}

    def keep(frame: DataFrame, *names: str, **new: Column) -> DataFrame:
        return frame.select(*base, *[col[n] for n in names], *[c.alias(of[n]) for n, c in new.items()])

    df = keep(df, text=F.coalesce(column(text).cast("string"), F.lit("")))
    df = keep(df, "text", words=F.regexp_extract_all(col["text"], F.lit(WORD), F.lit(0)))

    word = lambda i: F.get(col["words"], i)
    hashes = F.transform(F.sequence(F.lit(0), F.size(col["words"]) - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    df = keep(df, "text", "words", windows=F.when(F.size(col["words"]) >= 3, hashes))

    # Sorted by hash, a window that occurs again has its twin beside it.
    repeats = F.size(F.array_distinct(col["windows"])) < F.size(col["windows"])
    pairs = F.sort_array(F.transform(col["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = keep(df, "text", "words", sorted=F.when(repeats, pairs))

    def start_of_twin(x: Column, k: Column) -> Column:
        same = lambda j: F.coalesce(F.get(col["sorted"], j)["h"] == x["h"], F.lit(False))
        return F.when(same(k - 1) | same(k + 1), x["i"])

    starts = F.sort_array(F.filter(F.transform(col["sorted"], start_of_twin), lambda i: i.isNotNull()))
    common = F.filter(F.transform(col["words"], F.lower), lambda w: w.isin(bins()))
    lines = F.filter(F.split(col["text"], "\n"), lambda x: x.rlike(WORD))
    classes = F.struct(
        others(col["text"], r"\p{Lu}").alias("upper"),
        others(col["text"], r"\p{Nd}").alias("digit"),
        others(col["text"], r".,;:!?'\"()\-").alias("mark"),
        others(col["text"], SYMBOLS).alias("symbol"),
        F.char_length(F.array_join(col["words"], "")).alias("word"),
        F.char_length(col["text"]).alias("all"),
    )
    df = keep(df, "words", starts=starts, common=common, lines=lines, classes=classes)

    # A window covers three words, or as many as lie before the next repeated window.
    covered = F.transform(col["starts"], lambda p, k: F.least(F.lit(3), F.coalesce(F.get(col["starts"], k + 1) - p, F.lit(3))))
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))
    c = col["classes"]
    other = c["word"] - c["upper"] - c["digit"] - c["mark"] - c["symbol"]
    by_class = [other, c["upper"], c["digit"], c["mark"], c["symbol"], c["all"] - c["word"]]
    by_word = [F.size(col["common"]) - F.size(F.array_remove(col["common"], w)) for w in bins()]
    rest = F.size(col["words"]) - F.size(col["common"])
    counts = {
        "n_words": F.size(col["words"]),
        "word_chars": c["word"],
        "n_symbols": c["symbol"],
        "n_dup_lines": F.size(col["lines"]) - F.size(F.array_distinct(col["lines"])),
        "n_repeat_words": n_repeat,
    }
    return df.select(
        *base,
        F.struct(
            *[x.cast("long").alias(n) for n, x in counts.items()],
            F.array(*[x.cast("long") for x in by_class]).alias("classes"),
            F.array(*[x.cast("long") for x in [*by_word, rest]]).alias("common"),
        ).alias(out),
    )


N_CLASSES = 6


def histogram(counts: Column) -> Column:
    """Shares of the whole; null where there is no mass."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def entropy(shares: Column) -> Column:
    return F.aggregate(shares, F.lit(0.0), lambda a, x: a - F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms, base 2; null if either is null."""
    middle = F.zip_with(p, q, lambda a, b: (a + b) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), entropy(middle) - (entropy(p) + entropy(q)) / 2))


def sampling_error(shares: Column, n: Column) -> Column:
    """Square of the distance to a histogram that ``n`` independent draws from it are expected to have.

    A bin of m expected draws adds 1 / (8 n ln 2) if m is large and about m / n if it is small; the second term is the
    rise in between, fitted to the exact sum over Poisson counts.  The draws of a bin of share q vary 1 - q times as much.
    """
    k = 8 * math.log(2)

    def of_bin(q: Column) -> Column:
        m = q * n
        return (1 - q) * ((1 - F.exp(-k * m)) / k + 0.16 * m * m / (1 + 1.5 * m * m * m))

    return F.aggregate(shares, F.lit(0.0), lambda a, q: a + of_bin(q)) / n


def references(counted: DataFrame, lang: str, counts: str, limits: Limits) -> DataFrame:
    """ref_lang, ref_classes, ref_common: reference histograms of every language with enough words, and of all (null).

    Sums are aggregated before the shuffle, so a language that holds most rows is no burden.
    """
    sums = [F.sum(column(counts)[kind][i]).alias(f"{kind}_{i}") for kind, n in (("classes", N_CLASSES), ("common", len(bins()) + 1)) for i in range(n)]
    parts = lambda kind, n: histogram(F.array(*[F.col(f"{kind}_{i}") for i in range(n)]))
    by_lang = counted.groupBy(column(lang).alias("ref_lang")).agg(F.sum(column(counts)["n_words"]).alias("n"), *sums)
    totals = by_lang.agg(*[F.sum(c).alias(c) for c in by_lang.columns if c != "ref_lang"])
    named = by_lang.filter(F.col("ref_lang").isNotNull() & (F.col("n") >= limits.reference_words))
    both = named.unionByName(totals.withColumn("ref_lang", F.lit(None).cast(named.schema["ref_lang"].dataType)))
    return both.select("ref_lang", parts("classes", N_CLASSES).alias("ref_classes"), parts("common", len(bins()) + 1).alias("ref_common"))


def judge(counted: DataFrame, lang: str, counts: str, out: str, limits: Limits = Limits()) -> DataFrame:
    """Add a struct: base_failed, class_distance, word_distance (null where a guard forbids the comparison), kept."""
    refs = stage(references(counted, lang, counts, limits), "quality-references")
    own, own_classes, own_common, class_shares, word_shares, by_class, by_word, all_classes, all_common, both_far = (
        free_name(counted, x) for x in (
            "ref_lang", "ref_classes", "ref_common", "class_shares", "word_shares", "by_class", "by_word", "all_classes", "all_common", "both_far"
        )
    )
    named = refs.filter(F.col("ref_lang").isNotNull()).toDF(own, own_classes, own_common)
    total = refs.filter(F.col("ref_lang").isNull()).select(F.col("ref_classes"), F.col("ref_common")).first()
    shares = lambda x: F.array(*[F.lit(v) for v in x]) if x else F.lit(None).cast("array<double>")
    joined = counted.join(named, column(lang) == F.col(own), "left")
    c = column(counts)
    # One step each for histograms, distances and verdicts, so that none is worked out again for each of its uses.
    base = [column(x) for x in counted.columns]
    shared = joined.select(*base, own_classes, own_common, histogram(c["classes"]).alias(class_shares), histogram(c["common"]).alias(word_shares))
    apart = shared.select(
        *base, own_classes, own_common,
        js_distance(F.col(class_shares), F.coalesce(F.col(own_classes), shares(total["ref_classes"]))).alias(by_class),
        js_distance(F.col(word_shares), F.coalesce(F.col(own_common), shares(total["ref_common"]))).alias(by_word),
    )
    to_class, to_word = F.col(by_class), F.col(by_word)
    n_chars = c["word_chars"]

    def part(distance: Column, shares_of: Column, n: Column, least: float, noise: float) -> Column:
        return distance * distance / (least**2 + noise**2 * sampling_error(shares_of, n))

    class_part = part(to_class, F.col(own_classes), n_chars, limits.joint_class_distance, limits.joint_class_noise)
    word_part = part(to_word, F.col(own_common), c["n_words"], limits.joint_word_distance, limits.joint_word_noise)
    joint = F.coalesce(F.when(n_chars >= limits.class_chars, class_part), F.lit(0.0)) + word_part
    guarded = [
        *base,
        F.when(n_chars >= limits.class_chars, to_class).alias(all_classes),
        F.when(c["n_words"] >= limits.word_words, to_word).alias(all_common),
        F.coalesce(F.when(c["n_words"] >= limits.word_words, joint > 1), F.lit(False)).alias(both_far),
    ]
    near = apart.select(*guarded)
    failed = (c["n_words"] < limits.min_words) | (100 * c["n_repeat_words"] > limits.max_repeat_percent * c["n_words"])

    def far(distance: str, most: float, noise: float) -> Column:
        return F.coalesce(F.col(distance) > most + noise / F.sqrt(c["n_words"].cast("double")), F.lit(False))

    far_class = far(all_classes, limits.max_class_distance, limits.class_noise)
    far_word = far(all_common, limits.max_word_distance, limits.word_noise)
    kept = ~failed & ~far_class & ~far_word & ~F.col(both_far)
    verdict = F.struct(
        failed.alias("base_failed"), F.col(all_classes).alias("class_distance"), F.col(all_common).alias("word_distance"), kept.alias("kept")
    )
    return near.select(*base, verdict.alias(out))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """doc_id, the base counts, base_failed, both distances and kept for every document."""
    narrow = pick(docs, id=doc_id, text=text, lang=lang)
    counted = stage(with_counts(narrow, "text", "counts").drop("text"), "quality-counts")
    judged = judge(counted, "lang", "counts", "verdict", limits)
    numbers = [F.col("counts")[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    verdict = [F.col("verdict")[n].alias(n) for n in ("base_failed", "class_distance", "word_distance", "kept")]
    return judged.select(F.col("id").alias(doc_id), *numbers, *verdict)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    counts = free_name(docs, "quality_counts")
    verdict = free_name(docs, "quality_verdict")
    counted = stage(with_counts(docs, text, counts), "quality-docs")
    judged = judge(counted, lang, counts, verdict, limits)
    return judged.filter(F.col(verdict)["kept"]).select(*map(column, docs.columns))
