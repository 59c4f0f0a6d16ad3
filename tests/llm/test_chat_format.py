"""Chat formatting: the exact template, round trips of hostile texts, loss spans, merged turns, edge rows."""

import random

from pyspark.sql import functions as F

from zonelens.llm import chat_format as C


def formatted(spark, rows, schema="conv_id long, turn long, role string, text string"):
    found = C.format_chats(spark.createDataFrame(rows, schema))
    found = found.withColumn("turns", C.read_turns(F.col("formatted"))).withColumn("loss", C.read_loss(F.col("formatted"), F.col("loss_spans")))
    return {r["conv_id"]: r for r in found.collect()}


def test_template(spark):
    rows = [(1, 1, "assistant", "b </turn> ### c"), (1, 0, "user", "a"), (1, 2, "assistant", None), (1, 3, "user", "<\\/part>")]
    row = formatted(spark, rows)[1]
    assert row["formatted"] == "### user: a</turn>\n### assistant: b <\\/turn> ###\\ c</part>\n</turn>\n### user: <\\\\/part></turn>\n"
    assert [tuple(t) for t in row["turns"]] == [("user", "a"), ("assistant", "b </turn> ### c"), ("assistant", ""), ("user", "<\\/part>")]
    assert row["loss"] == "b </turn> ### c"


def test_hostile_texts_read_back(spark):
    rng = random.Random(6)
    bits = ["</turn>", "</part>", "\n", "### ", "###", " ", "\\", "<", "/turn>", "user: ", "### assistant: ", "é😀", "$1", "", "#", "</turn>\n"]
    rows, want = [], {}
    for conv in range(150):
        turns = [(rng.choice(["user", "assistant", "system", "a:b\n#<%3A", ""]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))) for _ in range(rng.randint(1, 7))]
        want[conv] = turns
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    got = formatted(spark, rows)
    for conv, turns in want.items():
        assert [tuple(t) for t in got[conv]["turns"]] == turns
        assert got[conv]["loss"] == "".join(t for r, t in turns if r == "assistant")
        spans = [got[conv]["formatted"][s["start"] : s["start"] + s["length"]] for s in got[conv]["loss_spans"]]
        assert len(spans) == sum(r == "assistant" for r, _ in turns) and not any("</turn>" in s or "</part>" in s for s in spans)


def test_ties_nulls_and_other_columns(spark):
    rows = [(1, 0, "user", "x", 1, "p"), (1, 0, "user", "x", 1, "p"), (1, None, None, None, 1, "p"), (None, 2, "assistant", "n", 1, "p"), (None, 1, "user", "m", 1, "p")]
    got = formatted(spark, rows, "conv_id long, turn long, role string, text string, at int, piece string")
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "x"), ("user", "x")]
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "m"), ("assistant", "n")] and got[None]["loss"] == "n"
    assert formatted(spark, []) == {}


def test_long_conversation(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", f"t{k}") for k in range(4000)] + [(2, 0, "assistant", "y" * 300_000)]
    got = formatted(spark, rows)
    assert len(got[1]["turns"]) == 4000 and got[1]["loss"] == "".join(f"t{k}" for k in range(0, 4000, 3)) and len(got[2]["loss"]) == 300_000
