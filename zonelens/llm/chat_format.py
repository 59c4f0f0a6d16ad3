"""Chat formatting with loss spans, in DataFrame expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role become one block.  A block
is ``### role: text</turn>`` and a line break; merged turns are kept apart by ``</part>`` and a line break, so that
reading back gives the original turns.  The loss covers the texts of the trained role and nothing else.

Control strings inside texts are escaped reversibly by one more backslash: ``</turn>`` becomes ``<\\/turn>``,
``<\\/turn>`` becomes ``<\\\\/turn>``, and ``### `` becomes ``###\\ ``.  Texts without such strings stay as they are.

Defined results: a null text is an empty text; a null role reads back as the empty role; turns go by (turn, role,
text), nulls first, so ties and repeated rows have one order and stay; rows with a null conversation id form one
conversation with a null id; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonelens.llm.common import pick

TRAINED = "assistant"
# The template.
START, AFTER_ROLE = "### ", ": "
END_TURN, END_PART = "</turn>\n", "</part>\n"

# Each rule is (pattern, replacement) of escaping and of its inverse.
ESCAPES = (
    (r"<(\\*)/(turn|part)>", r"<\\$1/$2>", r"<\\(\\*)/(turn|part)>", r"<$1/$2>"),
    (r"###(\\*) ", r"###\\$1 ", r"###\\(\\*) ", r"###$1 "),
)
# Characters that a role may not show as they are: they end the role or begin a control string.
ROLE_MARKS = {"%": "%25", ":": "%3A", "\n": "%0A", "<": "%3C", "#": "%23"}


def escape(text: Column) -> Column:
    for pattern, put, _, _ in ESCAPES:
        text = F.regexp_replace(text, pattern, put)
    return text


def unescape(text: Column) -> Column:
    for _, _, pattern, put in reversed(ESCAPES):
        text = F.regexp_replace(text, pattern, put)
    return text


def escape_role(role: Column) -> Column:
    for mark, put in ROLE_MARKS.items():
        role = F.replace(role, F.lit(mark), F.lit(put))
    return role


def unescape_role(role: Column) -> Column:
    for mark, put in reversed(ROLE_MARKS.items()):
        role = F.replace(role, F.lit(put), F.lit(mark))
    return role


def merged_blocks(turns: Column) -> Column:
    """Sorted turns -> array of (role, texts), one for every run of turns with one role."""
    role = lambda i: F.get(turns, i)["role"]
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (role(i) != role(i - 1)))

    def block(start: Column, k: Column) -> Column:
        after = F.coalesce(F.get(starts, k + 1), F.size(turns))
        part = F.slice(turns, start + 1, after - start)
        return F.struct(role(start).alias("role"), F.transform(part, lambda t: t["text"]).alias("texts"))

    return F.transform(starts, block)


def segments_of(block: Column, trained: str) -> Column:
    """A block as an array of (text, loss): its header, its escaped texts and the marks between and after them."""
    fixed = lambda c: F.struct(c.alias("text"), F.lit(False).alias("loss"))
    loss = block["role"] == trained
    last = F.size(block["texts"]) - 1

    def text_and_mark(text: Column, k: Column) -> Column:
        mark = F.when(k < last, F.lit(END_PART)).otherwise(F.lit(END_TURN))
        return F.array(F.struct(escape(text).alias("text"), loss.alias("loss")), fixed(mark))

    header = fixed(F.concat(F.lit(START), escape_role(block["role"]), F.lit(AFTER_ROLE)))
    return F.concat(F.array(header), F.flatten(F.transform(block["texts"], text_and_mark)))


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = TRAINED,
) -> DataFrame:
    """conv_id, formatted, loss_spans (array of (start, length) in code points) for every conversation.

    A conversation is one text in the end, so its turns meet in one row; the running offsets are a window over its
    segments, which spills, and no array grows by copying.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = pick(turns, conv=conv_id, turn=turn, role=role, text=text)
    item = F.struct("turn", empty("role").alias("role"), empty("text").alias("text"))
    grouped = rows.groupBy("conv").agg(F.sort_array(F.collect_list(item)).alias("turns"))
    blocks = grouped.select("conv", merged_blocks(F.col("turns")).alias("blocks"))
    segments = blocks.select("conv", F.flatten(F.transform("blocks", lambda b: segments_of(b, trained))).alias("segments"))
    each = segments.select("conv", F.posexplode("segments").alias("at", "segment"))
    each = each.select("conv", "at", F.col("segment.text").alias("piece"), F.col("segment.loss").alias("loss"))
    before = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("piece").cast("long")
    placed = each.withColumn("start", F.coalesce(F.sum(length).over(before), F.lit(0)))
    span = F.when(F.col("loss"), F.struct("start", length.alias("length")))
    out = placed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
    formatted = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return out.select(F.col("conv").alias(conv_id), formatted.alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """The original turns of a formatted conversation as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, END_TURN), lambda b: b != "")
    header = f"^{START}([^:]*){AFTER_ROLE}"

    def turns(block: Column) -> Column:
        role = unescape_role(F.regexp_extract(block, header, 1))
        parts = F.split(F.regexp_replace(block, header, ""), END_PART)
        return F.transform(parts, lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss, unescaped, in order."""
    part = lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
    return F.array_join(F.transform(loss_spans, lambda s: unescape(part(s))), "")
