r"""Chat formatting (operator 5): relational, with Spark expressions only.

A conversation's turns are collected as structs and sorted by turn (then role
and text, for repeated turn numbers); adjacent turns of the same role become
one block; the blocks are concatenated. One string per conversation is the
result itself, so a conversation's turns meet in one row.

Template: ``<turn:ROLE>TEXT<next>TEXT</turn>`` and a line feed for each block;
``<next>`` stands between the merged turns of a block. In roles and texts
``\`` becomes ``\b``, ``<`` becomes ``\l`` and ``>`` becomes ``\g``; so no
control string can occur inside them, and the two replacements can be undone
one after the other.

The loss mask is a list of [start, end) spans in code points of the formatted
string: one for each turn of the assistant, its escaped text and nothing else.

Defined cases: NULL texts and roles are empty strings; an empty text keeps its
turn (and an empty span); a NULL conv_id is a conversation of its own; repeated
rows are repeated turns; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, NAME_END, NEXT, CLOSE = "<turn:", ">", "<next>", "</turn>\n"
# a backslash first; undone last
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def blocks(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """conv_id, blocks array<struct<role, texts>>: sorted, merged, escaped."""
    empty = F.lit("")
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), empty).alias("role"),
                 F.coalesce(F.col(text).cast("string"), empty).alias("text")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    ts = F.col("ts")
    first = F.filter(F.sequence(F.lit(0), F.size(ts) - 1),
                     lambda i: ~F.get(ts, i - 1)["role"].eqNullSafe(F.get(ts, i)["role"]))
    cut = ordered.withColumn("first", first)
    merged = F.transform("first", lambda s, j: F.struct(
        escape(F.get(ts, s)["role"]).alias("role"),
        F.transform(F.slice(ts, s + 1, F.coalesce(F.get(F.col("first"), j + 1), F.size(ts)) - s),
                    lambda t: escape(t["text"])).alias("texts")))
    return cut.select("conv_id", merged.alias("blocks"))


def format_conversations(turns: DataFrame, **columns: str) -> DataFrame:
    """conv_id, formatted string, loss_spans array<struct<start, end>>
    (code points, end exclusive), n_blocks."""
    bs = F.col("blocks")
    formatted = F.array_join(F.transform(bs, lambda b: F.concat(
        F.lit(OPEN), b["role"], F.lit(NAME_END), F.array_join(b["texts"], NEXT), F.lit(CLOSE))), "")
    run = lambda n, loss: F.struct(n.cast("long").alias("n"), loss.alias("loss"))
    plain = F.lit(False)
    runs = F.flatten(F.transform(bs, lambda b: F.concat(
        F.array(run(F.length(b["role"]) + len(OPEN) + len(NAME_END), plain)),
        F.flatten(F.transform(b["texts"], lambda t, k: F.array(
            run(F.when(k > 0, F.lit(len(NEXT))).otherwise(F.lit(0)), plain),
            run(F.length(t), b["role"] == ASSISTANT)))),
        F.array(run(F.lit(len(CLOSE)), plain)))))
    span = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    spans = F.aggregate(
        runs, F.struct(F.lit(0).cast("long").alias("at"), F.filter(F.array(span), lambda _: F.lit(False)).alias("out")),
        lambda a, r: F.struct(
            (a["at"] + r["n"]).alias("at"),
            F.when(r["loss"], F.array_append(a["out"], F.struct(
                a["at"].alias("start"), (a["at"] + r["n"]).alias("end")))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return blocks(turns, **columns).select(
        "conv_id", formatted.alias("formatted"), spans.alias("loss_spans"), F.size(bs).alias("n_blocks"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string again: array<struct<role, text>>."""
    parts = F.split(formatted, CLOSE, -1)
    one = lambda b: F.transform(
        F.split(F.substr(b, F.instr(b, NAME_END) + len(NAME_END)), NEXT, -1),
        lambda t: F.struct(unescape(F.substr(F.substring_index(b, NAME_END, 1), F.lit(len(OPEN) + 1))).alias("role"),
                           unescape(t).alias("text")))
    return F.flatten(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), one))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order: array<string>."""
    return F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
