"""Chat formatting: one training string per conversation, made of Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns
of one role become one block of the template

    <|start|>ROLE<|text|>TEXT<|next|>TEXT<|end|>

where ``<|next|>`` keeps the border between merged turns. Control strings inside
roles and texts (``<|word|>``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a backslash
after their first character, and those that have backslashes there already get
one more, so nothing in a text reads as a control string and every text can be
read back exactly.

A row can hold one conversation, and its result is one string, so a single
conversation has to fit in a task; everything else is spread by conversation.

Defined results: a null text or role is the empty string; a null turn sorts
first; equal turns are sorted by role, then text, and repeated rows are kept; a
null conversation id is a conversation of its own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
CONTROL = r"(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def format_chats(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, ``segments`` and ``formatted``.

    ``segments`` is an array of (text, loss); ``formatted`` is their texts, joined.
    The loss mask covers the segments with ``loss``: the texts of role ``learn``,
    without any marks of the template.
    """
    turns = rows.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        opens = ~before.eqNullSafe(t["role"])
        closes = ~after.eqNullSafe(t["role"])
        mark = F.when(opens, F.concat(F.lit(START), escape(t["role"]), F.lit(TEXT))).otherwise(NEXT)
        return F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == learn).alias("loss")),
            F.struct(F.when(closes, F.lit(END)).otherwise("").alias("text"), F.lit(False).alias("loss")),
        )

    out = sorted_turns.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return out.withColumn("formatted", F.array_join("segments.text", ""))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds, in order."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def of(block: Column) -> Column:
        halves = F.split(F.substr(block, F.lit(len(START) + 1)), r"<\|text\|>")
        return F.transform(
            F.split(halves[1], r"<\|next\|>"),
            lambda t: F.struct(unescape(halves[0]).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before it was escaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
