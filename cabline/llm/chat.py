"""Chat formatting with column expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role
form a block, found and joined by array functions; the formatted string is the blocks one
after another::

    <|im_start|>role\\nfirst text<|im_sep|>second text<|im_end|>\\n

Control strings all begin with ``<|``. Inside texts and roles every ``<``, any ``~``, ``|``
gets one more ``~`` (``<|`` becomes ``<~|``, ``<~|`` becomes ``<~~|``), so a text can never
hold a control string, and taking one ``~`` away gives the text back exactly. A line break in
a role becomes ``<|nl|>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, BREAK = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)\|", r"<$1~|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<~(~*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(BREAK))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))


def format_chats(turns: DataFrame, train_role: str = "assistant") -> DataFrame:
    """One row per conv_id: ``segments``, the formatted string cut into array<struct<text,
    loss>> (loss: under the training mask, exactly the texts of ``train_role``), and
    ``formatted``, their concatenation.

    turns: columns conv_id, turn, role, text (others are ignored). Rows sort by turn, null
    turns first, then by role and text, so ties and repeated rows have one defined order
    and all stay. A null text or role is empty; a null conv_id is a conversation of its own.
    Every step is linear in a conversation's length: blocks are slices between the places
    where the role changes, never a growing array. An empty table gives an empty result.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    change = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    chats = chats.withColumn("heads", change)
    chats = chats.withColumn("blocks", F.transform("heads", lambda a, k: F.struct(
        F.get("turns", a)["role"].alias("role"),
        F.transform(
            F.slice("turns", a + 1, F.coalesce(F.get("heads", k + 1), F.size("turns")) - a),
            lambda t: escape(t["text"])).alias("texts"))))
    one = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    chats = chats.withColumn("segments", F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(one(F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n")), no)),
        F.flatten(F.transform(b["texts"], lambda t, k: F.when(k > 0, F.array(one(F.lit(SEP), no), one(t, b["role"] == train_role)))
                              .otherwise(F.array(one(t, b["role"] == train_role))))),
        F.array(one(F.lit(END + "\n"), no))))))
    return chats.select("conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"))


def parse_chat(formatted: Column) -> Column:
    """Turns of a formatted string: array<struct<role, text>>, texts and roles as they were."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: F.length(b) > 0)

    def turns(block: Column) -> Column:
        cut = F.instr(block, "\n")
        role = unescape_role(F.substring(block, F.lit(1), cut - 1))
        body = F.substring(block, cut + 1, F.length(block) - cut - len(END) - 1)
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
