"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Each turn becomes a piece of text between marks that tell its role. A control string inside
a text gets a backslash after its first character (one that has some already gets one more),
so no text can open or close a turn, and ``unescaped`` gives the text back. Every assistant
turn is an example of its own: the pieces of all preceding turns are its context, its reply
comes last, and only the reply's text, without its marks, is trainable. What follows the last
reply, or a conversation without any, comes as one more example in which nothing is
trainable, so the last example of a conversation holds all its turns.

Examples repeat their context, so the output grows with the square of the turns of a
conversation; that is the method. They are made one row at a time from the pieces of the
conversation, which must fit into one cell (2 GB).

Defined results: rows stand by turn (nulls first), then role, then text; equal rows are turns
of their own. A null text or role is empty, rows with a null conv_id are one conversation. A
role other than system, user and assistant is written into the opening mark, escaped like a
text. Very long texts need no special care; an empty table gives no examples. Only conv_id,
turn, role and text are read; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing mark of each known role.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
#: Around the name of any other role, and after its text.
OTHER_MARKS = ("<<TURN>>", "<<TEXT>>", "<</TURN>>")
TRAINED = "assistant"
_AFTER_FIRST = r"(/?s>|</?(?:SYS|TURN|TEXT)>>|/?INST\])"
#: A control string, with any number of backslashes after its first character.
ESCAPABLE = rf"([<\[])(\\*){_AFTER_FIRST}"
ESCAPED = rf"([<\[])\\(\\*){_AFTER_FIRST}"
TURN = r"(?s)(?:<s>|\[INST\]|<<SYS>>|<<TURN>>).*?(?:</s>|\[/INST\]|<</SYS>>|<</TURN>>)"


def escaped(text: Column) -> Column:
    """The text without any control string."""
    return F.regexp_replace(text, ESCAPABLE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given."""
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def piece(role: Column, text: Column) -> Column:
    """One turn between its marks."""
    opening, named, closing = OTHER_MARKS
    made = F.concat(F.lit(opening), escaped(role), F.lit(named), escaped(text), F.lit(closing))
    for name, (first, last) in MARKS.items():
        made = F.when(role == name, F.concat(F.lit(first), escaped(text), F.lit(last))).otherwise(made)
    return made


def turns_of(formatted: Column) -> Column:
    """The turns that a formatted text holds, as an array of (role, text)."""

    def inner(turn: Column, first: int, last: int) -> Column:
        return F.substring(turn, F.lit(first + 1), F.length(turn) - (first + last))

    def read(turn: Column) -> Column:
        opening, named, closing = OTHER_MARKS
        whole = inner(turn, len(opening), len(closing))
        read_back = F.struct(
            unescaped(F.substring_index(whole, named, 1)).alias("role"),
            unescaped(F.substring(whole, F.locate(named, whole) + len(named), F.length(whole))).alias("text"),
        )
        for name, (first, last) in MARKS.items():
            known = F.struct(
                F.lit(name).alias("role"), unescaped(inner(turn, len(first), len(last))).alias("text")
            )
            read_back = F.when(F.startswith(turn, F.lit(first)), known).otherwise(read_back)
        return read_back

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), read)


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end, last): examples in order, from 1.

    The loss mask is given in code points of ``text``, end exclusive; it is null where
    nothing is trainable. ``last`` marks the example that holds the whole conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", role.alias("role"), text.alias("text"), piece(role, text).alias("piece"))
    gathered = (
        conversations.select("conv_id", turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select(
            "conv_id",
            F.transform("turns", lambda x: x["piece"]).alias("pieces"),
            F.transform("turns", lambda x: x["role"] == TRAINED).alias("replies"),
        )
    )
    places = F.transform("replies", lambda reply, i: F.struct((i + 1).alias("place"), reply.alias("reply")))
    ends = F.filter(places, lambda x: x["reply"] | (x["place"] == F.size("replies")))
    exploded = gathered.select("conv_id", "pieces", F.posexplode(ends).alias("number", "end")).select(
        "conv_id",
        (F.col("number") + 1).alias("example"),
        F.array_join(F.slice("pieces", F.lit(1), F.col("end.place")), "").alias("text"),
        F.length(F.element_at("pieces", F.col("end.place"))).alias("size"),
        F.col("end.reply").alias("reply"),
        (F.col("end.place") == F.size("pieces")).alias("last"),
    )
    first, closing = (len(mark) for mark in MARKS[TRAINED])
    total = F.length("text")
    return exploded.select(
        "conv_id",
        "example",
        "text",
        F.when(F.col("reply"), total - F.col("size") + first).alias("loss_start"),
        F.when(F.col("reply"), total - closing).alias("loss_end"),
        "last",
    )


def format_report(conversations: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from their texts and masks.

    ``formatted_chars`` counts the last example, that is the whole conversation, and
    ``example_chars`` all of them.
    """
    trained = F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    read = examples(conversations).select(
        "conv_id",
        F.struct("example", unescaped(trained).alias("loss")).alias("part"),
        F.when(F.col("last"), F.col("text")).alias("whole"),
        F.length("text").cast("bigint").alias("size"),
    )
    joined = (
        read.groupBy("conv_id")
        .agg(
            F.sort_array(F.collect_list("part")).alias("parts"),
            F.first("whole", ignorenulls=True).alias("whole"),
            F.count("part.loss").alias("n_examples"),
            F.sum("size").alias("example_chars"),
        )
        .select(
            "conv_id",
            turns_of(F.col("whole")).alias("turns"),
            F.array_join(F.transform("parts", lambda x: x["loss"]), "").alias("loss"),
            F.length("whole").cast("bigint").alias("formatted_chars"),
            "n_examples",
            "example_chars",
        )
    )
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return joined.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
        "example_chars",
    )
