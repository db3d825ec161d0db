"""Chat formatting by prefix-target expansion: one training example per assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """No `<|` is left: every `<`, any number of `%`, `|` gets one `%` more."""
    return F.regexp_replace(text, r"<(%*)\|", r"<%$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<%(%*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As `escape`; a line end, which closes the role, is written `<n`."""
    return F.replace(F.regexp_replace(role, r"<(%*)([|n])", r"<%$1$2"), F.lit("\n"), F.lit("<n"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<n"), F.lit("\n")), r"<%(%*)([|n])", r"<$1$2")


def format_examples(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """One row per example: `conversation`, example long, formatted, loss_start and loss_end.

    Every turn of `target_role` becomes an example of its own: all turns before it as context, and its
    text, `formatted[loss_start:loss_end]` in code points, the only trainable part. Turns after the last
    such turn would be in no example; a conversation that has some gets one more example of all its
    turns, without a trainable part (null bounds). Examples are numbered from 0 in the order of turns.

    A turn reads `<|im_start|>role`, line end, text, `<|im_end|>`, line end. Control strings inside roles
    and texts are escaped reversibly, see `read_turns`. Null roles and texts count as empty, rows of
    equal turn go by role and text, null turns come first, a null conversation is one of its own, and an
    empty table has no examples. Other columns are not looked at.
    """
    row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    whole = turns.groupBy(F.col(conversation)).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    heads = F.transform("turns", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    count = F.size("turns")
    ends = F.filter(
        F.sequence(F.lit(1), count),
        lambda i: (F.element_at("turns", i)["role"] == target_role) | (i == count),
    )
    laid = whole.select(conversation, "turns", heads.alias("heads"), bodies.alias("bodies")).select(
        conversation, "turns", "heads", "bodies", F.posexplode(ends).alias("example", "last")
    )
    closed = F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END + "\n")))
    target = F.element_at("turns", F.col("last"))["role"] == target_role
    before = F.concat(
        F.array_join(F.slice(closed, F.lit(1), F.col("last") - 1), ""),
        F.element_at("heads", F.col("last")),
    )
    parts = laid.select(
        conversation,
        F.col("example").cast("long"),
        before.alias("before"),
        F.element_at("bodies", F.col("last")).alias("body"),
        target.alias("target"),
    )
    return parts.select(
        conversation,
        "example",
        F.concat("before", "body", F.lit(END + "\n")).alias("formatted"),
        F.when(F.col("target"), F.length("before").cast("long")).alias("loss_start"),
        F.when(F.col("target"), (F.length("before") + F.length("body")).cast("long")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns that a formatted example was made of: an array of role and text."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        return F.struct(
            unescape_role(F.substring(piece, F.lit(len(START) + 1), line - len(START) - 1)).alias("role"),
            unescape(F.substring(piece, line + 1, F.length(piece))).alias("text"),
        )

    return F.transform(pieces, turn)


def trained_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped; null without one."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int")))
