"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it are context, its reply alone is trainable.
Turns are marked with Llama-style control strings; a control string inside a text is broken up by an
escape, so no text can open or close a turn, and reading back restores the text to the letter.

Defined cases: a null text or role counts as empty; repeated rows are turns of their own; equal turn
numbers are ordered by role and text, null turn numbers come first; rows without a conversation id form
one conversation; an empty table gives no rows; further columns of the input are ignored. Long texts are kept whole.
A conversation is put together once, by one task, and every example is cut from it, so a conversation of thousands of
turns costs what its examples hold, which grows with the square of its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Strings with a meaning to the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    r"""Double every backslash and put ``\-`` behind the first character of every control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\-" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(-|([\\\n]))", "$2")


def _head(role: Column) -> Column:
    """What stands before a turn's text; line ends inside a role are escaped, so the first bare one ends it."""
    name = F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))
    return F.concat(F.when(role == TRAINED_ROLE, "<s>").otherwise("<s>[INST] "), name, F.lit("\n"))


def _tail(role: Column) -> Column:
    return F.when(role == TRAINED_ROLE, "</s>").otherwise(" [/INST]</s>")


def prefix_target_examples(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows by turn in, one row per example out: key, example, formatted, loss_start, loss_end.

    ``formatted`` holds the context and the reply; code points ``[loss_start, loss_end)`` are the reply.
    A conversation that does not end with a reply has one more row with its whole text and an empty mask.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    pieces = turns.select(key, "turn", role.alias("role"), text.alias("text"), _head(role).alias("head"), escape(text).alias("body"), _tail(role).alias("tail"))
    piece = F.concat("head", "body", "tail")
    so_far = Window.partitionBy(key).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.col("end") - F.length(piece) + F.length("head")
    pieces = pieces.withColumn("end", F.sum(F.length(piece)).over(so_far)).select(
        key,
        F.struct(
            "end",  # first, as no piece is empty: the order of the turns
            begin.alias("loss_start"),
            (begin + F.when(F.col("role") == TRAINED_ROLE, F.length("body")).otherwise(0)).alias("loss_end"),
            (F.col("role") == TRAINED_ROLE).alias("trained"),
            piece.alias("piece"),
        ).alias("turn"),
    )
    talks = pieces.groupBy(key).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    marks = F.transform("turns", lambda t: t.dropFields("piece"))
    ends = F.filter(marks, lambda t: t["trained"] | (t["end"] == F.element_at("turns", -1)["end"]))
    talks = talks.select(key, F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("whole"), ends.alias("ends"))
    rows = talks.select(key, "whole", F.posexplode("ends").alias("example", "upto"))
    cut = F.substring("whole", F.lit(1), F.col("upto.end").cast("int"))
    return rows.select(key, "example", cut.alias("formatted"), "upto.loss_start", "upto.loss_end")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as array of struct(role, text)."""

    def one(piece: Column) -> Column:
        inner = F.regexp_replace(piece, r"(?s)^<s>(?:\[INST\] (.*) \[/INST\]|(.*))$", "$1$2")
        return F.struct(
            unescape(F.regexp_extract(inner, r"(?s)^((?:[^\\\n]|\\.)*)\n", 1)).alias("role"),
            unescape(F.regexp_extract(inner, r"(?s)^(?:[^\\\n]|\\.)*\n(.*)$", 1)).alias("text"),
        )

    pieces = F.split(formatted, "</s>")
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), one)


def digest(examples: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the examples: turns and their hash, trained text and its hash."""
    loss = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    talks = examples.select(key, "example", "formatted", loss.alias("loss")).groupBy(key).agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return talks.withColumn("turns", read_turns(F.col("whole"))).select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
