"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only that
reply is trainable.  Turns are written as

    <|im_start|>ROLE newline TEXT<|im_end|> newline

Control strings inside a text or role cannot pass for the template's own: each backslash is doubled
and each `<|` is written `<\\|`, which `unescape` undoes.  Line breaks in a role are written `\\n`.
Turns after the last reply are nobody's context; they are kept as one more example per conversation,
with nothing trainable, so that the output holds every turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from washline.names import column

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINABLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Every backslash stands before the character it protects."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """As `unescape`; a single n after the backslash is a line break."""
    marked = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(marked)


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row per conv_id: `parts`, its formatted turns in order, as (trains, head, body).

    Rows are ordered by turn (null first), then role and text.  Null roles and texts count as empty;
    equal rows are turns of their own; a null conv_id is a conversation like any other.
    """
    role = F.coalesce(column("role").cast("string"), F.lit(""))
    text = F.coalesce(column("text").cast("string"), F.lit(""))
    own = turns.select(
        column("conv_id").cast("bigint").alias("conv_id"),
        F.struct(column("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text")).alias("t"),
    )
    grouped = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))

    def part(t: Column) -> Column:
        return F.struct(
            (t["role"] == TRAINABLE).alias("trains"),
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            F.concat(escape(t["text"]), F.lit(END)).alias("body"),
        )

    return grouped.select("conv_id", F.transform("t", part).alias("parts"))


def format_examples(turns: DataFrame) -> DataFrame:
    """conv_id, position, whole, text, loss_start, loss_length: an example per assistant turn, and one for turns after the last.

    `position` is the number of turns in the example, `whole` tells that these are all.  The loss mask
    covers `loss_length` code points of `text` from `loss_start` (0-based) on: the reply, escaped,
    without its end mark.  An example of turns after the last reply, or of a conversation without
    one, has a loss of length 0 at its end.  A conversation's examples together are longer than itself
    by the square of its replies, which the expansion asks for; a task holds one conversation at a time.
    """
    positions = F.filter(
        F.sequence(F.lit(1), F.size("parts")),
        lambda i: F.element_at("parts", i)["trains"] | (i == F.size("parts")),
    )
    examples = conversations_of(turns).select("conv_id", "parts", F.explode(positions).alias("position"))
    before = F.transform(F.slice("parts", F.lit(1), F.col("position")), lambda p: F.concat(p["head"], p["body"]))
    written = examples.select(
        "conv_id",
        "position",
        (F.col("position") == F.size("parts")).alias("whole"),
        F.array_join(before, "").alias("text"),
        F.element_at("parts", F.col("position")).alias("target"),
    )
    body = F.char_length("target.body")
    return written.select(
        "conv_id",
        "position",
        "whole",
        "text",
        (F.char_length("text") - F.when(F.col("target.trains"), body).otherwise(0)).cast("bigint").alias("loss_start"),
        F.when(F.col("target.trains"), body - len(END)).otherwise(0).cast("bigint").alias("loss_length"),
    )


def read_turns(text: Column) -> Column:
    """The turns (role, text) written in an example's text."""
    rest = F.lit((1 << 31) - 1)

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        role = F.substring(part, F.lit(len(START) + 1), line - len(START) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(part, line + 1, rest)).alias("text"))

    return F.transform(F.filter(F.split(text, r"\Q" + END + r"\E", -1), lambda part: part != ""), turn)


def read_loss(text: Column, start: Column, length: Column) -> Column:
    """The text under an example's loss mask, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, read from its examples: turns of the whole one, and every reply under a loss mask.

    conv_id, n_turns, turns_sha256 (of role, line break, text, line break per turn), loss_chars,
    loss_sha256 (of all replies in order), formatted_chars (of all its examples).
    """
    turns = F.when(F.col("whole"), read_turns(F.col("text")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.withColumn("turns", turns).select(
        "conv_id",
        "position",
        F.char_length("text").cast("bigint").alias("chars"),
        read_loss(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.when(F.col("whole"), F.sha2(said, 256)).alias("turns_sha256"),
    )
    replies = F.array_sort(F.collect_list(F.struct("position", "loss")))
    grouped = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(replies, lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
