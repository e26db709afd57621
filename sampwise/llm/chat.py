"""Chat formatting in Spark expressions only (no Python on the data path).

``format_chats`` turns (conversation, turn, role, text) rows into one formatted
string per conversation:

* turns are collected as structs and sorted by (turn, role, text), nulls first;
* adjacent turns of one role form a block, found and joined with array functions;
* a block is ``<|im_start|>role LF text <|im_part|> text <|im_end|> LF``; a block
  of one turn has no ``<|im_part|>``;
* texts are escaped so that no control string can occur in them: every run
  ``<`` + n backslashes + ``|`` gets one more backslash.  Dropping one backslash
  restores the text exactly.  Roles also code backslash as ``\\s`` and LF as ``\\n``.

The result also carries ``segments``: the same string cut into (text, loss) runs,
loss marking exactly the assistant texts, escapes included, controls excluded.

Defined cases: null text and null role are empty; equal (turn, role, text) rows
stay as many turns as there are rows; null turns sort first; a null conversation
id is one conversation of its own; an empty table gives an empty result; all
other input columns are ignored, whatever their names.

One output string holds one conversation, so a conversation is the unit of
memory; rows of different conversations never share a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, PART, END = "<|im_start|>", "<|im_part|>", "<|im_end|>"
CLOSE = END + "\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    coded = F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))
    return escape(coded)


def unescape_role(role: Column) -> Column:
    plain = F.replace(unescape(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\\s"), F.lit("\\"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """Rows (conv_id, formatted, segments), one per conversation."""
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"),
                 F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # positions at which the role changes, then one slice of turns per block
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]))
    cut = sorted_turns.withColumn("starts", starts)
    blocks = F.transform(
        "starts",
        lambda s, k: F.slice("turns", s + 1,
                             F.coalesce(F.get("starts", k + 1), F.size("turns")) - s))

    def block_segments(block):
        name = F.get(block, F.lit(0))["role"]
        head = F.concat(F.lit(START), escape_role(name), F.lit("\n"))
        loss = name == F.lit(loss_role)
        control = lambda s: F.struct(s.alias("text"), F.lit(False).alias("loss"))
        body = F.flatten(F.transform(block, lambda t, i: F.array(
            control(F.when(i == 0, head).otherwise(F.lit(PART))),
            F.struct(escape(t["text"]).alias("text"), loss.alias("loss")))))
        return F.concat(body, F.array(control(F.lit(CLOSE))))

    merged = cut.select("conv_id", F.flatten(F.transform(blocks, block_segments)).alias("segments"))
    return merged.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments")


def parse_chats(formatted: Column) -> Column:
    """The turns in a formatted string: array<struct<role, text>>, unescaped."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    blocks = F.slice(parts, F.lit(2), F.size(parts) - 1)

    def turns_of(block):
        cut = F.instr(block, "\n")
        role = unescape_role(F.substring(block, F.lit(1), cut - 1))
        body = F.substring(block, cut + 1, F.length(block) - cut - len(CLOSE))
        return F.transform(F.split(body, r"<\|im_part\|>", -1),
                           lambda part: F.struct(role.alias("role"), unescape(part).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def unescaped_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")
