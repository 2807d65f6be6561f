"""Chat formatting: prefix-target expansion of conversations, native DataFrame functions only.

A turn is written as ``<|turn|>role<|body|>text<|end|>``; inside roles and texts
``&`` becomes ``&amp;`` and ``<`` becomes ``&lt;``, so no text can hold a mark and
the escape can be undone.

Every assistant turn is exploded into an example of its own: all turns before it are
context and only its reply is trainable. ``format_conversations`` formats a turn once;
``expand`` deals out the examples, each with its whole context, which is quadratic in the
turns of a conversation. A task holds one example at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import has

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: ``segments``, the formatted turns in order, and ``examples``, an array of
    struct<segment, target_start, target_end> with one entry per assistant turn.

    Example e reads the segments up to ``e.segment`` (from 0), joined by nothing; its loss mask
    covers the code points from ``target_start`` to before ``target_end`` of that segment, which
    are the escaped reply without any mark.

    - Rows come in order of turn, role and text, nulls first; repeated rows are turns of their own.
    - Null role or text: empty. All rows with a null conv_id form one conversation.
    - A conversation without an assistant turn is formatted and has no example.
    - Texts and conversations of any length are formatted whole; a conversation is one row.
    - Empty table: empty result. Other columns are not carried.
    """
    has(turns, "conv_id", "turn", "role", "text")
    row = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("ts"))
    spans = F.transform(
        "ts",
        lambda t, i: F.struct(
            (t["role"] == ASSISTANT).alias("target"),
            i.alias("segment"),
            (F.char_length(escape(t["role"])) + len(TURN) + len(BODY)).alias("start"),
            F.char_length(escape(t["text"])).alias("chars"),
        ),
    )
    return ordered.select(
        "conv_id",
        F.transform(
            "ts",
            lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY), escape(t["text"]), F.lit(END)),
        ).alias("segments"),
        F.transform(
            F.filter(spans, lambda s: s["target"]),
            lambda s: F.struct(
                s["segment"].alias("segment"),
                s["start"].alias("target_start"),
                (s["start"] + s["chars"]).alias("target_end"),
            ),
        ).alias("examples"),
    )


def expand(formatted: DataFrame) -> DataFrame:
    """The examples as rows, one per assistant turn: conv_id, example (from 0), ``context`` (the number of turns before the
    reply's, all of them context), ``before`` (these turns, formatted), ``target`` (the reply's segment), the loss mask as
    ``loss_start`` and ``loss_end`` in code points of the target, and ``after``: the formatted turns behind the conversation's
    last reply, which belong to no example, in the row of that reply; null in the others. Nothing of the context is trainable.

    Quadratic in a conversation's turns where ``before`` is read, else linear. A conversation without an assistant turn has
    no row; ``unanswered`` has it."""
    at = F.col("e.segment")
    after = F.array_join(F.slice("segments", at + 2, F.size("segments")), "")
    return formatted.select(
        "conv_id", "segments", F.size("examples").alias("n"), F.posexplode("examples").alias("example", "e")
    ).select(
        "conv_id",
        "example",
        at.alias("context"),
        F.array_join(F.slice("segments", 1, at), "").alias("before"),
        F.get("segments", at).alias("target"),
        F.col("e.target_start").alias("loss_start"),
        F.col("e.target_end").alias("loss_end"),
        F.when(F.col("example") == F.col("n") - 1, after).alias("after"),
    )


def with_strings(formatted: DataFrame) -> DataFrame:
    """The examples as strings: conv_id, example (from 0), ``text`` (context and reply), the loss mask as ``loss_start``
    and ``loss_end`` in code points of that text, and ``after`` as ``expand`` gives it. Quadratic in a conversation's turns."""
    shift = F.char_length("before")
    return expand(formatted).select(
        "conv_id",
        "example",
        F.concat("before", "target").alias("text"),
        (shift + F.col("loss_start")).alias("loss_start"),
        (shift + F.col("loss_end")).alias("loss_end"),
        "after",
    )


def unanswered(formatted: DataFrame) -> DataFrame:
    """The conversations without an assistant turn, which have no example, in the columns of ``with_strings``: all of their
    turns are ``after``, and the text is empty."""
    return formatted.where(F.size("examples") == 0).select(
        "conv_id",
        F.lit(None).cast("int").alias("example"),
        F.lit("").alias("text"),
        F.lit(0).alias("loss_start"),
        F.lit(0).alias("loss_end"),
        F.array_join("segments", "").alias("after"),
    )


def _role(segment: Column) -> Column:
    return unescape(F.substring_index(F.substring(segment, len(TURN) + 1, 1 << 30), BODY, 1))


def _text(segment: Column) -> Column:
    return unescape(F.substring_index(F.substring_index(segment, BODY, -1), END, 1))


def read_turns(segments: Column) -> Column:
    """array<struct<role, text>> read back from formatted segments."""
    return F.transform(segments, lambda s: F.struct(_role(s).alias("role"), _text(s).alias("text")))


def read_text(text: Column) -> Column:
    """array<struct<role, text>> read back from formatted turns in one string."""
    pieces = F.split(text, re.escape(TURN))
    return read_turns(F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: F.concat(F.lit(TURN), p)))


def read_targets(segments: Column, examples: Column) -> Column:
    """array<string>: the unescaped text under each example's loss mask."""
    return F.transform(
        examples,
        lambda e: unescape(F.substring(F.get(segments, e["segment"]), e["target_start"] + 1, e["target_end"] - e["target_start"])),
    )
