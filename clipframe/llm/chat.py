"""Chat formatting with typed content parts, in DataFrame functions only.

A conversation becomes one string of marked turns. Control strings inside texts are
escaped so that they can be restored, and attachments become placeholders in place.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template. Strings in CONTROLS have a meaning to common chat
# templates; all of them are escaped in texts, also those that this one does not use.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROLS = (OPEN, CLOSE, *PLACEHOLDERS.values(), "<|endoftext|>", "<s>", "</s>", "[INST]",
            "[/INST]", "<<SYS>>", "<</SYS>>")

# Expanded token counts: image tiles, seconds of audio, pages of a document
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}

PART = "struct<type:string,text:string,ref:string,units:double>"
BLOCK_TURNS = 64
LOSS_ROLE = "assistant"

_HEADS = "([<\\[])"
_TAILS = "(" + "|".join(sorted({re.escape(c[1:]) for c in CONTROLS}, key=len, reverse=True)) + ")"


def escape(text: Column) -> Column:
    """One backslash more after the first character of each control string, escaped or not."""
    return F.regexp_replace(text, _HEADS + r"(\\*)" + _TAILS, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEADS + r"\\(\\*)" + _TAILS, "$1$2$3")


def one_line(role: Column) -> Column:
    """A role without line feeds, which end it in the string."""
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def lines(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A plain text as a list of one typed part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units")))


def _kind(part: Column) -> Column:
    return F.lower(F.coalesce(part["type"], F.lit("text")))


def text_tokens(text: Column) -> Column:
    """Words and single marks: a measure that needs no tokenizer."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"))


def visit(part: Column) -> Column:
    """What a part adds to the string: escaped text, or the placeholder of its type.

    Parts of an unknown type with a text count as text, without one as nothing; a
    null type is text.
    """
    kind = _kind(part)
    shown = escape(F.coalesce(part["text"], F.lit("")))
    for name, placeholder in PLACEHOLDERS.items():
        shown = F.when(kind == name, F.lit(placeholder)).otherwise(shown)
    return shown


def expanded_tokens(part: Column) -> Column:
    """Tokens after placeholders are expanded: units (1 if null) times those of the type."""
    kind = _kind(part)
    n = text_tokens(F.coalesce(part["text"], F.lit(""))).cast("long")
    units = F.ceil(F.greatest(F.coalesce(part["units"], F.lit(1.0)), F.lit(0.0)))
    for name, each in TOKENS_PER_UNIT.items():
        n = F.when(kind == name, (units * each).cast("long")).otherwise(n)
    return n


def flatten(rows: DataFrame, parts: Column) -> DataFrame:
    """Adds ``flat``, ``attachments`` and ``n_tokens`` of a turn's list of typed parts.

    ``flat`` holds the parts in order; ``attachments`` lists type, reference, tokens
    and the ordinal of the placeholder in the turn. A null list or part is nothing.
    """
    some = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    attached = F.filter(some, lambda p: _kind(p).isin(*PLACEHOLDERS))
    return rows.withColumns({
        "flat": F.array_join(F.transform(some, visit), ""),
        "attachments": F.transform(attached, lambda p, i: F.struct(
            i.alias("place"), _kind(p).alias("type"), p["ref"].alias("ref"),
            expanded_tokens(p).alias("n_tokens"))),
        "n_tokens": F.aggregate(some, F.lit(0).cast("long"),
                                lambda total, p: total + expanded_tokens(p)),
    })


def format_turns(rows: DataFrame, parts: Column, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``(conv_id, formatted, spans, attachments, n_tokens)``, one row a conversation.

    Takes rows ``(conv_id, turn, role)`` and a column of typed parts. Turns follow
    by ``turn`` (a null first), equal ones by role, then by text. ``spans`` are the
    zero-based code-point ranges under the loss mask: the texts of ``loss_role``,
    without marks. Any role comes back, line feeds included. A null role is the empty role, a null ``conv_id`` is a
    conversation of its own; repeated rows are repeated turns. A conversation is
    gathered in two steps, joined blocks of 64 turns first, so that a very long one
    is not sent turn by turn to a task. An empty table gives no rows.
    """
    role = escape(one_line(F.coalesce("role", F.lit(""))))
    turns = flatten(rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts")),
                    F.col("parts"))
    turns = turns.select(
        "conv_id", F.floor(F.coalesce("turn", F.lit(-(1 << 40))) / BLOCK_TURNS).alias("block"),
        F.struct("turn", "role", "flat", F.length(role).alias("head"),
                 F.concat(F.lit(OPEN), role, F.lit("\n"), "flat", F.lit(CLOSE + "\n")).alias("shown"),
                 "attachments", "n_tokens").alias("t"))
    # (length so far, spans so far): spans of a list of turns, from its own start
    zero = F.struct(F.lit(0).cast("long").alias("n"),
                    F.array().cast("array<struct<from:bigint,to:bigint>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start = state["n"] + F.lit(len(OPEN) + 1) + t["head"]
        span = F.array(F.struct(start.cast("long").alias("from"),
                                (start + F.length(t["flat"])).cast("long").alias("to")))
        return F.struct((state["n"] + F.length(t["shown"])).cast("long").alias("n"),
                        F.when(t["role"] == loss_role, F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    blocks = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    blocks = blocks.select("conv_id", F.struct(
        "block", F.array_join(F.transform("ts", lambda t: t["shown"]), "").alias("shown"),
        F.aggregate("ts", zero, add).alias("state"),
        F.flatten(F.transform("ts", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate("ts", F.lit(0).cast("long"), lambda n, t: n + t["n_tokens"])
        .alias("n_tokens")).alias("b"))

    def follow(state: Column, b: Column) -> Column:
        moved = F.transform(b["state"]["spans"], lambda s: F.struct(
            (s["from"] + state["n"]).alias("from"), (s["to"] + state["n"]).alias("to")))
        return F.struct((state["n"] + b["state"]["n"]).alias("n"),
                        F.concat(state["spans"], moved).alias("spans"))

    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("bs"))
    return whole.select(
        "conv_id", F.array_join(F.transform("bs", lambda b: b["shown"]), "").alias("formatted"),
        F.aggregate("bs", zero, follow)["spans"].alias("spans"),
        F.flatten(F.transform("bs", lambda b: b["attachments"])).alias("attachments"),
        F.aggregate("bs", F.lit(0).cast("long"), lambda n, b: n + b["n_tokens"])
        .alias("n_tokens"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted string: ``array<struct<role, text>>``, texts unescaped.

    Placeholders stay as they are; a plain text that looks like one is restored.
    """
    pieces = F.filter(F.split(formatted, re.escape(OPEN)), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        lines(unescape(F.substring_index(p, "\n", 1))).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n")
                             - F.lit(len(CLOSE) + 1))).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))), "")
