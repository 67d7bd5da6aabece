"""Chats as one string, with attachments as placeholders and a mask of what is learned.

Built-in functions throughout. A turn's content is a list of typed parts. A visitor turns text
into escaped text and an image, audio or document part into a placeholder; the attachments of
a conversation are listed in the order of their placeholders, each with the number of tokens
it will take.

Control strings: a turn is ``<|turn|>role<|text|>content<|end|>``. A backslash goes before
nothing but a backslash and after the first character of what looks like a control string of
this or of common templates, so no text can close a turn and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

#: Tokens for each unit of an attachment: patches of an image, seconds of audio, pages.
TOKENS_PER_UNIT = {"image": 1.0, "audio": 25.0, "document": 512.0}

#: What a part looks like; ``units`` counts patches, seconds or pages.
PART = "struct<type:string,text:string,ref:string,units:double>"

_OPENS = r"<(?=\||/?s>|</?SYS>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({_OPENS})", r"$1\\")


def unescape(text: Column) -> Column:
    """A backslash gives way to the character behind it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(turns: DataFrame) -> DataFrame:
    """Turns whose content is the column ``text``, as turns with one text part (PART) each."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.col("text").alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("double").alias("units"),
    )
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def _visited(parts: Column) -> Column:
    """The formatted content of a turn; a part of unknown type is taken for text.

    Neighbouring texts are escaped as one, or a control string dealt over them would pass.
    """

    def add(seen: Column, part: Column) -> Column:
        kind = F.coalesce(part["type"], F.lit("text"))
        placed = F.concat(seen["done"], escape(seen["said"]), F.lit("<|"), kind, F.lit("|>"))
        said = F.concat(seen["said"], F.coalesce(part["text"], F.lit("")))
        is_placed = kind.isin(*TOKENS_PER_UNIT)
        return F.struct(
            F.when(is_placed, placed).otherwise(seen["done"]).alias("done"),
            F.when(is_placed, F.lit("")).otherwise(said).alias("said"),
        )

    nothing = F.struct(F.lit("").alias("done"), F.lit("").alias("said"))
    return F.aggregate(parts, nothing, add, lambda seen: F.concat(seen["done"], escape(seen["said"])))


def _attachment(part: Column, turn: Column) -> Column:
    rates = F.create_map(*[F.lit(x) for pair in TOKENS_PER_UNIT.items() for x in pair])
    tokens = F.ceil(F.coalesce(part["units"], F.lit(1.0)) * rates[part["type"]])
    return F.struct(
        turn.alias("turn"), part["type"].alias("type"), part["ref"].alias("ref"), tokens.cast("bigint").alias("tokens")
    )


def format_chats(turns: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, attachment_tokens.

    ``turns`` has conv_id, turn, role and parts (an array of PART). ``loss_spans`` are
    [start, end) in code points of ``formatted``: the content of each turn of
    ``learned_role``, without its control strings.

    Turns are ordered by number, those without one first; turns of one number by role and
    content, so repeated rows are repeated turns. A NULL role is the empty role, a NULL text
    the empty text, a NULL list no parts; turns without a conv_id are one conversation. An
    empty table gives an empty result. Other columns are not read.
    """
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    content = _visited(parts)
    attached = F.filter(parts, lambda p: p["type"].isin(*TOKENS_PER_UNIT))
    role = F.coalesce("role", F.lit(""))
    rows = turns.select(
        "conv_id",
        "turn",
        (role == learned_role).alias("learned"),
        F.concat(F.lit(TURN), escape(role), F.lit(TEXT)).alias("head"),
        content.alias("content"),
        F.transform(attached, lambda p: _attachment(p, F.col("turn"))).alias("attached"),
    )
    order = ("turn", "head", "content")
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("content") + len(END)
    placed = rows.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)))
    start = F.col("at") + F.length("head")
    span = F.struct(start.alias("start"), (start + F.length("content")).alias("end"))
    collected = placed.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("at"),
                    F.concat("head", "content", F.lit(END)).alias("piece"),
                    F.when(F.col("learned"), span).alias("span"),
                    F.col("attached"),
                )
            )
        ).alias("pieces")
    )
    attachments = F.flatten(F.col("pieces.attached"))
    return collected.select(
        "conv_id",
        F.concat_ws("", F.col("pieces.piece")).alias("formatted"),
        F.filter(F.col("pieces.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias(
            "attachment_tokens"
        ),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text); placeholders stay in the text."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>"), 2, F.lit(2**31 - 2))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, TEXT, 1)
        rest = F.substring(piece, F.length(role) + len(TEXT) + 1, F.length(piece))
        text = F.substring(rest, F.lit(1), F.length(rest) - len(END))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.concat_ws(
        "",
        F.transform(
            loss_spans,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
    )
