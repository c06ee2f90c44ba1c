r"""Conversations with typed content parts as training text, with DataFrame functions only.

A turn's content is an array of parts ``(type, text, ref, units)``. A visitor flattens them in order: text parts become
their escaped text; image, audio and document parts become a placeholder, and leave an attachment record with turn, part,
reference and the tokens the placeholder expands to. A conversation is its turns in order:

    user        [INST]text[/INST]
    assistant   [OUT]text</s>
    any other   [ROLE]role[SEP]text[/ROLE]

Control strings inside texts and roles are escaped so that none is left: a backslash becomes two, and a control string
gets one after its first character (``</s>`` is ``<\/s>``). Dropping each backslash before a character undoes it.

Sums over earlier turns give the place of every turn, so the loss mask - the assistants' texts - is known as spans of the
formatted text. Turns are formatted where they are read; a conversation is then put together in one row, which is what a
conversation is here, so its length bounds the row.

Defined results: a null text, part or array of parts is empty; a null role is an empty one; turns with equal numbers are
ordered by role and content, null numbers come first; rows without a conversation identifier form one conversation; a
part of an unknown type has the placeholder of a document; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Placeholders and the tokens that one unit (image tile, second of audio, page) expands to.
PLACEHOLDERS = {"image": ("[IMAGE]", 256), "audio": ("[AUDIO]", 25), "document": ("[DOCUMENT]", 512)}
#: Every string that means something in the formatted text.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[SEP]", "[/ROLE]",
           *(mark for mark, _ in PLACEHOLDERS.values()))
PART = "struct<type:string,text:string,ref:string,units:long>"

_START = "<s>"
_CONTROL_START = r"([<\[])(?=(?:" + "|".join(
    c[1:].replace("]", r"\]") for c in CONTROL) + "))"
_TURN = (r"(?s)\[INST\](.*?)\[/INST\]|\[OUT\](.*?)</s>|\[ROLE\](.*?)\[SEP\](.*?)\[/ROLE\]")


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL_START, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A content array of one text part."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), none.cast("string").alias("ref"),
                            none.cast("long").alias("units")))


def _visit(part: Column) -> Column:
    """The formatted text of a part."""
    kind = F.coalesce(part["type"], F.lit("text"))
    result = F.when(kind == "text", escape(part["text"]))
    for name, (mark, _) in PLACEHOLDERS.items():
        if name != "document":
            result = result.when(kind == name, F.lit(mark))
    return F.when(part.isNull(), F.lit("")).otherwise(result.otherwise(F.lit(PLACEHOLDERS["document"][0])))


def _tokens(part: Column) -> Column:
    kind, units = part["type"], F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))
    result = F.when(kind == "image", units * PLACEHOLDERS["image"][1]).when(kind == "audio", units * PLACEHOLDERS["audio"][1])
    return result.otherwise(units * PLACEHOLDERS["document"][1])


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, content`` to one row per turn: its formatted text and attachments. Nothing is shuffled."""
    content = F.coalesce(F.col("content"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    body = F.array_join(F.transform(content, _visit), "")
    row = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), content.alias("content"), body.alias("body"))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    text = F.when(user, F.concat(F.lit("[INST]"), "body", F.lit("[/INST]"))) \
        .when(assistant, F.concat(F.lit("[OUT]"), "body", F.lit("</s>"))) \
        .otherwise(F.concat(F.lit("[ROLE]"), escape(F.col("role")), F.lit("[SEP]"), "body", F.lit("[/ROLE]")))
    numbered = F.transform("content", lambda p, i: F.struct(
        i.cast("long").alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    attached = F.filter(numbered, lambda p: p["type"].isNotNull() & (p["type"] != "text"))
    return row.select("conv_id", "turn", "role", text.alias("formatted_turn"), assistant.alias("in_loss"),
                      F.char_length("body").cast("long").alias("body_chars"), attached.alias("attachments"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, n_turns, loss_spans, attachments, attachment_tokens``.

    ``loss_spans`` are (start, length) in characters of ``formatted``; attachments are in reading order.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "formatted_turn")
    chars = F.char_length("formatted_turn").cast("long")
    before = F.coalesce(F.sum(chars).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + len(_START)
    placed = format_turns(turns).withColumns({"place": F.row_number().over(order), "start": before})
    span = F.struct((F.col("start") + len("[OUT]")).alias("start"), F.col("body_chars").alias("length"))
    attached = F.transform("attachments", lambda a: F.struct(
        F.col("place").cast("long").alias("turn_place"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"),
        a["tokens"].alias("tokens")))
    one = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "formatted_turn"))).alias("texts"),
        F.array_sort(F.collect_list(F.when(F.col("in_loss"), span))).alias("loss_spans"),
        F.array_sort(F.flatten(F.collect_list(attached))).alias("attachments"))
    return one.select(
        "conv_id", F.concat(F.lit(_START), F.array_join("texts.formatted_turn", "")).alias("formatted"),
        F.size("texts").cast("long").alias("n_turns"), "loss_spans", "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text); placeholders stay in the text."""
    found = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))

    def turn(piece: Column) -> Column:
        user, assistant = piece.startswith("[INST]"), piece.startswith("[OUT]")
        role = F.when(user, F.lit("user")).when(assistant, F.lit("assistant")).otherwise(
            unescape(F.regexp_extract(piece, r"(?s)^\[ROLE\](.*?)\[SEP\]", 1)))
        text = F.regexp_replace(
            piece, r"(?s)^(?:\[INST\]|\[OUT\]|\[ROLE\].*?\[SEP\])|(?:\[/INST\]|</s>|\[/ROLE\])$", "")
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(found, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation holds, read back from its text and, for the loss, from the spans of its mask."""
    turns = F.col("turns")
    every = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    read = formatted.select("conv_id", read_turns(F.col("formatted")).alias("turns"), F.array_join(under, "").alias("loss"),
                            F.char_length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
