"""Chat formatting of conversations with typed content parts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed marks of the template. Texts are escaped so that they hold neither ``<`` nor ``[``.
OPEN, CLOSE = "<|turn|>", "<|end|>"
#: Escapes, in the order in which they are applied; they are undone in the opposite order.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that a placeholder stands for: an image's patches, an audio's frames, a document's pages.
PATCH, FRAMES, PAGE = 14, 25, 512


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def escape_role(role: Column) -> Column:
    """A role stands on one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """A message of one text part."""
    empty = {n: F.lit(None).cast(t) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(c.alias(n) for n, c in empty.items())))


def _visit(part: Column) -> Column:
    """What a part is written as, the attachment it refers to, and the tokens that stands for."""
    known = part["kind"].isin("image", "audio", "document")
    side = lambda c: F.ceil(F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) / PATCH)
    tokens = (
        F.when(part["kind"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["kind"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * FRAMES))
        .when(part["kind"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * PAGE)
        .otherwise(F.lit(0))
        .cast("long")
    )
    written = F.when(known, F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(
        escape(F.coalesce(part["text"], F.lit("")))
    )
    return F.struct(
        written.alias("written"),
        F.when(known, part["kind"]).alias("kind"),
        F.when(known, F.coalesce(part["ref"], F.lit(""))).alias("ref"),
        tokens.alias("tokens"),
    )


def format_chats(
    messages: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask, attachments, attachment_tokens.

    ``parts_col`` holds a message's typed parts in order (type ``array<PART>``). A visitor writes text parts
    escaped and every image, audio or document part as a placeholder ``<|kind|>``, whose references
    and expanded token counts are gathered, in order, in ``attachments`` (ordinal, kind, ref, tokens).
    ``loss_mask`` lists the spans (start, length; code points of ``formatted``, from 0) of what
    assistants say, without the marks.

    Turns are ordered by number, nulls first, then by role and written text, so that repeated numbers
    have one order; repeated rows are all written. A null role is written as empty; a null message or
    part list is an empty text; a part of an unknown kind is taken as text. Conversations with a null id
    are one conversation. Other columns are ignored.
    """
    role = F.coalesce(F.col(role_col), F.lit(""))
    visited = messages.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.transform(F.coalesce(F.col(parts_col), F.from_json(F.lit("[]"), f"array<{PART}>")), _visit).alias("parts"),
    )
    head = lambda m: F.concat(F.lit(OPEN), escape_role(m["role"]), F.lit("\n"))
    tail = CLOSE + "\n"
    flat = visited.select(
        "conv_id",
        "turn",
        "role",
        F.array_join(F.transform("parts", lambda p: p["written"]), "").alias("body"),
        F.transform(
            F.filter("parts", lambda p: p["kind"].isNotNull()),
            lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
        ).alias("attached"),
    )
    # Where each text starts: a running sum, which spills, so that a very long conversation is no trouble.
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.length(head({"role": F.col("role")})) + F.length("body") + len(tail)
    placed = flat.withColumn(
        "start", (F.coalesce(F.sum(whole).over(so_far), F.lit(0)) + F.length(head({"role": F.col("role")}))).cast("int")
    )
    message = F.struct("turn", "role", "body", "start", "attached")
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("messages"))
    spans = F.transform(
        F.filter("messages", lambda m: m["role"] == "assistant"),
        lambda m: F.struct(m["start"].alias("start"), F.length(m["body"]).alias("length")),
    )
    attached = F.flatten(F.transform("messages", lambda m: m["attached"]))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("messages", lambda m: F.concat(head(m), m["body"], F.lit(tail))), "").alias("formatted"),
        spans.alias("loss_mask"),
        F.transform(attached, lambda a, i: F.struct((i + 1).alias("ordinal"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` and the columns turns (role, text; unescaped) and loss_text, read from its output alone."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda p: p != "")
    body = F.transform(pieces, lambda p: F.substring(p, len(OPEN) + 1, 2**31 - 1))
    turns = F.transform(
        body,
        lambda p: F.struct(
            unescape(F.replace(F.substring_index(p, "\n", 1), F.lit("&#10;"), F.lit("\n"))).alias("role"),
            unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text"),
        ),
    )
    said = F.transform("loss_mask", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"])))
    return formatted.select("*", turns.alias("turns"), F.array_join(said, "").alias("loss_text"))


def digests(read: DataFrame) -> DataFrame:
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "attachment_tokens",
    )


SQL = """with m as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') as body,
  replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') as who from m),
c as (select conv_id, count(*) as n_turns,
  string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, body) as turns,
  coalesce(string_agg(text, '' order by turn nulls first, role, body) filter (where role = 'assistant'), '') as said,
  sum(length(who) + length(body) + 17)::bigint as formatted_chars from e group by 1)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(said) as loss_chars, sha256(said) as loss_sha256,
  formatted_chars, 0::bigint as n_attachments, 0::bigint as attachment_tokens from c"""
