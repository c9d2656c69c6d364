"""Chat formatting of typed content parts.

A turn's content is an array of parts (``PART``).  A visitor flattens them in order: a text part becomes escaped
text; an image, audio or document part becomes a placeholder, an attachment reference and the number of tokens that
the placeholder stands for.  A turn is ``TURN role LF content END``.  Texts and roles are escaped so that no
``<`` or ``[`` of theirs is left, so no control string (``</s>``, ``[INST]``, a placeholder, a turn mark) can come
from a text, and unescaping gives the very text back.  Only DataFrame functions are used.

Defined cases: a null text or role is empty; null content has no parts; a part of an unknown or null kind with a
text is text, without one an ``attachment`` of no tokens; turns are ordered by turn (nulls first), then role and
content; repeated rows are turns of their own; a null conv_id is a conversation; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,millis:int,pages:int>"
TURN, END = "<|turn|>", "<|end|>\n"
#: Tokens of an attachment: image patches of PATCH x PATCH pixels, audio frames of FRAME_MS, tokens of a page.
PATCH, FRAME_MS, PAGE_TOKENS = 14, 40, 1024


def escape(text: Column) -> Column:
    """Without ``<``, ``[`` and with every ``~`` marked; ``unescape`` is its inverse."""
    return F.replace(F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1")), F.lit("["), F.lit("~2"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~2"), F.lit("[")), F.lit("~1"), F.lit("<")), F.lit("~0"), F.lit("~"))


def _role(role: Column) -> Column:
    return F.replace(escape(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("~3"))


def text_parts(text: Column) -> Column:
    """Content of one text part."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), *[F.lit(None).cast("int").alias(x) for x in ("width", "height", "millis", "pages")])
    return F.array(part)


def _ceil(x: Column, by: int) -> Column:
    return F.ceil(F.coalesce(x, F.lit(0)) / by).cast("long")


def _visit(part: Column) -> Column:
    """A part as ``(is_text, out, kind, ref, tokens)``."""
    media = F.coalesce(part["kind"], F.lit("")).isin("image", "audio", "document")
    is_text = ~media & ((part["kind"] == "text") | part["text"].isNotNull())
    kind = F.when(media, part["kind"]).otherwise(F.lit("attachment"))
    tokens = (
        F.when(kind == "image", _ceil(part["width"], PATCH) * _ceil(part["height"], PATCH))
        .when(kind == "audio", _ceil(part["millis"], FRAME_MS))
        .when(kind == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * PAGE_TOKENS)
        .otherwise(F.lit(0).cast("long"))
    )
    is_text = F.coalesce(is_text, F.lit(False))
    return F.struct(
        is_text.alias("is_text"),
        F.when(is_text, escape(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>"))).alias("out"),
        F.when(~is_text, kind).alias("kind"),
        F.when(~is_text, part["ref"]).alias("ref"),
        F.when(is_text, F.lit(0).cast("long")).otherwise(tokens).alias("tokens"),
    )


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss, attachments, expanded_tokens``.

    ``loss`` lists the spans that count for the loss, ``(turn, start, length)``: the text parts of ``learn``'s
    turns, in code points from the beginning of that turn in ``formatted`` (turns end after ``END``).
    ``attachments`` lists ``(turn, start, kind, ref, tokens)`` in order; ``expanded_tokens`` adds up the tokens.

    Turns are formatted before the shuffle; a conversation's turns then meet in its one result row.
    """
    visited = F.transform(F.coalesce(F.col(f"`{parts_col}`"), F.array().cast(f"array<{PART}>")), _visit)
    t = turns.select(
        F.col(f"`{conv_col}`").alias("_conv"),
        F.col(f"`{turn_col}`").alias("_turn"),
        F.col(f"`{role_col}`").alias("_role"),
        F.concat(F.lit(TURN), _role(F.col(f"`{role_col}`")), F.lit("\n")).alias("_head"),
        visited.alias("_seen"),
    )
    # a part begins after the head and the parts before it
    start = "aggregate(slice(_seen, 1, i), char_length(_head), (n, y) -> n + char_length(y.out))"
    t = t.withColumn("_placed", F.expr(f"transform(_seen, (x, i) -> struct(x as part, {start} as start))"))
    t = t.select(
        "_conv",
        F.struct(
            "_turn",
            "_role",
            F.concat("_head", F.expr("array_join(transform(_seen, x -> x.out), '')")).alias("out"),
            F.when(F.col("_role") == learn, F.expr("transform(filter(_placed, p -> p.part.is_text), p -> struct(p.start as start, char_length(p.part.out) as length))")).alias("loss"),
            F.expr("transform(filter(_placed, p -> not p.part.is_text), p -> struct(p.start as start, p.part.kind as kind, p.part.ref as ref, p.part.tokens as tokens))").alias("media"),
        ).alias("t"),
    )
    # by turn and role, then by the content as it was before escaping
    keyed = F.transform(F.collect_list("t"), lambda x: F.struct(x["_turn"].alias("turn"), x["_role"].alias("role"), unescape(x["out"]).alias("raw"), x.alias("t")))
    c = t.groupBy("_conv").agg(F.transform(F.sort_array(keyed), lambda x: x["t"]).alias("ts"))
    return c.select(
        F.col("_conv").alias("conv_id"),
        F.array_join(F.transform("ts", lambda x: F.concat(x["out"], F.lit(END))), "").alias("formatted"),
        F.expr("flatten(transform(ts, (t, k) -> transform(coalesce(t.loss, array()), s -> struct(k as turn, s.start as start, s.length as length))))").alias("loss"),
        F.expr("flatten(transform(ts, (t, k) -> transform(t.media, m -> struct(k as turn, m.start as start, m.kind as kind, m.ref as ref, m.tokens as tokens))))").alias("attachments"),
        F.expr("aggregate(flatten(transform(ts, t -> t.media)), 0L, (n, m) -> n + m.tokens)").alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, roles, texts, loss_texts`` parsed from ``formatted`` and ``loss`` alone, unescaped.

    Placeholders stay in ``texts`` as they are in the output.
    """
    turns = F.slice(F.split("formatted", r"<\|end\|>\n"), 1, F.size(F.split("formatted", r"<\|end\|>\n")) - 1)
    f = formatted.withColumn("_turns", turns)
    body = F.transform("_turns", lambda x: F.substring(x, len(TURN) + 1, 2**31 - 1))
    f = f.withColumn("_body", body)
    role = lambda x: F.substring_index(x, "\n", 1)
    return f.select(
        "conv_id",
        F.transform("_body", lambda x: unescape(F.replace(role(x), F.lit("~3"), F.lit("\n")))).alias("roles"),
        F.transform("_body", lambda x: unescape(F.substr(x, F.char_length(role(x)) + 2))).alias("texts"),
        F.transform("loss", lambda s: unescape(F.substr(F.col("_turns")[s["turn"]], s["start"] + 1, s["length"]))).alias("loss_texts"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
