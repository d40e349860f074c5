"""Chat formatting with typed content parts, and reading the result back.

A turn's content is a list of parts: text, image, audio, document. A visitor over the
parts writes text escaped and everything else as a placeholder, in order, and records
what each placeholder stands for and how many tokens it will take. Turns are set in
control strings that escaped text cannot contain:

    <|turn|>ROLE<|body|>CONTENT<|end|>

Placeholders are written ``<|part:KIND|>``, so that no kind can be a control string.
In roles and texts ``&`` is written ``&amp;`` and ``<`` is written ``&lt;``, so no ``<``
of theirs is left, and the reverse replacement restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: One content part. ``ref`` names the attachment of a part that is not text.
PART = (
    "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
#: Edge of the square that one image token shows, audio tokens a second, tokens a page.
IMAGE_EDGE, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512
#: The greatest size of a part that is believed.
MOST = 2**31 - 1


def text_part(text: Column) -> Column:
    """A list of one text part."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.cast("string").alias("text"),
            null.cast("string").alias("ref"),
            null.cast("int").alias("width"),
            null.cast("int").alias("height"),
            null.cast("double").alias("seconds"),
            null.cast("int").alias("pages"),
        )
    )


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _visited(part: Column) -> Column:
    """A part's written form, and its reference and token count if it is an attachment."""
    zero = F.lit(0).cast("bigint")
    # Sizes that are unknown, negative or no numbers count as none.
    known = lambda x, none: F.when(x.between(none, MOST), x).otherwise(F.lit(none))
    cells = lambda x: F.ceil(known(x, 0) / IMAGE_EDGE)
    kind = F.coalesce(part["kind"], F.lit("text"))
    tokens = (
        F.when(kind == "image", cells(part["width"]) * cells(part["height"]))
        .when(kind == "audio", F.ceil(known(part["seconds"], 0.0) * AUDIO_RATE))
        .when(kind == "document", known(part["pages"], 0).cast("bigint") * PAGE_TOKENS)
        .otherwise(zero)
    )
    written = F.when(kind == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|part:"), F.regexp_replace(kind, "[^A-Za-z0-9_]", "_"), F.lit("|>"))
    )
    return F.struct(
        written.alias("written"),
        kind.alias("kind"),
        part["ref"].alias("ref"),
        tokens.cast("bigint").alias("tokens"),
    )


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation from rows ``conv_id, turn, role, parts`` (see ``PART``).

    Returns ``conv_id, formatted``; ``loss_spans``, for each turn the code points under
    the loss mask (start = end where none is); ``attachments`` in placeholder order, each
    with kind, reference and tokens; and ``attachment_tokens``. Turns stand in order of
    ``turn`` (null first), then role and content. Null roles and texts are empty, a turn
    without parts has an empty body, a part of another kind is an attachment without
    tokens, a missing, negative or infinite size counts as 0. Rows without a ``conv_id`` make one conversation.
    """
    role = escaped(F.coalesce("role", F.lit("")))
    visited = F.transform(
        F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda x: x.isNotNull()),
        _visited,
    )
    body = F.array_join(F.transform("visited", lambda x: x["written"]), "")
    in_order = Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_first("turn"), "role", "body"
    )
    segments = (
        turns.withColumn("visited", visited)
        .select(
            "conv_id",
            "turn",
            "role",
            body.alias("body"),
            F.concat(F.lit(TURN), role, F.lit(BODY)).alias("head"),
            F.filter("visited", lambda x: x["kind"] != "text").alias("attached"),
        )
        .withColumn("segment", F.concat("head", "body", F.lit(END)))
        .withColumn("place", F.row_number().over(in_order))
        .withColumn(
            "start",
            F.sum(F.length("segment").cast("bigint")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
            - F.length("segment"),
        )
        .withColumn("loss_start", F.col("start") + F.length("head"))
        .withColumn(
            "loss_end",
            F.col("loss_start") + F.when(F.col("role") == loss_role, F.length("body")).otherwise(0),
        )
    )
    cell = F.struct(
        "place",
        "segment",
        F.struct(F.col("loss_start").alias("start"), F.col("loss_end").alias("end")).alias("loss"),
        "attached",
    )
    grouped = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    attachments = F.transform(
        F.flatten(F.transform("cells", lambda x: x["attached"])),
        lambda x: F.struct(x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens")),
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("cells", lambda x: x["segment"]), "").alias("formatted"),
        F.transform("cells", lambda x: x["loss"]).alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn(
        "attachment_tokens",
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, loss_text`` of every turn, from formatted conversations.

    The text is the unescaped body (placeholders as they stand there); ``loss_text`` is
    cut from the conversation by its loss spans. Turns are counted from 0.
    """
    segments = F.split("formatted", r"<\|end\|>", -1)
    rows = formatted.select(
        "conv_id",
        F.posexplode(
            F.arrays_zip(
                F.slice(segments, 1, F.size(segments) - 1).alias("segment"),
                F.col("loss_spans").alias("loss"),
            )
        ).alias("place", "cell"),
    ).select("conv_id", "place", "cell.segment", "cell.loss")
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("segment") + len(END)).over(before), F.lit(0))
    whole = lambda x: unescaped(x)
    head = F.substring_index("segment", BODY, 1)
    rows = rows.withColumn("start", start).withColumn("head", head)
    first = (F.col("loss.start") - F.col("start") + 1).cast("int")
    size = (F.col("loss.end") - F.col("loss.start")).cast("int")
    return rows.select(
        "conv_id",
        "place",
        whole(F.substr("head", F.lit(len(TURN) + 1))).alias("role"),
        whole(F.substr("segment", F.length("head") + len(BODY) + 1)).alias("text"),
        whole(F.substr("segment", first, size)).alias("loss_text"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: number and digest of its turns and of its text under the loss mask."""
    turns = read_turns(formatted).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("place", "role", "text", "loss_text"))).alias("turns"),
    )
    told = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(F.transform("turns", lambda x: x["loss_text"]), "")
    sizes = formatted.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"))
    return (
        turns.join(sizes.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")))
        .select(
            "conv_id",
            "n_turns",
            F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
            F.length(loss).cast("bigint").alias("loss_chars"),
            F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
