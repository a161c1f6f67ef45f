"""Chat formatting with typed content parts.

A message's content is a list of typed parts. The visitor turns every part into its piece
of the conversation's text: texts are escaped, and images, audio and documents become
ordered placeholders ``<image:0>`` with a row in ``attachments``. Only DataFrame functions
are used; conversations meet in one shuffle.

The template of one turn is ``<turn ROLE>\\nCONTENT</turn>\\n``. Markers begin with ``<``,
which no escaped text holds: in texts and roles ``\\`` becomes ``\\b``, ``<`` becomes ``\\l``
and ``>`` becomes ``\\g``, and nothing else changes.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, HEAD_END, TAIL = "<turn ", ">\n", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))

# Fixed costs of attached media, in tokens.
PATCH_PIXELS = 28  # an image is cut into patches of this side, one token each
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256

MEDIA = (
    ("ref", "string"),
    ("width", "bigint"),
    ("height", "bigint"),
    ("seconds", "double"),
    ("pages", "bigint"),
)
PART = "struct<type:string,text:string," + ",".join(f"{n}:{k}" for n, k in MEDIA) + ">"


def escaped(text: Column) -> Column:
    for char, code in ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for char, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def text_part(text: Column) -> Column:
    """A plain text as the only part of a message; null is the empty text."""
    media = [F.lit(None).cast(kind).alias(name) for name, kind in MEDIA]
    return F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *media)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def part_tokens(part: Column) -> Column:
    """Tokens a part stands for once it is expanded: words of a text, units of a medium."""
    text = F.trim(F.regexp_replace(F.coalesce(part["text"], F.lit("")), r"\s+", " "))
    count = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    patches = lambda side: F.ceil(count(side) / PATCH_PIXELS)
    return (
        F.when(_is_text(part), F.when(text == "", 0).otherwise(F.size(F.split(text, " "))))
        .when(part["type"] == "image", patches(part["width"]) * patches(part["height"]))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", count(part["pages"]) * DOCUMENT_TOKENS_PER_PAGE)
        .otherwise(0)
        .cast("long")
    )


def format_chats(messages: DataFrame, train_role: str = "assistant") -> DataFrame:
    """``conv_id, turn, role, parts`` to one row per conversation.

    Returns ``conv_id, formatted, loss_mask, attachments, n_tokens``. ``loss_mask`` holds the
    spans ``start, end`` (code points of ``formatted``, end exclusive) of what ``train_role``
    says; ``attachments`` one row per part that is not text, in order: its number, type,
    reference, tokens. A part without a type is text; an unknown type becomes a placeholder
    of no tokens.

    Rows are ordered by ``turn`` (null first), then role, then content, so ties and repeated
    rows have one defined order and all are kept. A null role is empty, a message without
    parts is an empty turn, and rows with a null ``conv_id`` form one conversation. An empty
    table gives none; other columns are ignored. A conversation is one row of the result and
    so has to fit into one.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = messages.select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.filter(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()).alias("parts"),
    )
    rows = rows.withColumn("media", F.size(F.filter("parts", lambda p: ~_is_text(p))))
    rows = rows.withColumn("tie", F.xxhash64("parts"))
    order = ("turn", "role", "tie")
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Ordinals of media run through the conversation; only rows with media need them spelled out.
    rows = rows.withColumn("first", F.coalesce(F.sum("media").over(before), F.lit(0)))

    def piece(part: Column, number: Column) -> Column:
        placeholder = F.concat(F.lit("<"), escaped(part["type"]), F.lit(":"), number.cast("string"), F.lit(">"))
        return F.when(_is_text(part), escaped(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)

    def visit(part: Column, i: Column) -> Column:
        seen = F.size(F.filter(F.slice("parts", F.lit(1), i), lambda p: ~_is_text(p)))
        number = F.col("first") + F.when(F.col("media") == 0, 0).otherwise(seen)
        return F.struct(
            piece(part, number).alias("piece"),
            _is_text(part).alias("is_text"),
            number.cast("long").alias("number"),
            part["type"].alias("type"),
            part["ref"].alias("ref"),
            part_tokens(part).alias("tokens"),
        )

    rows = rows.withColumn("visited", F.transform("parts", visit))
    rows = rows.withColumn("head", F.concat(F.lit(HEAD), escaped(F.col("role")), F.lit(HEAD_END)))
    rows = rows.withColumn("content", F.array_join(F.transform("visited", lambda v: v["piece"]), ""))
    size = F.length("head") + F.length("content") + F.lit(len(TAIL))
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")
    rows = rows.withColumn("start", start.cast("long"))
    turn = F.struct(
        *order,
        "start",
        F.concat("head", "content", F.lit(TAIL)).alias("text"),
        F.length("content").cast("long").alias("chars"),
        F.filter("visited", lambda v: ~v["is_text"]).alias("media"),
        F.aggregate("visited", F.lit(0).cast("long"), lambda n, v: n + v["tokens"]).alias("tokens"),
    )
    turns = F.array_sort(F.collect_list(turn), lambda a, b: (a["start"] - b["start"]).cast("int"))
    chats = rows.groupBy("conv_id").agg(turns.alias("turns"))
    said = F.filter("turns", lambda t: (t["role"] == train_role) & (t["chars"] > 0))
    media = F.flatten(F.transform("turns", lambda t: t["media"]))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        F.transform(
            said, lambda t: F.struct(t["start"].alias("start"), (t["start"] + t["chars"]).alias("end"))
        ).alias("loss_mask"),
        F.transform(
            media,
            lambda m: F.struct(
                m["number"].alias("number"),
                m["type"].alias("type"),
                m["ref"].alias("ref"),
                m["tokens"].alias("tokens"),
            ),
        ).alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("n_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``, unescaped.

    Placeholders of media stay what they are; an escaped text never holds one.
    """
    pieces = F.split(formatted, F.lit(TAIL))
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        # the head of a piece ends with the first ``>`` that a line end follows
        size = F.instr(piece, HEAD_END)
        return F.struct(
            unescaped(F.substring(piece, F.lit(len(HEAD) + 1), size - len(HEAD) - 1)).alias("role"),
            unescaped(F.substring(piece, size + len(HEAD_END), F.length(piece))).alias("text"),
        )

    return F.transform(turns, turn)


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped."""
    cut = lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(loss_mask, cut), "")
