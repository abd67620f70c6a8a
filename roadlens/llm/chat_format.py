"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of typed parts. A visitor (one column expression with a case for each type) flattens them
in order: text as it is, every other part as a placeholder numbered within the turn, with a reference to its
attachment and the number of tokens the placeholder stands for. Turns are framed by control strings; control strings
inside texts are escaped reversibly.

    <|turn|>role<|say|>text<|image:0|>text<|end|>

A conversation's output is its formatted text, the loss mask (spans of what assistants say, in code points) and the
attachments in order. Everything is read back from the output by `turns` and `loss_text`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>"
MARK = "␛"
#: Code points of a block in which a long text is looked up.
BLOCK = 4096
#: Control strings and what stands for them inside texts. MARK itself comes first, so that a marked text is unambiguous.
ESCAPES = ((MARK, MARK + "0"), ("<|", MARK + "1"), ("</s>", MARK + "2"), ("<s>", MARK + "3"), ("[INST]", MARK + "4"), ("[/INST]", MARK + "5"))
PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHED = ("image", "audio", "document")
#: Tokens that attachments expand to: an image by 512-pixel tiles, audio by the second, documents by the page.
IMAGE_BASE, IMAGE_TILE, AUDIO_SECOND, PAGE = 85, 170, 25, 512


def escaped(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A content of one text part; a null text is empty."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def expanded_tokens(part: Column) -> Column:
    """Tokens that a part's placeholder expands to; missing measures count as one tile, second or page."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(1)) / 512) * F.ceil(F.coalesce(part["height"], F.lit(1)) / 512)
    return (
        F.when(part["type"] == "image", IMAGE_BASE + IMAGE_TILE * tiles)
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * AUDIO_SECOND))
        .when(part["type"] == "document", PAGE * F.coalesce(part["pages"], F.lit(1)))
        .otherwise(0)
        .cast("long")
    )


def _visited(part: Column, at: Column) -> Column:
    """A part as text: text parts escaped, others as their placeholder; a part of no known type is one, too, named `other`."""
    name = F.when(part["type"].isin(*ATTACHED), part["type"]).otherwise(F.lit("other"))
    return F.when(part["type"] == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), name, F.lit(":"), at.cast("string"), F.lit("|>")))


def _attachment(part: Column, at: Column) -> Column:
    return F.when(~part["type"].eqNullSafe(F.lit("text")), F.struct(at.cast("int").alias("part"), part["type"].alias("type"), part["ref"].alias("ref"), expanded_tokens(part).alias("tokens")))


def formatted(turns: DataFrame, content: str = "content", conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """conv_id, formatted, mask, attachments, n_turns: one row per conversation.

    turns has one row per turn with a content of typed parts (PART). Turns go by number, ties by role and text; a null
    number goes first, a null role is empty, a null content has no parts. A null conversation id is a conversation too.
    mask: turn (0 first), start and end of what the assistant says, in code points of formatted, and its place in the
    turn. attachments: turn, part, type as given (null or unknown, too), ref, tokens, in order. An empty table gives an empty one; other columns are
    not looked at. A conversation's text is one value, as its hash needs, so it has to fit into one (2 GB).
    """
    flat = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(content, F.expr(f"cast(array() as array<{PART}>)")).alias("c"))
    said = flat.select(
        "conv_id", "turn", "role",
        F.concat_ws("", F.transform("c", _visited)).alias("said"),
        F.array_compact(F.transform("c", _attachment)).alias("att"),
    )
    framed = said.select("conv_id", "turn", "role", "att", F.length("said").alias("n"), F.length(F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAY))).alias("head"), F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAY), "said", F.lit(END)).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = framed.withColumns({"k": F.row_number().over(order) - 1, "at": F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("text")})
    begin = F.col("at") + F.col("head")
    spans = F.when(F.col("role") == "assistant", F.struct(F.col("k").alias("turn"), begin.alias("start"), (begin + F.col("n")).alias("end")))
    att = F.transform("att", lambda a: F.struct(F.col("k").alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    return (
        placed.select("conv_id", "k", "text", spans.alias("span"), att.alias("att"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("texts"), F.array_sort(F.collect_list("span")).alias("mask"), F.array_sort(F.flatten(F.collect_list("att"))).alias("attachments"))
        .select("conv_id", F.concat_ws("", F.col("texts.text")).alias("formatted"), "mask", "attachments", F.size("texts").cast("long").alias("n_turns"))
    )


def turns(formatted_text: Column) -> Column:
    """Reads back an array of role and text from a formatted conversation; placeholders stay as they are."""
    blocks = F.slice(F.split(formatted_text, r"<\|turn\|>"), 2, F.lit(1 << 30))
    return F.transform(blocks, lambda b: F.struct(unescaped(F.substring_index(b, SAY, 1)).alias("role"), unescaped(_after(b)).alias("text")))


def _after(block: Column) -> Column:
    """What stands between SAY and END in a block that begins with a role."""
    head = F.length(F.substring_index(block, SAY, 1)) + len(SAY)
    return F.substring(block, head + 1, F.length(block) - head - len(END))


def loss_text(formatted_text: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped: the spans from start to end of the mask, one after another.

    The text is cut into equal blocks once, as finding a place in a long text takes as long as it is far.
    """
    blocks = F.regexp_extract_all(formatted_text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def part(m: Column) -> Column:
        first, last = F.floor(m["start"] / BLOCK).cast("int"), F.floor(m["end"] / BLOCK).cast("int")
        return F.substring(F.concat_ws("", F.slice(blocks, first + 1, last - first + 1)), (m["start"] - first * BLOCK + 1).cast("int"), (m["end"] - m["start"]).cast("int"))

    return F.concat_ws("", F.transform(mask, lambda m: unescaped(part(m))))


def digest(out: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted and mask."""
    read = out.select("conv_id", turns(F.col("formatted")).alias("t"), loss_text(F.col("formatted"), F.col("mask")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    whole = F.concat_ws("", F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return read.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
