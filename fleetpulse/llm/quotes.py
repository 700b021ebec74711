"""Quotation linking: quoted passages joined to the messages they come from."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored, text_blocks

_MARKS = re.compile(r"[ \t]*>[ \t>]*")
_BLANKS = re.compile(r"\s+")


def parsed(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """The text without its quoted lines, and its passages as (level, text).

    A quoted line begins with ``>`` after blanks; its level is the number of
    ``>`` before the first other character. A passage is a run of lines of one level.
    """
    own, passages, last = [], [], 0
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        if not marks:
            own.append(line)
            last = 0
            continue
        level, rest = marks.group().count(">"), line[marks.end() :]
        if level == last:
            passages[-1][1].append(rest)
        else:
            passages.append((level, [rest]))
        last = level
    return "\n".join(own).strip("\n"), [(level, "\n".join(lines)) for level, lines in passages]


def normal(text: str) -> str:
    """Lower case, every run of white space one space."""
    return _BLANKS.sub(" ", text.lower()).strip()


def passage_keys(text: str) -> list[tuple[bytes, int, int]]:
    """Hash, length and number of words of the whole passage and of each of its lines, as far as they are not blank."""
    parts = dict.fromkeys(normal(p) for p in [text, *text.split("\n")])
    return [(hashlib.md5(p.encode()).digest(), len(p), p.count(" ") + 1) for p in parts if p]


def said_keys(own: str) -> list[bytes]:
    """Hashes of all that can be quoted of a message: the whole, its paragraphs and its lines."""
    paragraphs = re.split(r"\n[ \t]*\n", own)
    parts = dict.fromkeys(normal(p) for p in [own, *paragraphs, *own.split("\n")])
    return [hashlib.md5(p.encode()).digest() for p in parts if p]


#: Words of a passage that is linked to another conversation, at least.
FAR_WORDS = 3

_QUOTE = pa.struct(
    [("level", pa.int32()), ("number", pa.int32()), ("length", pa.int32()), ("words", pa.int32()), ("key", pa.binary())]
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_blocks(batches):
        own, count, quoted, said = [], [], [], []
        for text in texts:
            left, passages = parsed(text)
            own.append(None if text is None else left)
            count.append(len(passages))
            said.append(said_keys(left))
            quoted.append(
                [
                    {"level": level, "number": number, "length": length, "words": words, "key": key}
                    for number, (level, passage) in enumerate(passages)
                    for key, length, words in passage_keys(passage)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                *(rows.column(c) for c in ("message", "conv_id", "turn", "role")),
                pa.array(own, pa.string()),
                pa.array(count, pa.int32()),
                pa.array(quoted, pa.list_(_QUOTE)),
                pa.array(said, pa.list_(pa.binary())),
            ],
            names=["message", "conv_id", "turn", "role", "text", "n_quotes", "quoted", "said"],
        )


def parsed_messages(messages: DataFrame) -> DataFrame:
    """``message, conv_id, turn, role, text, n_quotes, quoted, said``: own text, quoted passages, and what can be quoted."""
    keyed = messages.select(
        F.xxhash64("conv_id", "turn", "role", "text").alias("message"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
    )
    schema = (
        f"message long, conv_id long, turn long, role {messages.schema['role'].dataType.simpleString()}, text string, n_quotes int, "
        "quoted array<struct<level:int,number:int,length:int,words:int,key:binary>>, said array<binary>"
    )
    return stored(keyed.mapInArrow(_parse, schema), "messages")


def passage_links(parsed_rows: DataFrame, far_words: int = FAR_WORDS) -> DataFrame:
    """All links of passages, and of their lines, to originals; a row per matching text.

    ``message, conv_id, turn, level, number, length, parent_conv, parent_turn``
    of ``parsed_messages``. The original is the first message of the same
    conversation that says it, if it is before the quoting one. Otherwise it is
    the first message of the other conversation of the smallest id, whether that
    is smaller than the own one or not, for texts of at least ``far_words``
    words: shorter ones are said everywhere and quote nobody.
    """
    placed = parsed_rows.where("conv_id is not null and turn is not null")
    quotes = placed.select("message", "conv_id", "turn", F.inline("quoted")).distinct()
    said = placed.select("conv_id", "turn", F.explode("said").alias("key"))
    # Only what is quoted at all can be an original.
    said = said.join(quotes.select("key").distinct(), "key", "left_semi")
    nearby = stored(said.groupBy("key", "conv_id").agg(F.min("turn").alias("near_turn")), "originals")
    place = F.struct("conv_id", "near_turn")
    first = nearby.groupBy("key").agg(F.min(place).alias("first"))
    # A conversation is not its own other one: there the second takes the place of the first.
    second = (
        nearby.join(first, "key").where("conv_id != first.conv_id").groupBy("key").agg(F.min(place).alias("second"))
    )
    anywhere = first.join(second, "key", "left")
    near = F.col("near_turn") < F.col("turn")
    other = F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("second"))
    far = F.when(F.col("words") >= far_words, other)
    return (
        quotes.join(nearby, ["key", "conv_id"], "left")
        .join(anywhere, "key", "left")
        .select(
            "message",
            "conv_id",
            "turn",
            "level",
            "number",
            "length",
            F.when(near, F.col("conv_id")).otherwise(far["conv_id"]).alias("parent_conv"),
            F.when(near, F.col("near_turn")).otherwise(far["near_turn"]).alias("parent_turn"),
        )
        .where("parent_conv is not null")
    )


def without_circles(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_conv, parent_turn`` without the parent of the first message of each circle.

    Each round doubles the stretch of ancestors whose first message is known. A
    message is the first of a circle if it is the first of its own ancestors.
    Messages that reach a root drop out; the rest is settled once a round
    changes nothing.
    """
    if parents.where("(parent_conv, parent_turn) >= (conv_id, turn)").isEmpty():
        return parents  # every link goes back, so nothing comes round
    walk = parents.select(
        F.struct("conv_id", "turn").alias("at"),
        F.struct(F.col("parent_conv").alias("conv_id"), F.col("parent_turn").alias("turn")).alias("to"),
    ).withColumn("low", F.col("to"))
    walk, left = stored(walk, "circles"), None
    while True:
        onward = walk.select(F.col("at").alias("to"), F.col("to").alias("next"), F.col("low").alias("more"))
        walk = stored(
            walk.join(onward, "to").select(
                "at", F.col("next").alias("to"), F.least("low", "more").alias("low"), (F.col("more") < F.col("low")).alias("changed")
            ),
            "circles",
        )
        rows, changed = walk.agg(F.count("*"), F.count_if("changed")).first()
        if not rows or (rows == left and not changed):
            break
        walk, left = walk.drop("changed"), rows
    cut = walk.where("low = at").select("at.conv_id", "at.turn")
    return stored(parents.join(cut, ["conv_id", "turn"], "left_anti"), "parents")


def link_quotes(messages: DataFrame, far_words: int = FAR_WORDS) -> DataFrame:
    """Messages without quotes, each with the message it answers and its place in the reply order.

    Takes ``conv_id, turn`` (integers), ``role, text``; other columns are
    ignored. Returns ``conv_id, turn, role, text, n_quotes, n_linked,
    parent_conv, parent_turn, root_conv, root_turn, depth``, a row per row.
    Ordered by ``root_conv, root_turn, depth, conv_id, turn`` they are the
    conversations: each message follows what it answers, and messages without
    quotes keep the order of their turns.

    Originals are those of ``passage_links``. A passage is matched as a whole or
    by one of its lines, the longest match counts; the parent is the original of
    the passage of the lowest level, then of the longest match, then of the first
    one. Where parents form a circle, which takes conversations that quote each
    other, its first message answers nothing. ``n_linked`` counts the passages
    that have an original, in a circle or not. Rows with a null ``conv_id`` or
    ``turn`` are neither original nor linked. Rows of equal ``conv_id`` and
    ``turn`` are one message of several texts. Null texts stay null.
    """
    rows = parsed_messages(messages)
    linked = stored(passage_links(rows, far_words), "quote-links")
    # Of equal lengths in one passage the earliest original counts.
    first = F.struct("level", -F.col("length"), "number", "parent_conv", "parent_turn")
    counted = linked.groupBy("message").agg(F.count_distinct("number").alias("n_linked"))
    parents = stored(
        linked.groupBy("conv_id", "turn").agg(
            F.min_by(F.struct("parent_conv", "parent_turn"), first).alias("parent")
        ).select("conv_id", "turn", "parent.*"),
        "parents",
    )
    parents = without_circles(parents)
    # Follow parents to the roots: each round doubles the distance covered.
    roots = parents.select(
        "conv_id", "turn", F.col("parent_conv").alias("root_conv"), F.col("parent_turn").alias("root_turn"),
        F.lit(1).cast("long").alias("depth"),
    )
    while True:
        onward = roots.select(
            F.col("conv_id").alias("root_conv"), F.col("turn").alias("root_turn"),
            F.col("root_conv").alias("next_conv"), F.col("root_turn").alias("next_turn"), F.col("depth").alias("more"),
        )
        roots = stored(
            roots.join(onward, ["root_conv", "root_turn"], "left").select(
                "conv_id",
                "turn",
                F.coalesce("next_conv", "root_conv").alias("root_conv"),
                F.coalesce("next_turn", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("more").isNotNull().alias("moved"),
            ),
            "roots",
        )
        moved = not roots.where("moved").isEmpty()
        roots = roots.drop("moved")
        if not moved:
            break
    return (
        rows.join(counted, "message", "left")
        .join(parents.join(roots, ["conv_id", "turn"]), ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "text",
            "n_quotes",
            F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked"),
            "parent_conv",
            "parent_turn",
            F.coalesce("root_conv", "conv_id").alias("root_conv"),
            F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).cast("int").alias("depth"),
        )
    )


def quote_rows(messages: DataFrame) -> DataFrame:
    """``link_quotes`` with size and CRC-32 of the text in place of the text."""
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    linked = link_quotes(messages)
    return linked.select(
        *(c for c in linked.columns if c != "text"),
        F.length(bytes_).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
    )
