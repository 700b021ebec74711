"""Removal of repeated runs of lines, found by content-defined chunks."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import stored, text_blocks

#: Lines that the rolling hash spans, and one in how many of its values ends a chunk.
ROLLING_LINES = 2
DIVISOR = 2
#: Lines of a chunk at least; a line of so many words is a passage and a chunk by itself.
LEAST_LINES = 2
PASSAGE_WORDS = 50

_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def chunks(text: bytes) -> list[tuple[int, int]]:
    """Line ranges ``(start, end)`` of all chunks that can be removed, in order.

    A hash rolls over the hashes of the last lines; where it meets the divisor,
    the chunk ends. So ends depend on the lines around them alone, and lines put
    in before a passage do not shift its chunks. A last run of one line, and the
    lines before a long one, are chunks only if they have enough lines.
    """
    lines = text.split(b"\n")
    leaving = pow(_BASE, ROLLING_LINES, 1 << 64)
    found, start, rolled = [], 0, 0
    hashes: list[int] = []
    for i, line in enumerate(lines):
        h = zlib.crc32(line)
        hashes.append(h)
        rolled = (rolled * _BASE + h) & _MASK
        if i >= ROLLING_LINES:
            rolled = (rolled - hashes[i - ROLLING_LINES] * leaving) & _MASK
        if len(line) > PASSAGE_WORDS and len(line.split()) >= PASSAGE_WORDS:
            if i - start >= LEAST_LINES:
                found.append((start, i))
            found.append((i, i + 1))
            start = i + 1
        elif i + 1 - start >= LEAST_LINES and (((rolled * _BASE) & _MASK) >> 32) % DIVISOR == 0:
            found.append((start, i + 1))
            start = i + 1
    if len(lines) - start >= LEAST_LINES:
        found.append((start, len(lines)))
    return found


def passages(lines: list[bytes]) -> list[tuple[int, int]]:
    """The shortest line ranges of ``PASSAGE_WORDS`` words from each line on, and up to each line, in order.

    They overlap and depend on their own lines alone, so those of a repeated run
    of lines of so many words are repeated with it, and cover it from its first
    line with words to its last, whatever stands around it. Lines without words
    begin and end none.
    """
    worded = [(i, n) for i, line in enumerate(lines) if (n := len(line.split()))]
    found: set[tuple[int, int]] = set()
    for step in (1, -1):
        run, first, words = worded[::step], 0, 0
        for at, n in run:
            words += n
            while words >= PASSAGE_WORDS:
                start, count = run[first]
                found.add((min(start, at), max(start, at) + 1))
                words -= count
                first += 1
    return sorted(found)


_CHUNKS = T.StructType(
    [
        T.StructField("sum", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("again", T.BooleanType()),
    ]
)


def _chunk_rows(base: DataFrame, whole: bool) -> DataFrame:
    """A row per chunk with its digest; ``again`` marks one that stood in the same text before.

    With ``whole``, passages are chunks too; one that overlaps its first place in
    the text is left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            row, start, end, digest, again = [], [], [], [], []
            for i, text in enumerate(texts):
                if not text:
                    continue
                lines, seen = text.split(b"\n"), {}
                ranges = sorted({*chunks(text), *passages(lines)}) if whole else chunks(text)
                for a, b in ranges:
                    chunk = b"\n".join(lines[a:b])
                    value = hashlib.blake2b(chunk, digest_size=16).digest()
                    before = seen.setdefault(value, (a, b))
                    if before[0] < a and b"\n".join(lines[slice(*before)]) != chunk:
                        continue
                    if before[0] < a < before[1]:
                        continue
                    row.append(i)
                    start.append(a)
                    end.append(b)
                    digest.append(value)
                    again.append(before[0] < a)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id").take(at),
                    rows.column("sum").take(at),
                    pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()),
                    pa.array(digest, pa.binary()),
                    pa.array(again, pa.bool_()),
                ],
                names=["id", *_CHUNKS.names],
            )

    schema = T.StructType([T.StructField("id", base.schema["id"].dataType), *_CHUNKS])
    return base.select("id", "sum", F.col("text").cast("binary").alias("text")).mapInArrow(cut, schema)


def repeated_ranges(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``id, sum, ranges``: the line ranges to remove from the document ``id`` whose text hashes to ``sum``.

    Chunks whose digest occurs in several documents are compared byte by byte,
    by grouping on the bytes themselves; a digest of different bytes removes nothing.
    """
    base = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("sum"))
    found = stored(_chunk_rows(base, whole), "chunks")
    first = found.where("not again")
    several = first.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    shared = stored(first.join(several, "digest").select("id", "sum", "start", "end", "digest"), "shared-chunks")

    wanted = shared.groupBy("id", "sum").agg(F.collect_list(F.struct("digest", "start", "end")).alias("parts"))
    texts = base.join(
        wanted.withColumnRenamed("id", "wanted"), (base["id"].eqNullSafe(F.col("wanted"))) & (base["sum"] == wanted["sum"])
    ).select("id", F.split("text", "\n").alias("lines"), F.explode("parts").alias("part"))
    compared = (
        texts.select(
            "id",
            F.col("part.digest").alias("digest"),
            F.array_join(F.slice("lines", F.col("part.start") + 1, F.col("part.end") - F.col("part.start")), "\n").alias("chunk"),
        )
        .groupBy("digest", "chunk")
        .agg(F.min("id").alias("keeper"))
        .groupBy("digest")
        .agg(F.count("*").alias("variants"), F.min("keeper").alias("keeper"))
        .where("variants = 1 and keeper is not null")
    )
    elsewhere = (
        shared.join(compared, "digest")
        .where(F.coalesce(F.col("id") != F.col("keeper"), F.lit(True)))
        .select("id", "sum", "start", "end")
    )
    here = found.where("again").select("id", "sum", "start", "end")
    return elsewhere.union(here).groupBy("id", "sum").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


def dedup_lines(docs: DataFrame, whole: bool = False) -> DataFrame:
    """All columns of ``docs``, ``text`` without repeated chunks, and ``n_lines``, ``removed_lines``.

    A chunk is at least ``LEAST_LINES`` lines, or one line of ``PASSAGE_WORDS``
    words. One that occurs in several documents stays in that of the smallest
    id, one that occurs again in its own document stays where it is first.
    With ``whole``, so are the overlapping ``passages``: of every run of lines of
    ``PASSAGE_WORDS`` words that another document has, no line with words is left.
    ``n_chars`` follows the text where there is such a column. Every row stays,
    be it with an empty text. Null and empty texts have no chunks; rows of one
    id are one document; rows of null ids lose what a document with an id has.
    """
    ranges = repeated_ranges(docs, whole).withColumnsRenamed({"id": "__id", "sum": "__sum"})
    named = docs.drop("n_lines", "removed_lines", "__text_sum", "__id", "__sum", "ranges").withColumn(
        "__text_sum", F.xxhash64("text")
    )
    joined = named.join(
        ranges, named["doc_id"].eqNullSafe(ranges["__id"]) & (named["__text_sum"] == ranges["__sum"]), "left"
    )
    left = F.filter(
        F.split("text", "\n"),
        lambda line, i: ~F.exists("ranges", lambda r: (i >= r["start"]) & (i < r["end"])),
    )
    text = F.when(F.col("ranges").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    removed = F.when(F.col("ranges").isNotNull(), F.size(F.split("text", "\n")) - F.size(left))
    changes = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))),
        "removed_lines": F.coalesce(removed, F.lit(0)),
        "text": text,
    }
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changes["n_chars"] = F.when(F.col("ranges").isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind))
    kept = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    return joined.withColumns(changes).select(*kept, "n_lines", "removed_lines")


def line_rows(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id, n_lines, removed_lines, size, text_crc32`` of every document, of its text after removal."""
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return dedup_lines(docs.select("doc_id", "text"), whole).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("removed_lines").cast("long").alias("removed_lines"),
        F.length(bytes_).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
    )
