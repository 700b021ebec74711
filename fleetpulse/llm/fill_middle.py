"""Fill-in-the-middle texts, cut through a learned rank index of their token boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Farthest that a boundary lies from its segment's line; a residual takes one signed byte.
ERROR = 100
#: Ranks of a segment at most.
SPAN = 4096
#: Bytes of text whose boundaries are found and fitted at once.
BLOCK_BYTES = 2_000_000

# Marks of the three parts, and the shares of untouched and of suffix-first texts in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20

_ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


class RankIndex:
    """Offset by rank of an ascending sequence: lines with a bounded error, and what each is off by.

    A segment is its first rank and offset and a rational slope, so a prediction
    is exact integer arithmetic; the stored residual corrects it. The sequence
    may be added piece by piece: what is kept is a byte for each entry and four
    numbers for each segment.
    """

    def __init__(self, error: int = ERROR, span: int = SPAN) -> None:
        if not 0 <= error <= 127:
            raise ValueError("a residual has to fit a signed byte")
        self.error, self.span, self.size = error, span, 0
        self._parts: list[tuple[np.ndarray, ...]] = []
        self._residuals: list[np.ndarray] = []

    def add(self, offsets: np.ndarray) -> None:
        """The next entries, none smaller than those before."""
        if not len(offsets):
            return
        first = np.arange(0, len(offsets), self.span)
        end = np.minimum(first + self.span, len(offsets))
        residual, settled = np.empty(len(offsets), np.int8), []
        while len(first):
            run, rise = np.maximum(end - 1 - first, 1), offsets[end - 1] - offsets[first]
            before = np.cumsum(end - first) - (end - first)
            segment = np.repeat(np.arange(len(first)), end - first)
            step = np.arange(len(segment)) - before[segment]
            at = first[segment] + step
            off = offsets[at] - offsets[first][segment] - step * rise[segment] // run[segment]
            fits = np.maximum.reduceat(np.abs(off), before) <= self.error
            kept = fits[segment]
            residual[at[kept]] = off[kept]
            settled.append((first[fits] + self.size, offsets[first[fits]], rise[fits], run[fits]))
            # Halves of what does not fit; two entries always do.
            first, end = first[~fits], end[~fits]
            middle = (first + end) // 2
            first, end = np.concatenate((first, middle)), np.concatenate((middle, end))
        self._parts.append(tuple(np.concatenate(c) for c in zip(*settled)))
        self._residuals.append(residual)
        self.size += len(offsets)

    def close(self) -> RankIndex:
        """After the last entries: ready to be asked."""
        columns = [np.concatenate(c) for c in zip(*self._parts)] if self._parts else [np.empty(0, np.int64)] * 4
        order = np.argsort(columns[0])
        self.first, self.start, self.rise, self.run = (c[order] for c in columns)
        self.residual = np.concatenate(self._residuals) if self._residuals else np.empty(0, np.int8)
        self._parts, self._residuals = [], []
        return self

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        """What the lines say: no farther than ``error`` from the entry."""
        segment = np.searchsorted(self.first, ranks, side="right") - 1
        return self.start[segment] + (ranks - self.first[segment]) * self.rise[segment] // self.run[segment]

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The entries of these ranks."""
        return self.predicted(ranks) + self.residual[ranks]


def _boundaries(data: np.ndarray, text_starts: np.ndarray, chars: int, after_letter: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Of UTF-8 bytes: offsets in characters where tokens begin, their byte positions, and characters so far.

    A token is a run of ASCII letters or one other character; ``text_starts``
    are byte positions where a text begins, ``after_letter`` tells of the byte
    before the first.
    """
    letter = ((data | 32) - np.uint8(97)) < 26
    joined = np.empty(len(data), bool)
    joined[0] = after_letter
    joined[1:] = letter[:-1]
    joined[text_starts] = False
    whole = (data & 0xC0) != 0x80
    begins = np.flatnonzero(whole & ~(joined & letter))
    count = np.cumsum(whole)
    return chars + count[begins] - 1, begins, chars + int(count[-1])


class _Block:
    """Boundaries of some texts, one after the other, by rank: the end of a text is a boundary of its own."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        """``bounds`` are the byte positions of the texts in ``data``, with the end."""
        index, chars, letter = RankIndex(), 0, False
        texts = len(bounds) - 1
        self.tokens = np.zeros(texts, np.int64)
        self.first_char = np.zeros(texts + 1, np.int64)
        if texts == 1:
            # A long text goes piece by piece; a piece may begin inside a character, which begins no token.
            for at in range(0, len(data), BLOCK_BYTES):
                piece = data[at : at + BLOCK_BYTES]
                offsets, _, chars = _boundaries(piece, np.array([0] if at == 0 else [], np.int64), chars, letter)
                letter = 97 <= piece[-1] | 32 <= 122
                index.add(offsets)
                self.tokens[0] += len(offsets)
            self.first_char[1] = chars
            index.add(np.array([chars]))
        elif len(data):
            starts = bounds[:-1][bounds[:-1] < len(data)]
            offsets, begins, chars = _boundaries(data, starts, 0, False)
            token_ends = np.searchsorted(begins, bounds)
            self.tokens = np.diff(token_ends)
            whole = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            self.first_char = whole[bounds]
            index.add(np.insert(offsets, token_ends[1:], self.first_char[1:]))
        else:
            index.add(np.zeros(texts, np.int64))
        self.index = index.close()
        self.first_rank = np.concatenate(([0], np.cumsum(self.tokens + 1)))[:-1]

    def cut(self, ranks: np.ndarray) -> np.ndarray:
        """Characters of each text before its boundary of this rank."""
        return self.index.offsets(self.first_rank + ranks) - self.first_char[:-1]


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and where each begins; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _drawn(id_: Column, seed: int) -> list[Column]:
    """Four numbers from the hash of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """All columns of ``docs`` and ``n, form, prefix_chars, middle_chars, output``.

    A text of n tokens (a run of ASCII letters, or one other character) is cut at
    two boundaries drawn by a hash of seed and ``doc_id``. ``output`` has the
    parts after their marks, prefix first (``psm``) or suffix first (``spm``), or
    is the text itself (``plain``): where it is empty, has a mark in it, or the
    draw says so. Null is an empty text; rows of one id are drawn alike, and a
    null id as an empty one. Columns of these names are replaced. Every row
    stays; an empty table gives none.
    """
    docs = docs.drop(*_ADDED, "__h1", "__h2")
    h1, h2, h3, h4 = _drawn(F.col("doc_id"), seed)
    counts = [T.StructField("n", T.LongType()), T.StructField("__low", T.LongType()), T.StructField("__high", T.LongType())]
    kept = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in _slices(rows):
                block = _Block(*_text_bytes(part.column("text")))
                drawn = [part.column(c).to_numpy() % (block.tokens + 1) for c in ("__h1", "__h2")]
                low, high = (block.cut(f(*drawn)) for f in (np.minimum, np.maximum))
                yield pa.RecordBatch.from_arrays(
                    [*part.select(kept).columns, *map(pa.array, (block.tokens, low, high))],
                    names=[*kept, *(f.name for f in counts)],
                )

    found = docs.withColumns({"__h1": h1, "__h2": h2}).mapInArrow(cut, T.StructType([*docs.schema, *counts]))
    text = F.coalesce("text", F.lit(""))
    plain = (text == "") | (h3 % 100 >= PLAIN_FROM)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(text, F.lit(mark))
    prefix, suffix = F.substring(text, F.lit(1), F.col("__low")), F.substring(text, F.col("__high") + 1, F.length(text))
    middle = F.substring(text, F.col("__low") + 1, F.col("__high") - F.col("__low"))
    form = F.when(plain, "plain").when(h4 % 100 < SUFFIX_FIRST_BELOW, "spm").otherwise("psm")
    found = found.withColumn("form", form)
    first = F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix)).otherwise(
        F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix)
    )
    cut_up = F.col("form") != "plain"
    return found.select(
        *kept,
        "n",
        "form",
        F.when(cut_up, F.col("__low")).alias("prefix_chars"),
        F.when(cut_up, F.col("__high") - F.col("__low")).alias("middle_chars"),
        F.when(cut_up, F.concat(first, F.lit(MIDDLE), middle)).otherwise(text).alias("output"),
    )


def _slices(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``BLOCK_BYTES`` of text, or one row."""
    sizes = rows.column("text").fill_null("").cast(pa.large_string())
    ends = np.frombuffer(sizes.buffers()[1], np.int64, len(sizes) + 1, sizes.offset * 8)
    first = 0
    while first < rows.num_rows:
        last = int(np.searchsorted(ends, ends[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), rows.num_rows)
        yield rows.slice(first, last - first)
        first = last


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output was made of: its marks occur once each, as texts with marks stay plain."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form

    def between(left: str, right: str) -> Column:
        at = F.locate(left, output) + len(left)
        return F.substring(output, at, F.locate(right, output) - at)

    middle = F.substring(output, F.locate(MIDDLE, output) + len(MIDDLE), F.length(output))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle_rows(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and hashes of output and restored text of every document."""
    made = fill_in_middle(docs.select("doc_id", "text"), seed)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored("output", "form").cast("binary"), 256).alias("restored_sha256"),
    )
