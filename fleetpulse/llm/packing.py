"""Bound-certified best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import stored, text_blocks
from fleetpulse.llm.sharding import best_fit_decreasing

CAPACITY = 4096
END_OF_TEXT = 1
#: Pieces that one packing task takes.
PIECES_PER_PART = 2048
#: A partition with a gap gives away so many of its emptiest bins for each bin above the bound ...
BINS_FOR_GAP = 8
#: ... that hold this share of its pieces at most.
SHARE_GIVEN = 0.25
#: Parts of texts whose ids a Python worker keeps.
CACHED_WORDS = 500_000
#: Bounds are taken over so many values of a dual-feasible function's parameter at most.
BOUND_STEPS = 128

PIECE_SCHEMA = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)

# White space of the tokenizer; Python's also has the separators from 1C to 1F.
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
# In texts of these characters alone the tokenizer's normal form is their lower case.
_OTHER = re.compile(r"[^\t-\r\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<\|")
# How the tokenizer parts such a text; fixed by its vocabulary file.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class WordTokenizer:
    """Ids of a text, part by part: the tokenizer drops white space and never joins across it.

    A text of ASCII and Latin letters is parted as the tokenizer does it, any
    other at white space only. Ids of parts seen lately are kept as bytes, so
    that a text costs one lookup per part.
    """

    _open: dict[str, WordTokenizer] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        mark = self._encode("\x01")
        self.mark = mark[0] if len(mark) == 1 else None

    @classmethod
    def opened(cls, path: str) -> WordTokenizer:
        """One per Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, parts: list[str]) -> None:
        """Encode many parts in one text, kept apart by a character that none of them has."""
        plain = [p for p in parts if "\x01" not in p] if self.mark is not None else []
        for first in range(0, len(plain), 2000):
            some = plain[first : first + 2000]
            ids = self._encode(" \x01 ".join(some))
            ends = [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            start = 0
            for part, end in zip(some, ends, strict=True):
                self.known[part] = ids[start:end].tobytes()
                start = end + 1
        for part in parts:
            if part not in self.known:
                self.known[part] = self._encode(part).tobytes()

    def ids(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit values."""
        parts = _SPACE.split(text) if _OTHER.search(text) else _PARTS.findall(text.lower())
        known = self.known
        missing = [p for p in set(parts) if p not in known]
        if missing:
            if len(known) + len(missing) > CACHED_WORDS:
                known.clear()
                missing = list(set(parts))
            self._learn(missing)
        return b"".join([known[p] for p in parts])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END_OF_TEXT) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of ``capacity`` if there are more.

    Returns ``doc_id, piece, start, length, ids_crc32``. A null text has the end id only.
    """
    last = int(end).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.opened(tokenizer_path)
        for rows, texts in text_blocks(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts):
                ids = (tokenizer.ids(text) if text else b"") + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", *PIECE_SCHEMA.names],
            )

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *PIECE_SCHEMA])
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def least_bins(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Lower bound on the bins for ``counts`` items of each of ``lengths``.

    The largest of the bounds by dual-feasible functions: the identity, the
    rounding functions u(k), the functions that drop items below a parameter
    and count those too large to stand beside such an item as whole bins, and
    the functions that count how many items of the parameter's length fit.
    """
    if not len(lengths):
        return 0
    x, n = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    best = -(-int((x * n).sum()) // capacity)
    for k in range(1, 31):
        whole = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    small = np.unique(x[x <= capacity // 2])
    if len(small) > BOUND_STEPS:
        small = small[np.linspace(0, len(small) - 1, BOUND_STEPS).astype(int)]
    for e in small.tolist():
        value = np.where(x > capacity - e, capacity, np.where(x < e, 0, x))
        best = max(best, -(-int((value * n).sum()) // capacity))
        fit = capacity // e
        value = np.where(2 * x > capacity, fit - (capacity - x) // e, np.where(x >= e, 1, 0))
        best = max(best, -(-int((value * n).sum()) // fit))
    return best


def packed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bin of each item, the items in falling order of length, and the number of bins."""
    sizes, counts = np.unique(lengths, return_counts=True)
    plan = best_fit_decreasing(list(zip(sizes.tolist(), counts.tolist())), capacity)
    runs = [run for size in sizes[::-1].tolist() for run in plan.runs[size]]
    return np.repeat([b for b, _ in runs], [n for _, n in runs]).astype(np.int64), plan.bins


def given_away(filled: np.ndarray, pieces: np.ndarray, gap: int, capacity: int) -> np.ndarray:
    """Which bins a partition gives to the next round, from their tokens and pieces.

    The emptiest bin if it is not full; with a gap the emptiest ones,
    ``BINS_FOR_GAP`` for each bin above the lower bound, as long as they hold
    ``SHARE_GIVEN`` of all pieces at most.
    """
    give = np.zeros(len(filled), bool)
    order = np.argsort(filled, kind="stable")
    order = order[filled[order] < capacity][: max(1, BINS_FOR_GAP * gap)]
    held = np.cumsum(pieces[order])
    give[order[(held <= SHARE_GIVEN * pieces.sum()) | (np.arange(len(order)) == 0)]] = True
    return give


def pack_part(rows: pd.DataFrame, capacity: int, last: bool) -> pd.DataFrame:
    """Pack one partition; ``__open`` marks what it gives to the next round (``given_away``).

    A partition whose bins equal the lower bound is certified and has no gap. If
    the new packing needs more bins than the rows came in, they stay as they came.
    """
    rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
    lengths = rows["length"].to_numpy()
    bins, n = packed(lengths, capacity)
    former = rows["sequence_id"].to_numpy()
    if (former >= 0).all() and len(np.unique(former)) < n:
        bins = np.unique(former, return_inverse=True)[1]
        n = int(bins.max()) + 1
    filled = np.bincount(bins, lengths, n).astype(np.int64)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    offset = np.empty(len(rows), np.int64)
    offset[order] = ends - lengths[order] - (np.cumsum(filled) - filled)[bins[order]]
    give = np.zeros(n, bool)
    if not last:
        gap = n - least_bins(*np.unique(lengths, return_counts=True), capacity)
        give = given_away(filled, np.bincount(bins, minlength=n), gap, capacity)
    return rows.assign(__bin=bins, offset=offset, __open=give[bins])


def _packer(capacity: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_part(rows, capacity, last)

    return one


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, pieces_per_part: int = PIECES_PER_PART
) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as can be found.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns a row per
    piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    Every row is a document, also with a null or repeated id; a null or empty
    text is one piece that holds the end id. An empty table gives no rows.

    See ``pack_pieces`` for how it is done.
    """
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity), capacity, pieces_per_part)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_part: int = PIECES_PER_PART) -> DataFrame:
    """Pack pieces of at most ``capacity`` tokens.

    Each round packs partitions of about ``pieces_per_part`` pieces on their own.
    The bins they give away (``given_away``), a part of each, are dealt whole to
    partitions of the same size and packed again, until one partition is left.
    So no task holds more than about one partition, however far from the bound
    best fit stays; only a bin of more than a quarter of ``pieces_per_part``
    pieces, all very short, lets a partition grow, to twice its size at most.
    """
    rows = stored(
        pieces.select("doc_id", *PIECE_SCHEMA.names).withColumn("__row", F.monotonically_increasing_id()), "pieces"
    )
    parts = max(1, round(rows.count() / pieces_per_part))
    # Dealt by row, so repeated documents are spread too.
    rows = rows.select(
        "doc_id",
        *PIECE_SCHEMA.names,
        F.pmod(F.xxhash64("__row"), F.lit(parts)).alias("__part"),
        F.lit(-1).cast("long").alias("sequence_id"),
    )
    schema = T.StructType(
        [
            *rows.schema,
            T.StructField("__bin", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("__open", T.BooleanType()),
        ]
    )
    done, turn = [], 0
    while True:
        last = parts == 1
        # A sequence is named by its round, partition and bin there.
        name = F.shiftleft(F.lit(turn).cast("long"), 56) + F.shiftleft(F.col("__part"), 20) + F.col("__bin")
        turned = (
            rows.groupBy("__part")
            .applyInPandas(_packer(capacity, last), schema)
            .select("doc_id", *PIECE_SCHEMA.names, name.alias("sequence_id"), "offset", "__part", "__open")
        )
        turned = stored(turned, "packed")
        done.append(turned.where("not __open"))
        if last:
            break
        released = turned.where("__open")
        parts, turn = max(1, min(-(-released.count() // pieces_per_part), parts // 2)), turn + 1
        rows = released.select(
            "doc_id",
            *PIECE_SCHEMA.names,
            F.pmod(F.xxhash64("sequence_id"), F.lit(parts)).alias("__part"),
            "sequence_id",
        )
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole.select("doc_id", *PIECE_SCHEMA.names, "sequence_id", "offset")
