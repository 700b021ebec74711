"""Benchmark decontamination: an FM-index of each shard of documents, searched for test phrases."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import text_blocks

#: Words of a test phrase; an item of fewer words is one phrase.
WINDOW = 10
#: Text of one shard, in bytes; a longer document is a shard of its own.
SHARD_BYTES = 8_000_000
#: Every so manieth text position keeps its place; others are walked back to one.
SAMPLE_STEP = 16
#: Words of test items searched for in one pass over the documents; more items take more passes.
ITEM_WORDS = 2_000_000

# ASCII letters and digits and everything beyond ASCII make words; capitals are lowered in ASCII only.
_LOWER = bytes(
    c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


class WaveletMatrix:
    """Symbols by their bits, highest first, with rank counts on packed bits."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for b in reversed(range(bits)):
            ones = (symbols >> b) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.levels.append((words, before, int(len(ones) - before[-1])))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        every = np.arange(1 << bits)
        self.begin = self._descend(every, np.zeros(len(every), np.int64))

    @staticmethod
    def _ones(level: tuple, i: np.ndarray) -> np.ndarray:
        words, before, _ = level
        at = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & below)

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, level in zip(reversed(range(self.bits)), self.levels):
            ones = self._ones(level, i)
            i = np.where((symbol >> b) & 1 == 1, level[2] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position i."""
        return self._descend(symbol, i) - self.begin[symbol]

    def at(self, i: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        symbol = np.zeros(len(i), np.int64)
        for level in self.levels:
            ones = self._ones(level, i)
            bit = self._ones(level, i + 1) - ones
            symbol = 2 * symbol + bit
            i = np.where(bit == 1, level[2] + ones, i - ones)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sort all suffixes by doubling. Every 0 is a terminator of its own, in order of position; the text ends with one."""
    zero = text == 0
    n, zeros = len(text), int(zero.sum())
    rank = np.where(zero, np.cumsum(zero) - 1, text.astype(np.int64) + zeros)
    reach = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - reach] = rank[reach:]
        key = rank * (int(rank.max()) + 1 if reach == 1 else n) + np.where(rank < zeros, 0, after)
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        fresh = np.concatenate(([0], np.cumsum(sorted_[1:] != sorted_[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        reach *= 2


class FMIndex:
    """Counts and places of phrases in a text of symbols from 1; 0 parts the text and is in no phrase."""

    def __init__(self, text: np.ndarray, symbols: int, step: int = SAMPLE_STEP) -> None:
        order = suffix_array(text)
        last = text[order - 1].astype(np.int64)
        self.size = len(text)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        self.tree = WaveletMatrix(last, max(1, int(symbols).bit_length()))
        # Beginnings of parts are kept too: no walk passes a terminator.
        kept = (order % step == 0) | (last == 0)
        self.kept, self.kept_before, self.places = kept, np.cumsum(kept) - kept, order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that begin with each phrase, found from its end."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for j in reversed(range(phrases.shape[1])):
            symbol = phrases[live, j].astype(np.int64)
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to the next kept position."""
        place, rows = np.empty(len(rows), np.int64), rows.copy()
        open_, walked = np.arange(len(rows)), 0
        while len(open_):
            at = rows[open_]
            found = self.kept[at]
            place[open_[found]] = self.places[self.kept_before[at[found]]] + walked
            open_, at = open_[~found], at[~found]
            symbol = self.tree.at(at)
            rows[open_] = self.before[symbol] + self.tree.rank(symbol, at)
            walked += 1
        return place


@dataclass
class Phrases:
    """Distinct test phrases by length, with the items that hold them."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = field(default_factory=dict)
    shortest: int = 0

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + window]), set()).add(item)
        by_length = {}
        for n in sorted({len(p) for p in found}):
            some = [(p, sorted(found[p])) for p in found if len(p) == n]
            by_length[n] = (np.array([p for p, _ in some], np.int32), [i for _, i in some])
        return cls(vocabulary, by_length, min(by_length, default=0))


def shard_hits(texts: list[bytes | None], phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """For each text of a shard: number of words, merged spans of words inside phrases, and items found.

    The index covers the runs of words that the test items use at all; a run
    shorter than the shortest phrase holds none and is left out.
    """
    get = phrases.vocabulary.get
    n_words, parts = [], []
    for text in texts:
        words = words_of(text)
        n_words.append(len(words))
        parts.append(np.array([get(w, 0) for w in words] + [0], np.int32))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if not parts or not phrases.by_length:
        return n_words, spans, items
    ids = np.concatenate(parts)
    first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    used = np.concatenate(([0], (ids > 0).astype(np.int8), [0]))
    starts, ends = np.flatnonzero(np.diff(used) == 1), np.flatnonzero(np.diff(used) == -1)
    long = ends - starts >= phrases.shortest
    if not long.any():
        return n_words, spans, items
    mark = np.zeros(len(ids) + 1, np.int32)
    mark[starts[long]] += 1
    mark[ends[long] + 1] -= 1  # with the terminator after the run
    at = np.flatnonzero(np.cumsum(mark[:-1]))
    index = FMIndex(ids[at], len(phrases.vocabulary))
    for length, (rows, holders) in phrases.by_length.items():
        low, high = index.search(rows)
        hit = np.flatnonzero(low < high)
        if not len(hit):
            continue
        counts = high[hit] - low[hit]
        phrase = np.repeat(hit, counts)
        row = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[hit], counts)
        place = at[index.locate(row)]
        doc = np.searchsorted(first, place, side="right") - 1
        for d, start, p in zip(doc.tolist(), (place - first[doc]).tolist(), phrase.tolist()):
            spans[d].append((start, start + length))
            items[d].update(holders[p])
    return n_words, [merged(s) for s in spans], items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, in order; touching ones become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    words = list(_WORD.finditer(text))
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : words[start].start()])
        at = words[end - 1].end()
    return b"".join([*kept, text[at:]])


_SPAN = "array<struct<start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _searched(phrases: Phrases, with_text: bool, last: bool) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "__bytes", SHARD_BYTES):
            n_words, spans, items = shard_hits(texts, phrases)
            for i, (old, known) in enumerate(zip(rows.column("hit_spans").to_pylist(), rows.column("hit_items").to_pylist())):
                if old:
                    spans[i] = merged(spans[i] + [(s["start"], s["end"]) for s in old])
                items[i].update(known or ())
            done = {
                "n_words": pa.array(n_words, pa.int64()),
                "hit_spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPAN_TYPE),
                "hit_items": pa.array([sorted(i) for i in items], pa.list_(pa.string())),
            }
            if with_text and last:
                left = [t if not s else without_spans(t, s) for t, s in zip(texts, spans)]
                done["clean_text"] = pa.array([None if t is None else t.decode() for t in left], pa.string())
            if last:
                done["__bytes"] = pa.nulls(len(texts), pa.binary())
            columns = [done.get(name, None) for name in rows.schema.names]
            columns = [c if c is not None else rows.column(i) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    return search


def find_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``hit_spans`` and ``hit_items``, and ``clean_text`` if asked for.

    A phrase is any ``window`` consecutive words of a benchmark ``text``, or all
    of them if there are fewer. ``hit_spans`` are the merged ranges of document
    words inside phrases, ``hit_items`` the ids of the items found, as sorted
    text; ``clean_text`` is the text without the spans. Null texts have no
    words; items with a null id or no words take no part. Rows with equal ids
    are documents, or items, of their own. The test items are searched in
    passes of ``ITEM_WORDS`` words, so that what each task holds of them is
    bounded; a single pass is usual.
    """
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")
    )
    bytes_ = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-bytes_ // (2 * ITEM_WORDS)))  # a word has two bytes or more, with what parts it from the next
    names = ("n_words", "hit_spans", "hit_items", "clean_text", "__bytes")
    df = docs.drop(*names).withColumns(
        {
            "n_words": F.lit(None).cast("long"),
            "hit_spans": F.lit(None).cast(_SPAN),
            "hit_items": F.lit(None).cast("array<string>"),
            "__bytes": F.col("text").cast("binary"),
        }
        | ({"clean_text": F.lit(None).cast("string")} if with_text else {})
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    for k in range(passes):
        some = items.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).collect()
        phrases = Phrases.of([(r[0], bytes(r[1])) for r in some], window)
        df = df.mapInArrow(_searched(phrases, with_text, k == passes - 1), schema)
    return df.drop("__bytes")


def remove_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, benchmark phrases cut out of ``text``, ``n_chars`` following where there is one.

    Every row stays, unchanged if nothing was found in it.
    """
    found = find_phrases(docs, benchmark, window, with_text=True)
    hit = F.size("hit_spans") > 0
    changes = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changes["n_chars"] = F.when(hit, F.length("clean_text").cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns(changes).select(*docs.columns)


def contamination_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    found = find_phrases(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
