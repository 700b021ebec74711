"""Alignment of two tokenizers on the same texts, worked on as Arrow tables."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import BLOCK_CHARS, stored, text_blocks

#: Segments of texts whose ids a Python worker keeps, and the longest that it keeps.
CACHED_SEGMENTS, CACHED_CHARS = 500_000, 64
#: Pairs that a worker counts before it hands its partial counts on.
COUNTED_PAIRS = 1_000_000

# Fixed value: how the byte-level tokenizer parts a text.
BYTE_LEVEL_PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Both tokenizers part a text before a space or line feed that follows something visible.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_BLANKS = re.compile(r"\s[ \n]")
_CUT_AT = re.compile(r"(?<=\S)[ \n]")
_MARK = "▁"


def byte_level_bytes(path: str) -> dict[int, bytes]:
    """The bytes of every ordinary id of a byte-level vocabulary file.

    The vocabulary writes a byte that is no visible Latin-1 character as the next
    free character from 256 on.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", ())}
    vocabulary = spec["model"]["vocab"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
    ids = [vocabulary[m] for m in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError("ids have to be in the order of the merges")
    return {i: bytes(byte_of[c] for c in word) for word, i in vocabulary.items() if word not in special}


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a piece vocabulary; ``<0xHH>`` is a byte, the mark is a space."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    found = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_MARK, " ").encode())
    return found


def most_pairs(byte_path: str, piece_path: str) -> int:
    """How many pairs of ids can end together at most, by the vocabularies alone.

    Of two byte ranges that end together the shorter is a suffix of the longer,
    so a token of n bytes meets at most n byte strings; a byte string has two ids
    at most in the piece vocabulary (a character, and a single byte).
    """
    return 2 * sum(map(len, byte_level_bytes(byte_path).values())) + sum(map(len, piece_bytes(piece_path)))


class TwoTokenizers:
    """Ids of both tokenizers, segment by segment.

    A segment begins with a space or a line feed after something visible. No
    piece of either vocabulary has one of these behind another character, and
    the byte-level parts never span such a place, so the ids of a text are those
    of its segments. Segments are numbered; ``a_ids`` and ``b_ids`` list the ids
    of each number, or None where a tokenizer does not give the bytes back.
    """

    _open: dict[tuple[str, str], TwoTokenizers] = {}

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        a_bytes = byte_level_bytes(byte_path)
        ranks = {b: i for i, b in a_bytes.items()}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PARTS, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=piece_path)
        if not all(bytes([c]) in ranks for c in range(256)):
            raise ValueError("every byte has to be a token")
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.b_bytes = piece_bytes(piece_path)
        self.a_length, self.b_length = (pa.array([len(b) for b in t], pa.int64()) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (pa.array([str(i) for i in range(len(t))]) for t in (self.a_bytes, self.b_bytes))
        # With these in the middle of a piece, or a line feed in any, segments would not be independent.
        plain = [self.b.id_to_piece(i) for i in range(len(self.b_bytes)) if not self.b.is_byte(i)]
        self.lines = not any("\n" in p for p in plain)
        self.spaces = not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in plain)
        self.space_id = self.b.piece_to_id(_MARK)
        self._clear()

    @classmethod
    def opened(cls, byte_path: str, piece_path: str) -> TwoTokenizers:
        """One per Python worker."""
        key = (byte_path, piece_path)
        if key not in cls._open:
            cls._open[key] = cls(*key)
        return cls._open[key]

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.a_ids: list[list[int] | None] = []
        self.b_ids: list[list[int] | None] = []

    def _learn(self, segments: list[str]) -> None:
        # The piece tokenizer puts its mark, a space, in front; a line feed is never joined to it.
        pieces = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        b_bytes, first = self.b_bytes, len(self.a_ids)
        for s, b in zip(segments, pieces):
            if s[0] != " ":
                b = b[1:]
            elif s == " ":
                b = [self.space_id]
            if b"".join([b_bytes[i] for i in b]) == s.encode():
                # Byte-level ids always give the bytes back.
                self.a_ids.append(self.a.encode_ordinary(s))
                self.b_ids.append(b)
            else:
                self.a_ids.append(None)
                self.b_ids.append(None)
        self.known.update(zip(segments, range(first, len(self.a_ids))))

    def codes(self, units: list[str]) -> list[list[int]]:
        """The numbers of each unit's segments; units begin with a space or line feed, as segments do."""
        if len(self.known) > CACHED_SEGMENTS or len(self.a_ids) > 2 * CACHED_SEGMENTS:
            self._clear()
        parted = [self._segments(u) for u in units]
        missing = {s for segments in parted for s in segments if s not in self.known}
        self._learn(sorted(missing))
        codes = [[self.known[s] for s in segments] for segments in parted]
        for s in missing:
            if len(s) > CACHED_CHARS:
                del self.known[s]
        return codes

    def _segments(self, unit: str) -> list[str]:
        if not (self.lines and self.spaces):
            return [unit]
        if _BLANKS.search(unit):
            return _CUT.split(unit)
        # No two blanks in a row: the same, only faster.
        parts = unit.replace("\n", " \n").split(" ")[1:]
        return [s if s[:1] == "\n" else " " + s for s in parts]


def windows(text: str, most: int = BLOCK_CHARS) -> Iterator[str]:
    """A space and the text, cut where segments begin into windows of about ``most`` characters."""
    text, at = " " + text, 0
    while len(text) - at > most:
        cut = _CUT_AT.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _lists(values: pa.Array, group: np.ndarray, groups: int) -> pa.ListArray:
    """Values by group, groups ascending."""
    offsets = np.searchsorted(group, np.arange(groups + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _side(ids: list[list[int]], codes: np.ndarray, unit_of_segment: pa.Array, length: pa.Array, at: str) -> pa.Table:
    """``id, unit, key`` of all tokens of one tokenizer; ``key`` is the unit and the byte where the token ends."""
    distinct, inverse = np.unique(codes, return_inverse=True)
    listed = pa.array([ids[c] for c in distinct.tolist()], pa.list_(pa.int32())).take(pa.array(inverse))
    flat = pc.list_flatten(listed)
    unit = unit_of_segment.take(pc.list_parent_indices(listed))
    # Sums run on over units; what came before a unit is taken off.
    run = pc.cumulative_sum(length.take(flat)).to_numpy()
    units = unit.to_numpy()
    before = np.concatenate(([0], run))[np.searchsorted(units, units)]
    key = (units.astype(np.int64) << 40) + (run - before)
    return pa.table({f"{at}_id": flat, f"{at}_unit": unit, "key": key})


class AlignedUnits:
    """The alignment of some units: per unit its counts, groups as text, and linked pairs with how often."""

    def __init__(self, tokenizers: TwoTokenizers, units: list[str]) -> None:
        codes = tokenizers.codes(units)
        self.valid = [all(tokenizers.a_ids[c] is not None for c in unit) for unit in codes]
        codes = [unit if valid else [] for unit, valid in zip(codes, self.valid)]
        flat = np.array([c for unit in codes for c in unit], np.int64)
        n = len(units)
        unit_of_segment = pa.array(np.repeat(np.arange(n), [len(unit) for unit in codes]), pa.int64())
        a = _side(tokenizers.a_ids, flat, unit_of_segment, tokenizers.a_length, "a")
        b = _side(tokenizers.b_ids, flat, unit_of_segment, tokenizers.b_length, "b")
        links = a.join(b, keys="key", join_type="inner", use_threads=False).sort_by("key")
        keys = links["key"].to_numpy()
        ends = keys[np.flatnonzero(np.diff(keys, prepend=-1))]
        self.n_a, self.n_b = (
            np.bincount(t[c].to_numpy(), minlength=n) for t, c in ((a, "a_unit"), (b, "b_unit"))
        )
        link_unit = links["a_unit"].to_numpy()
        self.n_links = np.bincount(link_unit, minlength=n)
        end_unit = ends >> 40
        self.n_groups = np.bincount(end_unit, minlength=n)

        def grouped(table: pa.Table, text: pa.Array, at: str) -> pa.Array:
            # A token belongs to the first common end that is not before its own.
            group = np.searchsorted(ends, table["key"].to_numpy())
            written = text.take(table[f"{at}_id"].combine_chunks())
            return pc.binary_join(_lists(written, group, len(ends)), ",")

        both = pc.binary_join_element_wise(
            grouped(a, tokenizers.a_text, "a"), grouped(b, tokenizers.b_text, "b"), "|"
        )
        self.groups = pc.binary_join(_lists(both, end_unit, n), ";").to_pylist()

        stride = len(tokenizers.b_bytes)
        pair = links["a_id"].to_numpy().astype(np.int64) * stride + links["b_id"].to_numpy()
        counted = pa.table({"unit": link_unit, "pair": pair}).group_by(["unit", "pair"], use_threads=False)
        counted = counted.aggregate([([], "count_all")]).sort_by([("unit", "ascending"), ("pair", "ascending")])
        self._pairs, self._times = counted["pair"].to_numpy(), counted["count_all"].to_numpy()
        self._bounds = np.searchsorted(counted["unit"].to_numpy(), np.arange(n + 1))

    def pairs(self, unit: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self._bounds[unit], self._bounds[unit + 1])
        return self._pairs[part], self._times[part]


class _Document:
    """What is known of one document, unit after unit."""

    def __init__(self) -> None:
        self.counts = np.zeros(4, np.int64)
        self.digest = hashlib.sha256()
        self.valid, self.groups, self.pairs, self.times = True, [], [], []

    def add(self, units: AlignedUnits, i: int, keep: bool) -> None:
        self.valid = self.valid and units.valid[i]
        if not self.valid:
            return
        groups = units.groups[i]
        self.digest.update(((";" if self.counts[0] else "") + groups).encode())
        if keep:
            self.groups.append(groups)
        self.counts += (units.n_a[i], units.n_b[i], units.n_groups[i], units.n_links[i])
        pairs, times = units.pairs(i)
        if self.pairs:
            pairs, inverse = np.unique(np.concatenate((self.pairs[0], pairs)), return_inverse=True)
            times = np.bincount(inverse, np.concatenate((self.times[0], times))).astype(np.int64)
        self.pairs, self.times = [pairs], [times]

    def row(self, keep: bool) -> tuple:
        if not self.valid or not self.counts[0]:
            return 0, 0, 0, 0, "", [], [], "" if keep else None
        return *self.counts.tolist(), self.digest.hexdigest(), self.pairs[0], self.times[0], ";".join(self.groups) if keep else None


_ALIGNED = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.LongType())),
        T.StructField("groups", T.StringType()),
    ]
)
_ARROW = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False) -> DataFrame:
    """``doc_id`` of every row of ``docs`` and how the tokens of its text align.

    Tokenizer A takes a space and the text, tokenizer B puts that space itself.
    Where tokens of both end, a group ends and the two tokens are linked. ``n_a,
    n_b, n_groups, n_links`` count; ``groups_sha256`` is the hash of the groups
    (``a1,a2|b1;a3|b2,b3``), which ``groups`` holds with ``keep_groups``;
    ``pairs`` are the distinct linked pairs, as A id times size of B's vocabulary
    plus B id, and ``times`` how often. A null or empty text, or one whose tokens
    do not give its bytes back, has no tokens: zeros, an empty hash, no pairs.
    A row per row of ``docs``; other columns are ignored.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = TwoTokenizers.opened(byte_path, piece_path)
        for rows, texts in text_blocks(batches):
            found = [_Document() for _ in texts]
            held, size = [], 0

            def settle() -> None:
                if held:
                    units = AlignedUnits(tokenizers, [u for _, u in held])
                    for i, (row, _) in enumerate(held):
                        found[row].add(units, i, keep_groups)
                    held.clear()

            for row, text in enumerate(texts):
                for unit in windows(text) if text else ():
                    held.append((row, unit))
                    size += len(unit)
                    if size >= BLOCK_CHARS:
                        settle()
                        size = 0
            settle()
            columns = zip(*(d.row(keep_groups) for d in found))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(c, kind) for c, kind in zip(columns, _ARROW))],
                names=["doc_id", *_ALIGNED.names],
            )

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *_ALIGNED])
    return docs.select("doc_id", "text").mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, links``: how many links of all documents hold a pair; counted in Arrow per task, merged by Spark."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.Table:
            table = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("links", "sum")])
            return table.rename_columns(["pair", "links"])

        for rows in batches:
            pairs, times = (pc.list_flatten(rows.column(c)) for c in ("pairs", "times"))
            held.append(pa.table({"pair": pairs, "links": times}))
            size += len(pairs)
            if size > COUNTED_PAIRS:
                held = [merged()]
                size = held[0].num_rows
                if 2 * size > COUNTED_PAIRS:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from merged().to_batches()

    partial = aligned.select("pairs", "times").mapInArrow(counted, "pair long, links long")
    return partial.groupBy("pair").agg(F.sum("links").alias("links"))


def alignment_rows(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    ``count_sum`` adds up, over a document's links, how many links of the whole
    corpus hold the same pair; ``n_best`` counts the links whose pair is held most
    among those of its B id. Counts of pairs are sent to all tasks: there are at
    most ``most_pairs`` of them, whatever the corpus.
    """
    spark = docs.sparkSession
    aligned = stored(align_tokens(docs, byte_path, piece_path).drop("groups"), "aligned")
    stride = len(piece_bytes(piece_path))
    counts = pair_counts(aligned).withColumn("b", F.col("pair") % stride)
    counts = counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))
    table = counts.select("pair", "links", "best").toArrow().sort_by("pair")
    if table.num_rows > most_pairs(byte_path, piece_path):
        raise ValueError("more pairs than the vocabularies allow")
    shared = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "links", "best")))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, links, best = shared.value
        for rows in batches:
            pairs, times = rows.column("pairs"), rows.column("times")
            at = np.searchsorted(pair, pc.list_flatten(pairs).to_numpy())
            row, times = pc.list_parent_indices(pairs).to_numpy(), pc.list_flatten(times).to_numpy()
            sums = np.zeros((2, rows.num_rows), np.int64)
            np.add.at(sums[0], row, np.where(best[at], times, 0))
            np.add.at(sums[1], row, times * links[at])
            yield pa.RecordBatch.from_arrays(
                [*rows.drop_columns(["pairs", "times"]).columns, pa.array(sums[0]), pa.array(sums[1])],
                names=[f.name for f in schema],
            )

    kept = [f for f in aligned.schema if f.name not in ("pairs", "times")]
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    weighed = aligned.mapInArrow(weigh, schema)
    return weighed.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
