"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.session import scratch_folder

#: A block of texts is worked on at once up to this many characters.
BLOCK_CHARS = 1_000_000


def workers_find_package(spark: SparkSession) -> None:
    """Python workers of the session find this package where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    workers_find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends here."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column | str, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % divisor


def utf8(text: Column | str) -> Column:
    """The bytes of a text; none for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = BLOCK_CHARS) -> Iterator[tuple]:
    """(record batch slice, list of values) with at most ``most`` characters, or one row."""
    for batch in batches:
        values = batch.column(column).to_pylist()
        first = size = 0
        for i, value in enumerate(values):
            length = len(value) if value is not None else 0
            if size and size + length > most:
                yield batch.slice(first, i - first), values[first:i]
                first, size = i, 0
            size += length
        if first < len(values):
            yield batch.slice(first), values[first:]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an uint64 array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Odd multiplier of the polynomial hashes modulo 2**64, and its inverse.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, kept for the next block."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_CHARS + 1)
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if size == BLOCK_CHARS + 1:
            _powers[base] = have
    return have[:n]


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``codes[start:end]``, equal for equal runs."""
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(codes)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INVERSE, len(codes) + 1)[starts])


_SPACE_CODES = np.array([chr(c).isspace() for c in range(0x3001)])


def is_space(codes: np.ndarray) -> np.ndarray:
    """White space among code points."""
    return _SPACE_CODES[np.minimum(codes, 0x3000)] & (codes <= 0x3000)


class CodeBlock:
    """Texts as one array of code points; each text stands between spaces.

    ``first[i]`` is where text i begins, ``starts`` and ``ends`` are its words
    (runs without white space), ``words[i]`` the number of the first word of
    text i; both lists of positions have one more entry for the end.
    """

    def __init__(self, texts: list[str | None]) -> None:
        # Spaces enough for an n-gram to begin at the last character.
        joined = " " + " ".join(t or "" for t in texts) + " " * 8
        self.codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t or "") + 1 for t in texts], np.int64)
        self.first = 1 + np.concatenate(([0], np.cumsum(lengths)))
        self.space = is_space(self.codes)
        step = np.diff(self.space.astype(np.int8))
        self.starts = np.flatnonzero(step == -1) + 1
        self.ends = np.flatnonzero(step == 1) + 1
        self.words = np.searchsorted(self.starts, self.first)


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each i, in double precision."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def labelled_sample(docs: DataFrame, labels: DataFrame, value: str, rows: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` labelled documents, chosen by a hash of the id.

    ``labels`` has ``doc_id`` and ``value``; rows with nulls take no part, and
    repeated ones count once. Only the chosen ids, bounded by ``rows``, are
    broadcast. A repeated id gives one of its texts, so that the bound holds.
    """
    chosen = (
        labels.select("doc_id", F.col(value).alias("label"))
        .where("doc_id is not null and label is not null")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").where("text is not null")
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")


def bounded_sample(docs: DataFrame, labels: DataFrame, value: str, rows: int) -> list[tuple]:
    """The labelled sample as (text, label) on the driver, in a fixed order."""
    found = labelled_sample(docs, labels, value, rows).collect()
    return [(r[1], r[2]) for r in sorted(found, key=lambda r: (hash_order(r[0]), str(r[0]), r[1], str(r[2])))]


def hash_order(value: object) -> int:
    """A fixed order of ids without meaning."""
    import zlib

    return zlib.crc32(str(value).encode())
