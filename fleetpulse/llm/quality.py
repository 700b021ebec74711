"""Quality classifier: averaged subword embeddings with a softmax on top."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import (
    CodeBlock,
    hash_order,
    id_remainder,
    labelled_sample,
    mix,
    sums_between,
    text_blocks,
    word_hashes,
)

#: Labelled documents that the classifier is fitted on, at most.
SAMPLE_ROWS = 4000
#: Rows of the embedding table; features are hashed to them.
BUCKET_BITS = 18
DIMENSIONS = 8
#: Lengths of character n-grams; a word has a mark at each end.
GRAMS = (3, 4, 5)
EPOCHS = 6
RATE = 1.0

_GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def features(block: CodeBlock, bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Kinds of features of a block: buckets, which of them count, and where each text begins.

    First the words, then pairs of neighbouring words, then the character
    n-grams within words and their end marks.
    """
    words = word_hashes(block.codes, block.starts, block.ends)
    yield _bucket(words, bits), np.ones(len(words), bool), block.words
    if len(words) > 1:
        # A word said twice is one feature for all words.
        pairs = np.where(words[:-1] == words[1:], _GRAM_BASE, mix(words[:-1] * _GRAM_BASE + words[1:]))
        within = np.ones(len(pairs), bool)
        within[block.words[1:-1][(block.words[1:-1] > 0) & (block.words[1:-1] <= len(pairs))] - 1] = False
        yield _bucket(pairs, bits), within, np.minimum(block.words, len(pairs))
    codes = np.where(block.space, np.uint64(1), block.codes.astype(np.uint64) + np.uint64(2))
    for n in GRAMS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        grams = np.full(size, n, np.uint64)
        for j in range(n):
            grams = grams * _GRAM_BASE + codes[j : j + size]
        inside = np.ones(size, bool)
        for j in range(1, n - 1):
            inside &= ~block.space[j : j + size]
        # The end mark of one text opens the next word; a gram belongs to the text of its second character.
        yield _bucket(grams * _GRAM_BASE, bits), inside, np.minimum(block.first - 1, size)


def document_features(text: str, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    all_ = [buckets[counted] for buckets, counted, _ in features(CodeBlock([text]), bits)]
    buckets, counts = np.unique(np.concatenate(all_), return_counts=True)
    return buckets.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


@dataclass
class QualityModel:
    """``weight[b]`` is what bucket b adds to the log-odds of label 1 when it is a text's only feature."""

    weight: np.ndarray
    bias: float
    bits: int = BUCKET_BITS

    def scores(self, texts: list[str | None]) -> np.ndarray:
        block = CodeBlock(texts)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, counted, bounds in features(block, self.bits):
            total += sums_between(np.where(counted, self.weight[buckets], np.float32(0)), bounds)
            count += sums_between(counted, bounds)
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def fit(
    texts: list[str],
    labels: list[int],
    bits: int = BUCKET_BITS,
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 1,
) -> QualityModel:
    """Stochastic gradient descent over documents, the rate falling to zero.

    A document is the mean of its features' vectors; the two outputs and their
    biases form a softmax. Only the difference of the outputs is kept in the
    result, folded into the embedding. Without rows every score is 0.5.
    """
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / dimensions, 1 / dimensions, (1 << bits, dimensions)).astype(np.float32)
    out, bias = np.zeros((2, dimensions), np.float32), np.zeros(2)
    if len(texts):
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        bias[:] = np.log([1 - share, share])
    rows = [document_features(text, bits) for text in texts]
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            buckets, shares = rows[i]
            vectors = table[buckets]
            hidden = shares @ vectors
            logits = out @ hidden + bias
            odds = np.exp(logits - logits.max())
            error = -odds / odds.sum()
            error[labels[i]] += 1
            error *= rate * (1 - step / steps)
            back = (error @ out).astype(np.float32)
            out += np.outer(error, hidden).astype(np.float32)
            bias += 0.1 * error
            # Every feature moves by the document's gradient, so that the mean does too.
            table[buckets] = vectors + back
            step += 1
    return QualityModel(table @ (out[1] - out[0]), float(bias[1] - bias[0]), bits)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on a bounded sample of the labelled documents that are not held out.

    The sample, of ``sample_rows`` labels, is fitted in one task; only the weights
    come to the driver.
    """
    usable = labels.where(id_remainder("doc_id", 4) != 2).where("quality in (0, 1)")
    sample = labelled_sample(docs, usable, "quality", sample_rows).withColumn("doc_id", F.col("doc_id").cast("string"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for rows in batches for row in zip(*(c.to_pylist() for c in rows.columns))]
        found.sort(key=lambda r: (hash_order(r[0]), r[0], r[1], r[2]))
        model = fit([r[1] for r in found], [int(r[2]) for r in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weight.astype(np.float32).tobytes()], pa.binary()), pa.array([model.bias], pa.float64())],
            names=["weight", "bias"],
        )

    row = sample.repartition(1).mapInArrow(fitted, "weight binary, bias double").first()
    if row is None:
        return fit([], [])
    return QualityModel(np.frombuffer(row["weight"], np.float32), row["bias"])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``: 0 to 1, higher for label 1.

    A null or empty text has no features and gets the score of the bias.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            scores = pa.array(model.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*rows.columns, scores], names=[*rows.schema.names, "quality_score"])

    docs = docs.drop("quality_score")
    return docs.mapInArrow(score, T.StructType([*docs.schema, T.StructField("quality_score", T.DoubleType())]))


def quality_rows(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, whatever its id or other columns.

    A row per row of ``docs``; a null id is not held out. Labels other than 0
    and 1, and labels of null ids, are not learned from.
    """
    model = train(docs, labels)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"),
    )
