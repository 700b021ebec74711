"""Language of words in code-switched text: a linear-chain conditional random field."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import CodeBlock, bounded_sample, id_remainder, text_blocks, word_hashes

#: Documents that the field is fitted on, at most.
SAMPLE_ROWS = 1200
#: Rows of the weight table; features are hashed to them.
BUCKET_BITS = 17
#: Lengths of character n-grams. A word has a mark at each end, so these are its affixes too.
GRAMS = (2, 3, 4)
EPOCHS = 4
RATE = 0.3
#: Documents of one training step, and characters of one scoring step.
BATCH_DOCS = 40
BLOCK_CHARS = 2_000_000
UNKNOWN = "und"

_GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_features(block: CodeBlock, bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Kinds of features: buckets, which of them count, and where each word begins.

    The word itself is the lexicon feature; n-grams with a mark are affixes.
    """
    shift = np.uint64(64 - bits)
    words = word_hashes(block.codes, block.starts, block.ends)
    yield (words >> shift).astype(np.int64), np.ones(len(words), bool), np.arange(len(words))
    codes = np.where(block.space, np.uint64(1), block.codes.astype(np.uint64) + np.uint64(2))
    for n in GRAMS:
        size = len(codes) - n + 1
        grams = np.full(size, n, np.uint64)
        for j in range(n):
            grams = grams * _GRAM_BASE + codes[j : j + size]
        counted = ~(block.space[:size] & block.space[1 : size + 1])
        for j in range(1, n - 1):
            counted &= ~block.space[j : j + size]
        yield ((grams * _GRAM_BASE) >> shift).astype(np.int64), counted, block.starts - 1


def forward_backward(
    emission: np.ndarray, bounds: np.ndarray, transition: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word, and the expected number of each transition.

    Chains ``bounds[i]:bounds[i + 1]`` run side by side, longest first, one word
    of each at a step; probabilities are scaled at every word.
    """
    n_labels = emission.shape[1]
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    first, lengths = bounds[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(longest), side="left").tolist()
    local = np.exp(emission - emission.max(axis=1, keepdims=True)) if len(emission) else emission
    step = np.exp(transition)
    ahead, marginals = np.empty_like(local), np.empty_like(local)
    pairs = np.zeros((n_labels, n_labels))
    state = np.full((len(first), n_labels), 1.0)
    for t in range(longest):
        n = running[t]
        at = first[:n] + t
        state = local[at] * (state[:n] @ step if t else 1.0)
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    behind = np.ones((len(first), n_labels))
    for t in reversed(range(longest)):
        n = running[t]
        at = first[:n] + t
        back = behind[:n]
        both = ahead[at] * back
        marginals[at] = both / both.sum(axis=1, keepdims=True)
        if t:
            here, before = local[at] * back, ahead[at - 1]
            toward = here @ step.T
            total = (before * toward).sum(axis=1, keepdims=True)
            pairs += step * (before.T @ (here / total))
            behind[:n] = toward / toward.sum(axis=1, keepdims=True)
    return marginals, pairs


@dataclass
class LanguageModel:
    """Weights of hashed word features and of transitions, for each language."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1 << BUCKET_BITS, 0), np.float32))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    bits: int = BUCKET_BITS

    def emission(self, block: CodeBlock) -> np.ndarray:
        total = np.zeros((len(block.starts), len(self.languages)))
        if len(block.starts):
            for buckets, counted, bounds in word_features(block, self.bits):
                total += np.add.reduceat(self.weights[buckets] * counted[:, None], bounds, axis=0)
        return total

    def marginals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each language for each word, and where each text's words begin."""
        block = CodeBlock([(t or "").lower() for t in texts])
        return forward_backward(self.emission(block), block.words, self.transition)[0], block.words

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language with the largest mean probability over a text's words, and that mean."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        marginals, bounds = self.marginals(texts)
        names, scores = [], []
        for text, at, end in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist()):
            if not text or not any(map(str.isalpha, text)):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            mean = marginals[at:end].mean(axis=0)
            best = int(mean.argmax())
            names.append(self.languages[best])
            scores.append(min(1.0, float(mean[best])))
        return names, scores

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """Runs of words (parted at white space) of one language: ``(start, end, language)``."""
        if not text or not self.languages:
            return []
        best = self.marginals([text])[0].argmax(axis=1)
        cuts = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(best)]
        return [(a, b, self.languages[best[a]]) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def fit(
    texts: list[str], languages: list[str], epochs: int = EPOCHS, rate: float = RATE, bits: int = BUCKET_BITS, seed: int = 1
) -> LanguageModel:
    """Maximise the likelihood of label sequences by adaptive gradient steps over batches of documents.

    Every word of a document is labelled with the document's language.
    """
    names = sorted(set(languages))
    k = len(names)
    model = LanguageModel(names, np.zeros((1 << bits, k), np.float32), np.zeros((k, k)), bits)
    if k < 2:
        return model
    number = {name: i for i, name in enumerate(names)}
    seen, seen_steps = np.full((1 << bits, k), 1e-8), np.full((k, k), 1e-8)
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        turn = random.permutation(len(texts))
        for begin in range(0, len(turn), BATCH_DOCS):
            some = turn[begin : begin + BATCH_DOCS]
            block = CodeBlock([texts[i].lower() for i in some])
            if not len(block.starts):
                continue
            label = np.repeat([number[languages[i]] for i in some], np.diff(block.words))
            marginals, pairs = forward_backward(model.emission(block), block.words, model.transition)
            error = -marginals
            error[np.arange(len(label)), label] += 1
            gradient = np.zeros((1 << bits, k))
            for buckets, counted, bounds in word_features(block, bits):
                word = np.repeat(np.arange(len(bounds)), np.diff(np.append(bounds, len(buckets))))
                kept = counted[bounds[0] :]
                used = buckets[bounds[0] :][kept]
                for j in range(k):
                    gradient[:, j] += np.bincount(used, error[word[kept], j], 1 << bits)
            gradient /= len(label)
            seen += gradient**2
            model.weights += (rate * gradient / np.sqrt(seen)).astype(np.float32)
            change = np.zeros((k, k))
            inner = np.ones(len(label), bool)
            inner[block.words[:-1][np.diff(block.words) > 0]] = False  # the first word of a document
            np.add.at(change, (label[np.flatnonzero(inner) - 1], label[inner]), 1)
            change = (change - pairs) / len(label) - 1e-3 * model.transition
            seen_steps += change**2
            model.transition += rate * change / np.sqrt(seen_steps)
    return model


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on a bounded sample of the documents with a language that are not held out."""
    usable = docs.select("doc_id", "lang").where(id_remainder("doc_id", 4) != 2).where(F.col("lang").isNotNull())
    rows = bounded_sample(docs, usable, "lang", sample_rows)
    return fit([t for t, _ in rows], [str(y) for _, y in rows])


def predict_language(docs: DataFrame, model: LanguageModel, spans: bool = False) -> DataFrame:
    """All columns of ``docs``, ``lang_pred``, ``lang_score``, and ``lang_spans`` if asked for.

    Spans are runs of words (parted at white space) of one language. A text that is null or
    has no letter is ``und`` with score 0; so is every text if nothing was learned.
    """
    kind = "array<struct<start:int,end:int,lang:string>>"
    pa_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, most=BLOCK_CHARS):
            names, scores = model.predict(texts)
            columns = [*rows.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if spans:
                found = [[dict(zip(("start", "end", "lang"), s)) for s in model.spans(t)] for t in texts]
                columns.append(pa.array(found, pa_kind))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    docs = docs.drop("lang_pred", "lang_score", "lang_spans")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    if spans:
        added.append(T.StructField("lang_spans", T._parse_datatype_string(kind)))
    schema = T.StructType([*docs.schema, *added])
    return docs.mapInArrow(predict, schema)


def language_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    A row per row of ``docs``; a null id is not held out and not learned from.
    """
    found = predict_language(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )
