"""Language model: hashed maximum entropy over n-gram and skip features, outputs factored by class."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import id_remainder, mix, stored

#: Classes, and words of each: the most frequent words of the corpus are outputs of their own, all others are one.
CLASSES, CLASS_WORDS = 16, 32
#: Words that every task knows with their counts, at most, and bytes of such a word; the rest is joined.
KNOWN, LONGEST = 1 << 17, 1024
#: Rows of each of the two weight tables; features are hashed to them.
ROW_BITS = 14
#: Rounds of training; a document takes part in one of them.
ROUNDS = 2
#: First step of a row, and words whose gradient is taken at once.
RATE, BATCH = 0.15, 4096
#: Bytes of text worked on at once, and distinct words that a task counts before it hands its partial counts on.
BLOCK_BYTES, COUNTED_WORDS = 1_000_000, 400_000
#: Words whose number a Python worker keeps.
CACHED_WORDS = 500_000
#: Words of a training task at least, weight rows of one block of a merge, and tasks that are merged at once.
TRAINER_WORDS, MERGED_ROWS, FAN_IN = 4_000_000, 1024, 64

#: The end of a text is a token; no word has this byte.
END = b"\n"
# Lowers A-Z; bytes.split parts at 20 and 09 to 0D.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SALT = np.uint64(0x9E3779B97F4A7C15)
# Positions of a feature's words before the predicted one: n-grams, then skips.
_FEATURES = ((1,), (1, 2), (2,))


_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def words_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text and its end, in lists of about ``BLOCK_BYTES``."""
    text, at = (text or b"").translate(_LOWER), 0
    while len(text) - at > BLOCK_BYTES and (cut := _BLANK.search(text, at + BLOCK_BYTES)):
        yield text[at : cut.start()].split()
        at = cut.start()
    yield [*text[at:].split(), END]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of at most ``BLOCK_BYTES`` of ``text``, or one row."""
    for batch in batches:
        values, first, size = batch.column("text").to_pylist(), 0, 0
        for i, value in enumerate(values):
            length = len(value or b"")
            if size and size + length > BLOCK_BYTES:
                yield batch.slice(first, i - first), values[first:i]
                first, size = i, 0
            size += length
        if first < len(values):
            yield batch.slice(first), values[first:]


# --- counts of the corpus ---------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all ``text`` (binary): counted per task, merged by Spark."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
            )

        counts: Counter[bytes] = Counter()
        for _, values in _texts(batches):
            for text in values:
                for words in words_of(text):
                    counts.update(words)
                    if len(counts) > COUNTED_WORDS:
                        yield batch()
                        counts.clear()
        if counts:
            yield batch()

    partial = texts.select("text").mapInArrow(counted, "word binary, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Frequent words, most frequent first, and sums over all words of the training texts.

    The first ``outputs`` of the words have an output of their own. A word without its own output has the probability of all such words together,
    shared out by count plus a half; one of these shares is that of all words
    never seen.
    """

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    outputs: int

    def __post_init__(self) -> None:
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.other = min(self.outputs, len(self.words))
        self.rest_total = self.total - int(self.counts[: self.other].sum())
        self.rest_distinct = self.distinct - self.other

    def base(self, c):
        """log10 of a word's probability in the base model, by its count."""
        return np.log10((np.asarray(c, np.float64) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    @property
    def rest_mass(self) -> float:
        return self.rest_total + 0.5 * (self.rest_distinct + 1)

    def within(self, c):
        """log10 of the share that a word without its own output has of all such words, by its count."""
        return np.log10((np.asarray(c, np.float64) + 0.5) / self.rest_mass)


def learn_vocabulary(counts: DataFrame, outputs: int, known: int | None = None) -> Vocabulary:
    """The most frequent words of the table ``word, c``, ``known`` at most, and its sums.

    How often a word occurs at least to be among them follows from a histogram
    of the counts to 11 significant bits; words of the same bucket are in or out
    together.
    """
    known = KNOWN if known is None else known
    cut = F.greatest(F.floor(F.log2("c")).cast("int") - 10, F.lit(0))
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("c"), cut), cut)
    histogram = counts.groupBy(bucket.alias("least")).agg(F.sum("c"), F.count("*")).collect()
    total, distinct = sum(r[1] for r in histogram), sum(r[2] for r in histogram)
    least, held = None, 0
    for bucket_least, _, n in sorted(histogram, reverse=True):
        held += n
        if held > known:
            break
        least = bucket_least
    if least is None:
        return Vocabulary([], np.empty(0, np.int64), total, distinct, outputs)
    top = counts.where((F.col("c") >= least) & (F.length("word") <= LONGEST)).select("word", "c").toArrow()
    top = top.sort_by([("c", "descending"), ("word", "ascending")])
    return Vocabulary(top["word"].to_pylist(), top["c"].to_numpy(), total, distinct, outputs)


# --- the model --------------------------------------------------------------------


class _Numbers(dict):
    """Number by word: its rank among the known words, or beyond them a number by hash."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__(vocabulary.ids)
        self.mark = self.known = len(vocabulary.words)

    def __missing__(self, word: bytes) -> int:
        number = self.known + 1 + zlib.crc32(word)
        if len(self) < self.known + CACHED_WORDS:
            self[word] = number
        return number


@dataclass
class MaxEntModel:
    """Weights by hashed feature: of the classes, and of the words in a class by feature and class.

    ``p(word) = p(class | features) * p(word | class, features)``, both softmax.
    Rows of unused places in a class have a bias that leaves them no probability.
    """

    vocabulary: Vocabulary
    classes: int = CLASSES
    width: int = CLASS_WORDS
    bits: int = ROW_BITS
    #: ``tables[0]`` by feature has a column per class, ``tables[1]`` by feature and class one per word.
    tables: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.tables:
            rows = 1 << self.bits
            self.tables = [np.zeros((rows, n), np.float32) for n in (self.classes, self.width)]
        if not self.bias:
            mass = np.zeros(self.classes * self.width)
            mass[: self.vocabulary.other] = self.vocabulary.counts[: self.vocabulary.other] + 0.5
            mass[self.vocabulary.other] = self.vocabulary.rest_mass
            mass = mass.reshape(self.classes, self.width)
            with np.errstate(divide="ignore"):
                by_class, within = np.log(mass.sum(axis=1)), np.log(mass)
            self.bias = [np.maximum(b, -1e4).astype(np.float32) for b in (by_class, within)]

    def numbers(self) -> _Numbers:
        return _Numbers(self.vocabulary)

    def rows(self, numbers: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]:
        """Class and place of the words at these positions, and per table the rows of their features.

        Three numbers stand before the first position.
        """
        target = np.minimum(numbers[at], self.vocabulary.other)
        of, place = target // self.width, target % self.width
        shift, found = np.uint64(64 - self.bits), [[], []]
        for i, feature in enumerate(_FEATURES):
            hashed = np.full(len(at), i + 1, np.uint64)
            for back in feature:
                hashed = mix(hashed * _SALT + numbers[at - back].astype(np.uint64))
            found[0].append((hashed >> shift).astype(np.int64))
            found[1].append((mix(hashed + _SALT * (of.astype(np.uint64) + np.uint64(1))) >> shift).astype(np.int64))
        return of, place, found

    def _shares(self, of: np.ndarray, found: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Softmax over classes, and over the words of the class ``of``, for each position."""
        shares = []
        for table, bias, rows in zip(self.tables, (self.bias[0], self.bias[1].take(of, axis=0)), found):
            z = table.take(rows[0], axis=0)
            z += bias
            for more in rows[1:]:
                z += table.take(more, axis=0)
            # Far below where the exponential of a float32 overflows; weights do not come near.
            np.minimum(z, 60, out=z)
            np.exp(z, out=z)
            z *= (1 / (z @ np.ones(z.shape[1], np.float32)))[:, None]
            shares.append(z)
        return shares

    def log10(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 of each word's probability; of a word without its own output, that of all such words together."""
        found = np.empty(len(at))
        for first in range(0, len(at), BATCH):
            part = at[first : first + BATCH]
            of, place, rows = self.rows(numbers, part)
            by_class, within = self._shares(of, rows)
            i = np.arange(len(part))
            with np.errstate(divide="ignore"):
                found[first : first + BATCH] = np.log10(by_class[i, of].astype(np.float64)) + np.log10(
                    within[i, place].astype(np.float64)
                )
        return np.maximum(found, -300.0)


def _sequences(numbers: _Numbers, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """Numbers of the words, their positions in them, the text of each and the words themselves.

    Three marks stand before each text; the next part of a long text has the last
    three words before it, so that parts make no difference.
    """
    flat: list[int] = []
    words: list[bytes] = []
    lengths: list[int] = []

    def block(text: np.ndarray) -> tuple:
        sizes = np.array(lengths, np.int64)
        at = np.arange(sizes.sum()) + 3 * np.repeat(np.arange(1, len(sizes) + 1), sizes)
        return np.array(flat, np.int64), at, np.repeat(text, sizes), words

    if len(texts) == 1:
        before = [numbers.mark] * 3
        for part in words_of(texts[0]):
            flat = before + [numbers[w] for w in part]
            words, lengths, before = part, [len(part)], flat[-3:]
            yield block(np.zeros(1, np.int64))
        return
    for text in texts:
        (part,) = words_of(text)
        flat += [numbers.mark] * 3
        flat += [numbers[w] for w in part]
        words += part
        lengths.append(len(part))
    yield block(np.arange(len(texts)))


class Trainer:
    """Gradient steps of one task, by rows: a step is divided by the root of the squares before it."""

    def __init__(self, model: MaxEntModel, rate: float = RATE) -> None:
        self.start, self.rate = model, rate
        self.model = MaxEntModel(
            model.vocabulary, model.classes, model.width, model.bits, [t.copy() for t in model.tables], model.bias
        )
        self.squares = [np.zeros(len(t), np.float32) for t in model.tables]
        self.hits = [np.zeros(len(t), np.int64) for t in model.tables]

    def step(self, numbers: np.ndarray, at: np.ndarray) -> None:
        of, place, found = self.model.rows(numbers, at)
        i = np.arange(len(at))
        for t, (share, target) in enumerate(zip(self.model._shares(of, found), (of, place))):
            np.negative(share, out=share)
            share[i, target] += 1
            table, squares, hits = self.model.tables[t], self.squares[t], self.hits[t]
            width = np.arange(share.shape[1])
            for rows in found[t]:
                # The gradient of a row is summed over all its uses here, column by column in one count.
                uses = np.bincount(rows, minlength=len(table))
                touched = np.flatnonzero(uses)
                of_row = np.empty(len(table), np.int64)
                of_row[touched] = np.arange(0, len(touched) * len(width), len(width))
                gradient = np.bincount((of_row.take(rows)[:, None] + width).ravel(), share.ravel(), len(touched) * len(width))
                gradient = gradient.reshape(-1, len(width)).astype(np.float32)
                squares[touched] += np.einsum("ij,ij->i", gradient, gradient)
                gradient *= (self.rate / np.sqrt(squares[touched] + 1.0))[:, None]
                table[touched] += gradient
                hits += uses


    def changes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of a block of rows, how often each row was used, and its change."""
        part = 0
        for old, new, hits in zip(self.start.tables, self.model.tables, self.hits):
            for first in range(0, len(old), MERGED_ROWS):
                rows = slice(first, first + MERGED_ROWS)
                if hits[rows].any():
                    yield part, hits[rows].astype(np.float32), new[rows] - old[rows]
                part += 1


_CHANGES = "part int, hits binary, change binary"


def _change_batch(part: int, hits: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
    columns = [[part], [hits.astype(np.float32).tobytes()], [change.astype(np.float16).tobytes()]]
    kinds = [pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "hits", "change"])


def _changes(texts: DataFrame, model: MaxEntModel, rate: float) -> DataFrame:
    """``part, hits, change`` of every task and block of weight rows, after one pass over its texts."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value, rate)
        numbers = trainer.model.numbers()
        for _, values in _texts(batches):
            for sequence, at, _, _ in _sequences(numbers, values):
                for first in range(0, len(at), BATCH):
                    trainer.step(sequence, at[first : first + BATCH])
        for change in trainer.changes():
            yield _change_batch(*change)

    return texts.select("text").mapInArrow(train, _CHANGES)


def _merged(changes: DataFrame) -> DataFrame:
    """One row per ``part`` and task: rows changed by the mean over tasks, each by how often it used them."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for rows in batches:
            for part, hits, change in zip(*(rows.column(c).to_pylist() for c in ("part", "hits", "change"))):
                hits = np.frombuffer(hits, np.float32).astype(np.float64)
                change = np.frombuffer(change, np.float16).reshape(len(hits), -1) * hits[:, None]
                if part in sums:
                    sums[part][0] += hits
                    sums[part][1] += change
                else:
                    sums[part] = [hits, change]
        for part, (hits, change) in sums.items():
            yield _change_batch(part, hits, change / np.maximum(hits, 1)[:, None])

    return changes.select("part", "hits", "change").mapInArrow(merge, _CHANGES)


def fit(texts: DataFrame, vocabulary: Vocabulary, rate: float = RATE, rounds: int = ROUNDS, **shape) -> MaxEntModel:
    """Distributed gradient updates over all ``id, text``, each row in one of the rounds.

    In a round every task goes over its texts from the same weights, step by
    step; a weight row then moves by the mean of the tasks' changes, each
    weighted by how often it used the row. Changes are merged ``FAN_IN`` tasks at
    a time, in blocks of rows; what reaches the driver is one change per row.
    """
    model = MaxEntModel(vocabulary, **shape)
    tasks = max(1, vocabulary.total // rounds // TRAINER_WORDS)
    blocks = -(-(1 << model.bits) // MERGED_ROWS)
    for turn in range(rounds):
        dealt = texts.where(F.pmod(F.xxhash64("id", "text"), F.lit(rounds)) == turn)
        changes, left = _changes(dealt.coalesce(tasks), model, rate), tasks
        while left > 1:
            salt = F.pmod(F.spark_partition_id(), F.lit(-(-left // FAN_IN)))
            changes = _merged(changes.withColumn("salt", salt).repartition("part", "salt"))
            left = -(-left // FAN_IN)
        for part, hits, change in _merged(changes.coalesce(1)).collect():
            table, first = model.tables[part // blocks].copy(), part % blocks * MERGED_ROWS
            table[first : first + MERGED_ROWS] += np.frombuffer(change, np.float16).reshape(-1, table.shape[1])
            model.tables[part // blocks] = table
    return model


# --- scores -----------------------------------------------------------------------


def _scored(docs: DataFrame, model: MaxEntModel) -> DataFrame:
    """``doc_id``, counts and scores as far as known words go, and the other words with how often."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rest", T.ArrayType(T.BinaryType())),
            T.StructField("times", T.ArrayType(T.LongType())),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, numbers = shared.value, shared.value.numbers()
        vocabulary, known_words = model.vocabulary, len(model.vocabulary.words)
        base = np.append(vocabulary.base(vocabulary.counts), 0.0)
        within = np.append(vocabulary.within(vocabulary.counts), 0.0)
        within[: vocabulary.other] = 0.0
        for rows, values in _texts(batches):
            n = len(values)
            tokens, known, sums, scores = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            rest: list[Counter[bytes]] = [Counter() for _ in values]
            for sequence, at, text, words in _sequences(numbers, values):
                number = np.minimum(sequence[at], known_words)
                tokens += np.bincount(text, minlength=n)
                known += np.bincount(text, number < known_words, n).astype(np.int64)
                sums += np.bincount(text, base[number], n)
                scores += np.bincount(text, model.log10(sequence, at) + within[number], n)
                for i in np.flatnonzero(number == known_words).tolist():
                    rest[text[i]][words[i]] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    *map(pa.array, (tokens, known, sums, scores)),
                    pa.array([list(r) for r in rest], pa.list_(pa.binary())),
                    pa.array([list(r.values()) for r in rest], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(score, schema)


def score_texts(docs: DataFrame, counts: DataFrame, model: MaxEntModel) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row of ``docs(doc_id, text)``.

    Words beyond the known ones, rare by construction, are joined to the counts of
    all training words ``word, c``.
    """
    vocabulary = model.vocabulary
    scored = stored(_scored(docs, model).withColumn("row", F.monotonically_increasing_id()), "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w")).select(
        "row", F.col("w.rest").alias("word"), F.col("w.times").alias("times")
    )
    c, n = F.coalesce("c", F.lit(0)), F.col("times")
    share = F.log10((c + 0.5) / F.lit(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))
    within = F.log10((c + 0.5) / F.lit(vocabulary.rest_mass))
    added = (
        rest.join(counts, "word", "left")
        .select("row", (n * (c > 0).cast("long")).alias("known"), (n * share).alias("base"), (n * within).alias("within"))
        .groupBy("row")
        .agg(F.sum("known").alias("more"), F.sum("base").alias("more_base"), F.sum("within").alias("within"))
    )
    return scored.select("row", "doc_id", "n_tokens", "n_known", "base", "score").join(added, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("within", F.lit(0.0))).alias("score"),
    )


def language_model_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Counts and weights are learned from all documents that are not held out, by
    ``crc32(doc_id) mod 5``; a null id is not. A null or empty text is its end
    alone. A row per row of ``docs``; other columns are ignored. Without a
    training document every word is unseen.
    """
    base = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    held_out = F.coalesce(id_remainder("id", 5) == 1, F.lit(False))
    training = base.where(~held_out)
    counts = stored(word_counts(training), "word-counts")
    vocabulary = learn_vocabulary(counts, CLASSES * CLASS_WORDS - 1)
    model = fit(training, vocabulary)
    rows = score_texts(base.select(F.col("id").alias("doc_id"), "text"), counts, model)
    return rows.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", 5) == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
