"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import id_remainder, labelled_sample, stored, text_blocks

#: Labelled documents that the scores are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Dirichlet prior: counts spread over the tokens as the sample uses them, and counts of each token.
PRIOR, PRIOR_EACH = 500.0, 0.5
#: Log-odds are shrunk by the factor ``1 - (this / z) ** 2``, to zero where it is negative.
SHRINKAGE = 3.0
#: Added to the log-odds of every word, prior odds of a word in a toxic passage: how soon one ends.
NEUTRAL = -0.1
#: Beginnings of words are tokens too; a word without its own score takes that of its longest one.
STEMS = (6, 5, 4)
#: Expected number of such segments in clean text below which a segment is significant.
SIGNIFICANT = 0.001
#: Words whose score a Python worker keeps.
CACHED_WORDS = 500_000

_EULER = 0.5772156649015329
_KEPT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case runs of letters, digits and all that is not ASCII."""
    return text.lower().encode().translate(_KEPT).split() if text else []


def stems_of(word: bytes) -> list[bytes]:
    """Beginnings of a word, longest first, each marked as one."""
    letters = word.decode(errors="ignore")
    return [letters[:n].encode() + b"*" for n in STEMS if len(letters) > n]


class WordScores(dict):
    """Score by word: its log-odds in the lexicon, or its longest known beginning's, plus the neutral score."""

    def __init__(self, lexicon: dict[bytes, float], neutral: float) -> None:
        super().__init__()
        self.lexicon, self.neutral = lexicon, neutral

    def __missing__(self, word: bytes) -> float:
        score = self.lexicon.get(word)
        if score is None:
            score = next((self.lexicon[s] for s in stems_of(word) if s in self.lexicon), 0.0)
        score += self.neutral
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = score
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, left to right, in linear time.

    A candidate is joined to the nearest earlier one that begins lower, if it
    also ends higher. Only words of positive score open a candidate, so the work
    in Python is done for those alone.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, next lower one
    for at in positive.tolist():
        start, end, low, high = at, at + 1, float(total[at]), float(total[at + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((start, end, low, high, j))
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
    return [(start, end, high - low) for start, end, low, high, _ in found]


@dataclass
class ToxicModel:
    """Token scores and their calibration; picklable and of bounded size."""

    lexicon: dict[bytes, float] = field(default_factory=dict)
    neutral: float = NEUTRAL
    decay: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    bias: float = 0.0

    def __post_init__(self) -> None:
        self._scores: WordScores | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_scores": None}

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the maximal segments by word position."""
        words = words_of(text)
        if self._scores is None:
            self._scores = WordScores(self.lexicon, self.neutral)
        scores = np.fromiter(map(self._scores.__getitem__, words), np.float64, len(words))
        return len(words), maximal_segments(scores)

    def bits_of(self, n_words: int, score: float) -> float:
        """Minus the logarithm of the number of such segments expected in clean text."""
        return self.decay * score - self.log_k - math.log(max(n_words, 1))

    def passages(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Evidence of a text, and its significant segments.

        The evidence is the sum of the significant segments' normalised scores,
        or the normalised score of the best one where none is significant.
        """
        n, segments = self.segments(text)
        rated = [(start, end, self.bits_of(n, score)) for start, end, score in segments]
        least = -math.log(SIGNIFICANT)
        significant = [r for r in rated if r[2] >= least]
        if significant:
            return sum(r[2] for r in significant), significant
        return max([self.bits_of(n, 0.0), *(r[2] for r in rated)]), []

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.slope * evidence + self.bias))))


def token_counts(sample: DataFrame) -> DataFrame:
    """``token, toxic, clean``: in how many documents of the sample a word or beginning occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for rows, texts in text_blocks(batches):
            for text, label in zip(texts, rows.column("label").to_pylist()):
                words = set(words_of(text))
                counts[label].update(words)
                counts[label].update({stem for word in words for stem in stems_of(word)})
        tokens = list(counts[0].keys() | counts[1].keys())
        for first in range(0, len(tokens), 50_000):
            some = tokens[first : first + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.binary()), *(pa.array([counts[k][t] for t in some], pa.int64()) for k in (1, 0))],
                names=["token", "toxic", "clean"],
            )

    counted = sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(
        count, "token binary, toxic long, clean long"
    )
    return counted.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def scored_tokens(counts: DataFrame, prior: float = PRIOR, each: float = PRIOR_EACH) -> DataFrame:
    """Log-odds of toxic against clean documents of every token, under a Dirichlet prior.

    The prior divides its counts between both sides as the sample does, so that
    a token without counts has log-odds of zero. The score is the shrunken log-odds:
    what is large against its standard error stays, what chance explains becomes zero.
    """
    whole = counts.agg(F.sum("toxic").alias("n1"), F.sum("clean").alias("n0"), F.count("*").alias("n"))
    both = F.col("n1") + F.col("n0")
    alpha = F.lit(2 * prior) * (F.col("toxic") + F.col("clean")) / both + 2 * each
    mass = F.lit(2 * prior) + F.col("n") * 2 * each
    share1, share0 = F.greatest("n1", F.lit(1)) / both, F.greatest("n0", F.lit(1)) / both
    one, zero = F.col("toxic") + alpha * share1, F.col("clean") + alpha * share0
    odds = F.log(one / (F.col("n1") + mass * share1 - one)) - F.log(zero / (F.col("n0") + mass * share0 - zero))
    error = F.sqrt(1 / one + 1 / zero)
    return counts.crossJoin(F.broadcast(whole)).select(  # a single row of sums
        "token",
        (odds * F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide(SHRINKAGE * error, odds), F.lit(1.0e9)) ** 2)).alias("score"),
        (zero / (F.col("n0") + mass * share0)).alias("clean_share"),
    )


def decay_of(scores: list[tuple[float, float]], neutral: float) -> float:
    """The positive root of ``sum(p * exp(x * s)) = 1`` over (score, share in clean text)."""
    rest = max(0.0, 1 - sum(p for _, p in scores))

    def excess(x: float) -> float:
        return rest * math.exp(x * neutral) + sum(p * math.exp(min(500.0, x * s)) for s, p in scores) - 1

    if not scores or sum(p * s for s, p in scores) + rest * neutral >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return (low + high) / 2


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a ridge logistic regression on one value."""
    theta = np.zeros(2)
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -60, 60)))
        gradient = design.T @ (y - p) - 1e-3 * theta
        curvature = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        theta += step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicModel:
    """Fit on a bounded sample of the labelled documents that are not held out.

    Spark counts and scores every token of the sample. To the driver come the
    tokens of the sampled documents, as Arrow, and one value for each document.
    """
    usable = labels.where(id_remainder("doc_id", 5) != 0).where("toxic in (0, 1)")
    sample = stored(labelled_sample(docs, usable, "toxic", sample_rows), "toxic-sample")
    tokens = stored(scored_tokens(token_counts(sample)), "toxic-tokens")
    telling = tokens.where("score != 0").toArrow().to_pylist()
    lexicon = {r["token"]: r["score"] for r in telling}
    # A word of score zero has to be known only if one of its beginnings tells something.
    for token in tokens.where("score = 0").select("token").toArrow().column("token"):
        word = token.as_py()
        if any(s in lexicon for s in stems_of(word.rstrip(b"*"))):
            lexicon[word] = 0.0
    model = ToxicModel(lexicon)
    whole = [(r["score"] + NEUTRAL, r["clean_share"]) for r in telling if not r["token"].endswith(b"*")]
    model.decay = decay_of(whole, model.neutral)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            best, n_words = [], []
            for text in texts:
                n, segments = model.segments(text)
                best.append(max([0.0, *(s for _, _, s in segments)]))
                n_words.append(max(n, 1))
            yield pa.RecordBatch.from_arrays(
                [rows.column("label"), pa.array(best, pa.float64()), pa.array(n_words, pa.int64())],
                names=["label", "best", "n"],
            )

    labelled = sample.select("text", F.col("label").cast("int").alias("label"))
    clean = labelled.where("label = 0").mapInArrow(evidence, "label int, best double, n long")
    # Moments of the Gumbel distribution that best scores of clean documents follow.
    mean = clean.agg(F.avg(F.lit(model.decay) * F.col("best") - F.log("n"))).first()[0]
    model.log_k = (mean - _EULER) if mean is not None else 0.0

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            values = pa.array([model.passages(t)[0] for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([rows.column("label"), values], names=["label", "evidence"])

    rated = labelled.mapInArrow(rate, "label int, evidence double").collect()
    if len({r[0] for r in rated}) == 2:
        x, y = np.array([r[1] for r in rated]), np.array([r[0] for r in rated])
        model.slope, model.bias = logistic(x, y)
    else:
        model.slope, model.bias = 0.0, {0: -5.0, 1: 5.0}.get(rated[0][0] if rated else -1, 0.0)
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """All columns of ``docs``, ``toxic_score`` and ``toxic_passages``.

    A passage is ``start, end`` in words of ``words_of`` and ``evidence``, the
    normalised score. A null or empty text has no passages and the evidence of
    no segment in one word.
    """
    passage = "array<struct<start:int,end:int,evidence:double>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            rated = [model.passages(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array([model.probability(e) for e, _ in rated], pa.float64()),
                    pa.array([[dict(zip(("start", "end", "evidence"), p)) for p in s] for _, s in rated], kind),
                ],
                names=[*rows.schema.names, "toxic_score", "toxic_passages"],
            )

    docs = docs.drop("toxic_score", "toxic_passages")
    schema = T.StructType(
        [
            *docs.schema,
            T.StructField("toxic_score", T.DoubleType()),
            T.StructField("toxic_passages", T._parse_datatype_string(passage)),
        ]
    )
    return docs.mapInArrow(score, schema)


def toxicity_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the number of passages of every document.

    A row per row of ``docs``; a null id is not held out. Labels other than 0
    and 1, and labels of null ids, are not learned from; without any, every
    score is 0.5.
    """
    model = train(docs, labels)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_passages").alias("n_passages"),
    )
