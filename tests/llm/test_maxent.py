from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetpulse.llm import maxent
from fleetpulse.llm.maxent import MaxEntModel, Trainer, Vocabulary, _sequences, language_model_rows, words_of
from fleetpulse.llm.queries import QUERIES


def plain_words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)] + [b"\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def base_rows(rows):
    counts = Counter(w for d, t in rows if not held(d) for w in plain_words(t))
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for d, t in rows:
        words = plain_words(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        found.append((d, held(d), len(words), sum(counts[w] > 0 for w in words), total, base))
    return found


def same_base(df, rows):
    ours = sorted(df.collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"]))
    expected = sorted(base_rows(rows), key=lambda r: (str(r[0]), r[2], r[5]))
    assert len(ours) == len(expected)
    for got, want in zip(ours, expected):
        assert tuple(got)[:5] == want[:5] and got["base_score"] == pytest.approx(want[5], rel=1e-9, abs=1e-9)
        assert got["score"] <= 0 and math.isfinite(got["score"])
    return ours


def model_of(texts, classes=4, width=4, bits=10, rounds=40):
    counts = Counter(w for t in texts for w in plain_words(t))
    top = sorted(counts, key=lambda w: (-counts[w], w))[: classes * width - 1]
    # The outputs alone are known here; all other words are numbered by hash.
    vocabulary = Vocabulary(top, np.array([counts[w] for w in top], np.int64), sum(counts.values()), len(counts), len(top))
    trainer = Trainer(MaxEntModel(vocabulary, classes, width, bits))
    numbers = trainer.model.numbers()
    for _ in range(rounds):
        for sequence, at, _, _ in _sequences(numbers, [t.encode() for t in texts]):
            trainer.step(sequence, at)
    return trainer.model, counts


def plain_log10(model, context, word):
    """One word's log10 probability among the outputs, feature by feature."""
    vocabulary, numbers = model.vocabulary, model.numbers()
    sequence = [numbers.mark] * 3 + [numbers[w] for w in context] + [numbers[word]]
    of, place, rows = model.rows(np.array(sequence), np.array([len(sequence) - 1]))
    total = 0.0
    for table, bias, found, target in zip(model.tables, (model.bias[0], model.bias[1][of[0]]), rows, (of[0], place[0])):
        z = [float(bias[j]) + sum(float(table[r[0], j]) for r in found) for j in range(table.shape[1])]
        total += (z[target] - max(z) - math.log(sum(math.exp(x - max(z)) for x in z))) / math.log(10)
    return total


def test_probabilities_of_all_words_sum_to_one():
    model, counts = model_of(["a b c d e f g h", "a b a c a d zz yy xx ww vv uu tt ss rr"] * 3)
    vocabulary = model.vocabulary
    assert vocabulary.rest_distinct > 0
    for context in ([], [b"a"], [b"a", b"b", b"q"]):
        total = sum(10 ** plain_log10(model, context, w) for w in vocabulary.words)
        rest = 10 ** plain_log10(model, context, b"never seen")
        shares = sum((counts[w] + 0.5) / vocabulary.rest_mass for w in counts if w not in vocabulary.ids)
        assert total + rest * (shares + 0.5 / vocabulary.rest_mass) == pytest.approx(1, abs=1e-4)


def test_blocks_against_word_by_word():
    texts = ["a b c a b c", "b c zz A", ""]
    model, _ = model_of(texts, rounds=3)
    for sequence, at, text, words in _sequences(model.numbers(), [t.encode() for t in texts]):
        scores = np.bincount(text, model.log10(sequence, at))
    for got, t in zip(scores, texts):
        words = plain_words(t)
        assert got == pytest.approx(sum(plain_log10(model, words[:i][-3:] if i >= 3 else words[:i], w) for i, w in enumerate(words)), rel=1e-4)


def test_features_learn_order():
    """What follows a word, and what follows one word further on, is learned; counts alone do not show it."""
    texts = ["x 1 y 2 x 1 y 2 x 1", "p 3 q 4 p 3 q 4"] * 4
    model, counts = model_of(texts)
    for sequence, at, _, _ in _sequences(model.numbers(), [t.encode() for t in texts]):
        score = model.log10(sequence, at).sum()
    base = sum(float(model.vocabulary.base(counts[w])) for t in texts for w in plain_words(t))
    assert score > base / 4


def test_long_texts_in_parts(monkeypatch):
    text = ("one two\tthree\n" * 50).encode()
    model, _ = model_of(["one two three"] * 5, rounds=2)
    whole = [(s, a) for s, a, _, _ in _sequences(model.numbers(), [text])]
    assert len(whole) == 1
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 64)
    assert len(list(words_of(text))) > 5
    parts = [(s, a) for s, a, _, _ in _sequences(model.numbers(), [text])]
    assert sum(len(a) for _, a in parts) == len(whole[0][1])
    assert sum(model.log10(s, a).sum() for s, a in parts) == pytest.approx(model.log10(*whole[0]).sum(), rel=1e-6)


def test_odd_rows(odd, documents):
    same_base(language_model_rows(odd), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert language_model_rows(documents()).count() == 0
    held_ids = [i for i in range(40) if held(i)][:3]
    rows = [(i, "only held out") for i in held_ids]
    same_base(language_model_rows(documents(*rows)), rows)


def test_several_tasks_are_merged(documents, prose, monkeypatch):
    monkeypatch.setattr(maxent, "TRAINER_WORDS", 100)
    monkeypatch.setattr(maxent, "FAN_IN", 2)
    monkeypatch.setattr(maxent, "KNOWN", 150)
    rows = [(i, prose(60, i % 7)) for i in range(60)] + [(i, "word " * 3000 + "end") for i in range(60, 64)]
    ours = same_base(language_model_rows(documents(*rows).repartition(8)), rows)
    out = [r for r in ours if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


@pytest.mark.parametrize("known", [0, 1, 3, 6, 100])
def test_known_words_follow_the_counts(spark, known):
    counts = {b"a": 5000, b"b": 5000, b"c": 40, b"d": 7, b"e": 7, b"x" * 2000: 9000}
    table = spark.createDataFrame([(bytearray(w), c) for w, c in counts.items()], "word binary, c long")
    vocabulary = maxent.learn_vocabulary(table, 3, known)
    expected = {0: [], 1: [], 3: [b"a", b"b"], 6: [b"a", b"b", b"c", b"d", b"e"], 100: [b"a", b"b", b"c", b"d", b"e"]}[known]
    assert vocabulary.words == expected and vocabulary.counts.tolist() == [counts[w] for w in expected]
    assert (vocabulary.total, vocabulary.distinct) == (sum(counts.values()), 6)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    ours = same_base(QUERIES["op12_language_model"](spark, folder), rows)
    out = [r for r in ours if r["held_out"]]
    gain = (sum(r["score"] for r in out) - sum(r["base_score"] for r in out)) / sum(r["n_tokens"] for r in out)
    assert gain > 0.02
