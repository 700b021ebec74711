from __future__ import annotations

import math
import random
import zlib

import numpy as np

from fleetpulse.llm.common import labelled_sample
from fleetpulse.llm.queries import QUERIES
from fleetpulse.llm.toxicity import (
    PRIOR,
    PRIOR_EACH,
    SHRINKAGE,
    ToxicModel,
    decay_of,
    maximal_segments,
    score_toxicity,
    scored_tokens,
    toxicity_rows,
    train,
)


def brute_segments(scores):
    """Take the best segment (shortest, then first), then go on left and right of it."""

    def best(low, high):
        found = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += scores[b]
                if total > 0 and (found is None or (total, -(b - a)) > (found[2], -(found[1] - 1 - found[0]))):
                    found = (a, b + 1, total)
        return [] if found is None else [*best(low, found[0]), found, *best(found[1], high)]

    return best(0, len(scores))


def test_segments_against_recursive_search():
    source = random.Random(1)
    for _ in range(400):
        # Sums of odd parts never tie.
        scores = [source.choice([-1, 1]) * (source.randrange(1, 50) + source.random()) for _ in range(source.randrange(25))]
        found, expected = maximal_segments(np.array(scores)), brute_segments(scores)
        assert [f[:2] for f in found] == [e[:2] for e in expected]
        assert np.allclose([f[2] for f in found], [e[2] for e in expected])


def test_decay_is_the_positive_root():
    scores, neutral = [(3.0, 0.01), (5.0, 0.001)], -0.2
    x = decay_of(scores, neutral)
    total = (1 - 0.011) * math.exp(neutral * x) + sum(p * math.exp(s * x) for s, p in scores)
    assert x > 0 and abs(total - 1) < 1e-6


def test_passages_of_a_text():
    model = ToxicModel({b"bad": 5.5, b"awfu*": 4.5}, neutral=-0.5, decay=1.0)
    text = " ".join(["fine"] * 30 + ["bad", "AWFULLY", "bad"] + ["fine"] * 30 + ["bad"] * 4)
    _, found = model.passages(text)
    assert [(a, b) for a, b, _ in found] == [(30, 33), (63, 67)]
    assert model.passages(None) == model.passages("") == model.passages(" .!")


def test_every_token_is_scored(spark):
    source = random.Random(3)
    rows = [(f"t{i}*".encode() if i % 3 == 0 else f"t{i}".encode(), source.choice([0, 1, 5, 80]), source.choice([0, 1, 9, 700])) for i in range(200)]
    rows = [r for r in rows if r[1] + r[2]]
    n1, n0, n = sum(r[1] for r in rows), sum(r[2] for r in rows), len(rows)
    counts = spark.createDataFrame(rows, "token binary, toxic long, clean long")
    found = {bytes(r["token"]): r["score"] for r in scored_tokens(counts).collect()}
    for token, toxic, clean in rows:
        alpha, mass = 2 * PRIOR * (toxic + clean) / (n1 + n0) + 2 * PRIOR_EACH, 2 * PRIOR + n * 2 * PRIOR_EACH
        p, q = n1 / (n1 + n0), n0 / (n1 + n0)
        one, zero = toxic + alpha * p, clean + alpha * q
        odds = math.log(one / (n1 + mass * p - one)) - math.log(zero / (n0 + mass * q - zero))
        z = odds / math.sqrt(1 / one + 1 / zero)
        assert math.isclose(found[token], odds * max(0.0, 1 - (SHRINKAGE / z) ** 2), abs_tol=1e-9)
    assert min(found.values()) < 0 < max(found.values()) and len(found) == len(rows)


def test_a_repeated_id_counts_once(spark, documents):
    docs = documents(*[(1, f"text {i % 7}") for i in range(300)], (2, "other"), (3, None))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 10).collect()
    assert sorted((r["doc_id"], r["label"]) for r in rows) == [(1, 1), (2, 0)]


def corpus(n, seed=1):
    source, rows = random.Random(seed), []
    for i in range(n):
        words = [f"w{source.randrange(300)}" for _ in range(source.randrange(30, 90))]
        if i % 5 == 0:
            words[10:13] = source.choices(["vile", "nasty", "horrid"], k=3)
        rows.append((i, " ".join(words), None))
    return rows


def test_learns_and_leaves_clean_texts_alone(spark, documents):
    rows = corpus(400)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, *_ in rows if i < 300], "doc_id long, toxic int")
    docs = documents(*rows)
    model = train(docs, labels)
    found = score_toxicity(docs, model).collect()
    assert all((r["toxic_score"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in found)
    assert all(any(p["start"] <= 10 < p["end"] for p in r["toxic_passages"]) for r in found if r["doc_id"] % 5 == 0)


def test_odd_rows(spark, odd, documents):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (4, None), (7, 3), (3, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        rows = toxicity_rows(odd, some).collect()
        assert len(rows) == 10 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert {r["score"] for r in toxicity_rows(odd, labels.limit(0)).collect()} == {0.5}
    assert toxicity_rows(documents(), labels).count() == 0


def test_query(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect())
    rows = QUERIES["op4_toxicity"](spark, sf_dir).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    asked = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in asked]) > 0.93
