from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from fleetpulse.llm import decontamination
from fleetpulse.llm.decontamination import (
    FMIndex,
    Phrases,
    contamination_rows,
    find_phrases,
    remove_phrases,
    shard_hits,
    suffix_array,
)
from fleetpulse.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows(text, window):
    found = words(text)
    return {tuple(found[i : i + window]) for i in range(max(1, len(found) - window + 1) if found else 0)}


def brute(text, items, window):
    said, hit, names = words(text), set(), set()
    for name, item in items:
        for phrase in windows(item, window) if name is not None else ():
            for i in range(len(said) - len(phrase) + 1):
                if tuple(said[i : i + len(phrase)]) == phrase:
                    hit.update(range(i, i + len(phrase)))
                    names.add(str(name))
    return len(said), hit, names


def test_suffix_array_and_index():
    source = np.random.default_rng(1)
    for trial in range(60):
        n = int(source.integers(1, 120))
        text = np.append(source.integers(0, 4, n), 0).astype(np.int32)
        order, zeros = suffix_array(text), np.cumsum(text == 0) - 1
        key = [[zeros[j] - 10**6 if text[j] == 0 else text[j] for j in range(i, len(text))] for i in range(len(text))]
        assert order.tolist() == sorted(range(len(text)), key=key.__getitem__)
        index = FMIndex(text, 3, step=5)
        for length in (1, 2, 3):
            phrases = source.integers(1, 4, (9, length))
            low, high = index.search(phrases)
            for phrase, a, b in zip(phrases, low, high):
                at = [i for i in range(len(text) - length + 1) if (text[i : i + length] == phrase).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == at


def test_shards_against_plain_search():
    source, voice = random.Random(3), ["a", "b", "C", "dé", "9", "É"]
    for _ in range(200):
        items = [(str(i), " ".join(source.choices(voice, k=source.randrange(10)))) for i in range(source.randrange(5))]
        docs = [" ,".join(source.choices([*voice, "zz"], k=source.randrange(60))) for _ in range(6)] + [""]
        found = shard_hits([d.encode() for d in docs], Phrases.of([(i, t.encode()) for i, t in items], 4))
        for doc, n, spans, names in zip(docs, *found):
            assert (n, {i for a, b in spans for i in range(a, b)}, names) == brute(doc, items, 4)


@pytest.mark.parametrize("passes", [1, 3])
def test_spans_and_removal(spark, documents, prose, monkeypatch, passes):
    items = [(i, prose(30, 100 + i)) for i in range(9)] + [(20, "Short ITEM"), (None, prose(12, 7)), (21, None), (22, "?")]
    if passes > 1:
        monkeypatch.setattr(decontamination, "ITEM_WORDS", sum(len(t or "") for _, t in items) // 2 // passes + 1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = {
        1: prose(40, 1),
        2: prose(20, 2) + "\n" + prose(30, 101) + " " + prose(15, 3),
        3: "so Short: item!",
        4: prose(30, 102).upper() + " " + prose(30, 103),
        5: " ".join(prose(30, 104).split()[3:13]),
        6: None,
        7: prose(12, 7),
        8: prose(50_000, 8) + " " + prose(30, 105),
    }
    found = {r["doc_id"]: r for r in find_phrases(documents(*texts.items()), bench, with_text=True).collect()}
    for doc_id, text in texts.items():
        n, hit, names = brute(text, items, 10)
        r = found[doc_id]
        assert r["n_words"] == n and {i for s in r["hit_spans"] for i in range(s["start"], s["end"])} == hit
        assert set(r["hit_items"]) == names
        if not hit:
            assert r["clean_text"] == text
        else:
            assert words(r["clean_text"]) == [w for i, w in enumerate(words(text)) if i not in hit]
    assert found[3]["clean_text"] == "so !"
    docs = documents(*texts.items()).withColumn("n_chars", __import__("pyspark").sql.functions.length("text"))
    clean = remove_phrases(docs, bench)
    assert clean.columns == docs.columns
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in clean.collect())


def test_odd_rows(spark, odd, documents):
    bench = spark.createDataFrame([(5, "b c"), (10, "B, c"), (None, "a")], "item_id long, text string")
    rows = contamination_rows(odd, bench).collect()
    assert len(rows) == 10
    hits = [r for r in rows if r["contaminated"]]
    assert sorted(str(r["doc_id"]) for r in hits) == ["5", "6", "6", "None"]
    assert {r["items_sha256"] for r in hits} == {hashlib.sha256(b"10,5").hexdigest()}
    assert {r["n_hit"] for r in hits} == {2}
    none = contamination_rows(odd, bench.limit(0)).collect()
    assert {(r["n_items"], r["items_sha256"]) for r in none} == {(0, hashlib.sha256(b"").hexdigest())}
    assert contamination_rows(documents(), bench).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    expected, phrases = {}, {}
    for name, text in items:
        for w in windows(text, 10):
            phrases.setdefault(w, set()).add(str(name))
    for doc_id, text in docs:
        said, hit, names = words(text), set(), set()
        for i in range(len(said)):
            if tuple(said[i : i + 10]) in phrases and i + 10 <= len(said):
                hit.update(range(i, i + 10))
                names |= phrases[tuple(said[i : i + 10])]
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        expected[doc_id] = (len(said), len(hit), len(names), sha, bool(hit))
    rows = QUERIES["op6_decontamination"](spark, sf_dir).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == expected
    assert any(e[4] for e in expected.values())
