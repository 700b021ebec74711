from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from fleetpulse.llm import packing
from fleetpulse.llm.common import stored
from fleetpulse.llm.packing import WordTokenizer, given_away, least_bins, pack, pack_part, pack_pieces, packed
from fleetpulse.llm.queries import QUERIES, tokenizer_file

ALPHABET = "abcXYZéÉß'sStTrReEvVmMlLdD019 \t\n\x0b\x1c\x1f\x85\xa0\x01²½İΣσς́è.,!-_<|>​漢字ﬁ😀"


def plain_ids(text):
    tokenizer = WordTokenizer.opened(tokenizer_file()).tokenizer
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer():
    source, own = random.Random(1), WordTokenizer.opened(tokenizer_file())
    texts = ["", " ", "\x01", "a\x01b \x01 c", "don'T I'LL ''s", "<|endoftext|>a", "A<|STARTOFTEXT|>", "x<|startoftext|>Y"]
    texts += ["".join(source.choice(ALPHABET) for _ in range(source.randrange(30))) for _ in range(1500)]
    texts += ["".join(source.choice(ALPHABET[:30]) for _ in range(source.randrange(40))) for _ in range(1500)]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == plain_ids(text), repr(text)


def fewest(sizes, capacity):
    """Bins of an optimal packing, by trying everything."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] >= sizes[i]:
                bins[j] -= sizes[i]
                place(i + 1, bins)
                bins[j] += sizes[i]
        bins.append(capacity - sizes[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best


def test_bound_is_below_the_optimum_and_packing_above():
    source = random.Random(3)
    tight = 0
    for _ in range(150):
        capacity = source.randrange(8, 40)
        sizes = sorted((source.randrange(1, capacity + 1) for _ in range(source.randrange(1, 8))), reverse=True)
        values, counts = np.unique(sizes, return_counts=True)
        low, optimum = least_bins(values, counts, capacity), fewest(sizes, capacity)
        bins, n = packed(np.array(sizes), capacity)
        assert low <= optimum <= n
        assert (np.bincount(bins, sizes, n) <= capacity).all()
        tight += low == optimum
    assert tight > 140


def test_what_a_partition_gives_away():
    def rows(lengths, former):
        n = len(lengths)
        return pd.DataFrame(
            {"doc_id": range(n), "piece": [0] * n, "length": lengths, "ids_crc32": [0] * n, "sequence_id": former}
        )

    certified = pack_part(rows([6, 4, 5, 3], [-1] * 4), 10, False)
    assert certified.set_index("doc_id")["__open"].to_dict() == {0: False, 1: False, 2: True, 3: True}
    assert not pack_part(rows([6, 4, 5, 3], [-1] * 4), 10, True)["__open"].any()


def test_with_a_gap_few_bins_leave():
    filled, pieces = np.array([90, 50, 100, 60, 70, 95, 80, 85]), np.array([2] * 8)
    assert given_away(filled, pieces, 0, 100).nonzero()[0].tolist() == [1]
    assert given_away(filled, pieces, 1, 100).nonzero()[0].tolist() == [1, 3]
    assert given_away(filled, np.array([1, 9, 1, 1, 1, 1, 1, 1]), 1, 100).nonzero()[0].tolist() == [1]
    assert not given_away(np.array([100, 100]), np.array([2, 2]), 0, 100).any()


@pytest.mark.parametrize("low, high", [(700, 1800), (1200, 1700), (500, 3000), (1, 2)])
def test_no_pool_outgrows_a_partition(spark, monkeypatch, low, high):
    lengths = np.random.default_rng(low).integers(low, high + 1, 6000)
    frame = pd.DataFrame({"doc_id": range(6000), "piece": 0, "start": 0, "length": lengths, "ids_crc32": 0})
    groups = []

    def watched(df, name):
        table = stored(df, name)
        if name == "packed":
            groups.append(table.groupBy("__part").count().agg({"count": "max"}).first()[0])
        return table

    monkeypatch.setattr(packing, "stored", watched)
    rows = pack_pieces(spark.createDataFrame(frame), 4096, 250).toPandas()
    assert max(groups) <= 2.2 * max(250, 4096 if low == 1 else 0)
    assert sorted(rows["doc_id"]) == list(range(6000))
    by = rows.sort_values("offset").groupby("sequence_id")["length"]
    assert (by.cumsum() - rows["length"] == rows["offset"]).all()
    assert by.sum().max() <= 4096
    sizes, counts = np.unique(lengths, return_counts=True)
    whole = packed(lengths, 4096)[1]
    assert rows["sequence_id"].nunique() <= 1.01 * whole + 1


def test_repeated_documents_are_spread(spark):
    frame = pd.DataFrame({"doc_id": [7] * 900, "piece": 0, "start": 0, "length": 5, "ids_crc32": 1})
    rows = pack_pieces(spark.createDataFrame(frame), 50, 100)
    assert rows.count() == 900 and rows.select("sequence_id").distinct().count() == 90


def verify(rows, texts, capacity):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    for doc_id, text in texts.items():
        ids, at = [*plain_ids(text), 1], 0
        for k, r in enumerate(sorted(pieces[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            part = ids[at : at + r["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
            assert r["length"] == capacity or at == len(ids)
        assert at == len(ids)
    return len(sequences)


def test_rounds_of_small_partitions(documents, prose):
    texts = {i: prose(random.Random(i).randrange(1, 60), i) for i in range(300)} | {300: None, 301: ""}
    rows = pack(documents(*texts.items()), tokenizer_file(), capacity=64, pieces_per_part=12).collect()
    n = verify(rows, texts, 64)
    assert n <= 1.05 * sum(r["length"] for r in rows) / 64 + 1


def test_odd_rows(odd, documents):
    rows = pack(odd, tokenizer_file()).collect()
    assert len(rows) == 10
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert pack(documents(), tokenizer_file()).count() == 0


def test_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op9_packing"](spark, sf_dir).collect()
    n = verify(rows, texts, 4096)
    assert n <= sum(r["length"] for r in rows) / 4096 + 2
