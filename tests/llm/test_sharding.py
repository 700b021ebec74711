from __future__ import annotations

import random
import zlib

import pytest

from fleetpulse.llm.queries import QUERIES
from fleetpulse.llm.sharding import FreeSpace, best_fit_decreasing, even_plan, shard_rows


def check(rows, shards):
    used = {}
    for r in rows:
        assert 0 <= r["shard"] < shards
        used.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in used.values())


def test_tree_against_a_sorted_list():
    source, tree, plain = random.Random(1), FreeSpace(), []
    for i in range(3000):
        if source.random() < 0.55:
            free = source.randrange(50)
            tree.add(free, i)
            plain.append((free, i))
        else:
            need = source.randrange(60)
            expected = min((x for x in plain if x[0] >= need), default=None)
            assert tree.take_tightest(need) == expected
            if expected:
                plain.remove(expected)


def test_best_fit_one_by_one_gives_the_same():
    source = random.Random(2)
    for _ in range(100):
        capacity = source.randrange(10, 60)
        sizes = sorted((source.randrange(1, capacity + 1) for _ in range(source.randrange(40))), reverse=True)
        bins = []
        for size in sizes:
            fit = [b for b in bins if b[0] >= size]
            if fit:
                min(fit)[0] -= size
            else:
                bins.append([capacity - size])
        classes = [(s, sizes.count(s)) for s in set(sizes)]
        assert best_fit_decreasing(classes, capacity).bins == len(bins)


def test_even_plan():
    plan = even_plan([(5, 3), (3, 4), (1, 10)], 4)
    load = [0] * 4
    for weight, runs in plan.runs.items():
        for bin_, n in runs:
            load[bin_] += weight * n
    assert sum(load) == 37 and max(load) <= 11
    hot = even_plan([(1000, 1), (10, 30)], 4)
    load = [0] * 4
    for weight, runs in hot.runs.items():
        for bin_, n in runs:
            load[bin_] += weight * n
    assert sorted(load) == [100, 100, 100, 1000]
    assert even_plan([], 3).bins == 3
    assert best_fit_decreasing([(11, 1)], 10) is None


def test_odd_rows(odd):
    rows = shard_rows(odd, shards=3).collect()
    assert len(rows) == 10
    check(rows, 3)
    by_text = {}
    for r in rows:
        by_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    nothing = [r for r in rows if r["doc_id"] in (1, 2)]
    assert {(r["size"], r["text_crc32"]) for r in nothing} == {(1, 0)}
    assert {r["text_crc32"] for r in rows if r["doc_id"] == 6} == {zlib.crc32(b"a b c d e f")}


def test_empty_and_capacity(documents):
    assert shard_rows(documents()).count() == 0
    docs = documents(*[(i, "x" * i) for i in range(1, 40)])
    rows = shard_rows(docs, capacity=100).collect()
    load = {}
    for r in rows:
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
    assert max(load.values()) <= 100 and len(load) == -(-sum(range(2, 41)) // 100)
    with pytest.raises(ValueError, match="capacity"):
        shard_rows(docs, capacity=20)


def test_query(spark, sf_dir):
    rows = QUERIES["op10_sharding"](spark, sf_dir).collect()
    assert len(rows) == 200
    check(rows, 16)
    load = {}
    for r in rows:
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
    assert max(load.values()) < 1.05 * sum(load.values()) / 16
