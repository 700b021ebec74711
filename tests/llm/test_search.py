from __future__ import annotations

import numpy as np

from fleetpulse.llm.queries import QUERIES
from fleetpulse.llm.search import OneBitCoder, nearest

SCHEMA = "vec_id long, embedding array<double>, rank int, score double, bits int, vector int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, 0, 0) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    """Neighbours by exact products, without the query's own id."""
    out = {}
    for q, x in queries:
        scored = sorted((-float(np.dot(x, y)), i) for i, y in rows if i != q)[:k]
        out[q] = [(i, -s) for s, i in scored]
    return out


def ours(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], rtol=1e-12, atol=1e-12)


def test_estimates_are_within_their_bounds():
    source = np.random.default_rng(1)
    x, q = source.standard_normal((3000, 48)) + 0.3, source.standard_normal((40, 48))
    coder = OneBitCoder(x.mean(axis=0))
    guess, error = coder.estimate(q, *coder.encode(x))
    off = (guess - q @ x.T) / error
    assert abs(off.mean()) < 0.05 and 0.93 < (abs(off) < 1.9).mean() <= 1


def test_recall_over_blocks(spark):
    source = np.random.default_rng(2)
    centres = source.standard_normal((12, 32))
    x = centres[source.integers(0, 12, 1500)] + 0.6 * source.standard_normal((1500, 32))
    x[:400] = x[0]  # a very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = frame(spark, rows)
    found = ours(nearest(df, df.where("vec_id % 20 = 0"), k=20, index_block=400, query_block=30))
    expected = brute(rows, rows[::20], 20)
    assert found.keys() == expected.keys()
    close = [np.allclose([s for _, s in found[q]], [s for _, s in expected[q]]) for q in found]
    assert np.mean(close) > 0.9
    same({0: found[0]}, {0: expected[0]})  # ties go to the smaller ids


def test_odd_vectors(spark):
    good = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [-1.0, 2.0]), (2, [1.0, 1.0]), (-5, [1.0, 1.0])]
    bad = [
        (10, None), (11, []), (12, [0.0, 0.0]), (13, [1.0, None]), (14, [float("nan"), 1.0]),
        (15, [float("inf"), 1.0]), (None, [1.0, 1.0]), (16, [1.0, 2.0, 3.0]),
    ]
    df = frame(spark, good + bad)
    same(ours(nearest(df, df.where("vec_id in (1, 3, 12, 16) or vec_id is null"), k=3)), brute(good, [good[0], good[2]], 3))
    # Fewer than k: all of them. Both rows of an id are neighbours, none to a query of that id.
    assert [i for i, _ in ours(nearest(df, df.where("vec_id = 1")))[1]] == [-5, 2, 2, 3]
    assert [i for i, _ in ours(nearest(df, df.where("vec_id = -5")))[-5]] == [2, 2, 1, 3]
    assert nearest(df.limit(0), df).count() == 0
    assert nearest(df, df.limit(0)).count() == 0
    alone = frame(spark, good[:1])
    assert nearest(alone, alone).count() == 0


def test_queries_of_one_id(spark):
    source = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(source.standard_normal((30, 2)), 1)]
    asked = [(0, [1.0, 0.0]), (0, [0.0, 1.0])]
    found = nearest(frame(spark, rows), frame(spark, asked), k=4).collect()
    expected = [i for x in asked for i, _ in brute(rows, [x], 4)[0]]
    assert sorted(r["vec_id"] for r in found) == sorted(expected)
    assert sorted(r["rank"] for r in found) == [1, 1, 2, 2, 3, 3, 4, 4]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = ours(QUERIES["op1_nearest"](spark, sf_dir))
    expected = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert found.keys() == expected.keys() and {len(v) for v in found.values()} == {20}
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in found)
    assert hits >= 0.97 * 20 * len(found)
