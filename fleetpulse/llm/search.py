"""Nearest neighbours by randomly rotated one-bit codes and exact reranking."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored

#: Vectors that the centre of the codes is the mean of, at most.
SAMPLE_ROWS = 10_000
#: Vectors of an index block and of a query block; a task takes one of each.
INDEX_BLOCK = 4096
QUERY_BLOCK = 4096
#: Width of the error bound in standard deviations of the estimate.
BOUND = 1.9
#: Queries estimated at once, and pairs reranked at once.
TILE = 64
RERANK_PAIRS = 100_000


def valid_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` as doubles without nulls, zero vectors, and null, NaN or infinite components."""
    infinite = F.lit(float("inf"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)) & F.exists(
        "vector", lambda x: x != 0
    )
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .where("vec_id is not null and vector is not null")
        .where(F.coalesce(usable, F.lit(False)))
    )


def common_dimension(vectors: DataFrame) -> int:
    """The most common length of ``vector``, the smaller at a tie; 0 without rows."""
    sizes = vectors.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return sizes[0]["n"] if sizes else 0


def rotation(dimension: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


class OneBitCoder:
    """Sign bits of rotated, centred vectors, and the scalars that correct the estimate.

    A vector x is ``centre + length * u``. Its code is the signs of the rotated
    u, read as a unit vector v of equal components. With ``align = <u, v>``, the
    inner product of u with a query is estimated by that of v, divided by
    ``align``; what v misses is orthogonal to it and random, so that the error
    is about ``sqrt(1 - align**2) / align / sqrt(dimension - 1)`` times the
    query's length.
    """

    def __init__(self, centre: np.ndarray) -> None:
        self.centre, self.dimension = centre, len(centre)
        self.turn = rotation(self.dimension)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, ``length / align`` and the standard error for a query of length one."""
        apart = x - self.centre
        length = np.linalg.norm(apart, axis=1)
        unit = apart / np.where(length > 0, length, 1)[:, None] @ self.turn
        bits = unit > 0
        align = np.abs(unit).sum(axis=1) / np.sqrt(self.dimension)
        align = np.where(align > 0, align, 1)
        error = np.sqrt(np.maximum(0, 1 - align**2)) / align / np.sqrt(max(1, self.dimension - 1))
        return np.packbits(bits, axis=1), length / align, length * error

    def estimate(
        self, queries: np.ndarray, bits: np.ndarray, factor: np.ndarray, error: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products and their standard errors, a row per query."""
        signs = np.unpackbits(bits, axis=1, count=self.dimension).astype(np.float32) * 2 - 1
        turned = (queries @ self.turn / np.sqrt(self.dimension)).astype(np.float32)
        around = (queries @ self.centre).astype(np.float32)[:, None]
        size = np.linalg.norm(queries, axis=1).astype(np.float32)[:, None]
        return turned @ signs.T * factor.astype(np.float32) + around, size * error.astype(np.float32)


def nearest_in_block(
    coder: OneBitCoder,
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    codes: tuple[np.ndarray, np.ndarray, np.ndarray],
    k: int,
    bound: float = BOUND,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of a block for each query: positions of queries and vectors, exact products.

    The k best estimates are reranked first; the worst exact product of these is
    beaten only by vectors whose upper bound is above it, so these are reranked too.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, len(queries), TILE):
        some = queries[first : first + TILE]
        guess, error = coder.estimate(some, *codes)
        own = query_ids[first : first + TILE, None] == ids
        guess[own] = -np.inf
        take = min(k, len(ids))
        best = np.argpartition(-guess, take - 1, axis=1)[:, :take]
        exact = np.einsum("qd,qkd->qk", some, vectors[best])
        exact[np.take_along_axis(own, best, axis=1)] = -np.inf
        worst = exact.min(axis=1) if take == k else np.full(len(some), -np.inf)
        q, v = np.nonzero((guess + bound * error >= worst[:, None] - 1e-6) & ~own)
        score = np.empty(len(q))
        for at in range(0, len(q), RERANK_PAIRS):
            part = slice(at, at + RERANK_PAIRS)
            score[part] = np.einsum("pd,pd->p", some[q[part]], vectors[v[part]])
        # Those of the first k whose upper bound was too low are in the running as well.
        missed = ~np.isneginf(exact) & ~(np.take_along_axis(guess + bound * error, best, axis=1) >= worst[:, None] - 1e-6)
        mq, mk = np.nonzero(missed)
        q = np.concatenate((q, mq))
        v = np.concatenate((v, best[mq, mk]))
        score = np.concatenate((score, exact[mq, mk]))
        order = np.lexsort((ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        out.append((q[keep] + first, v[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    index_block: int = INDEX_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k vectors of largest inner product with each query.

    A query is not its own neighbour. Scores are exact, in double precision;
    ties go to the smaller id. Unusable vectors (``valid_vectors``) and those not of
    the most common dimension take no part on either side. Ids are integers;
    rows that repeat an id are vectors of their own, none of which is a
    neighbour to a query of that id, and queries of their own: each gets its k
    rows, numbered from 1, under the shared id. Other columns are ignored.

    Every row is encoded. Blocks of queries meet blocks of the index, one pair
    in a task; only the k best of each pair go on. Blocks are dealt by the
    number of the stored row, so rows that repeat in large number are spread
    like all others.
    """
    spark = vectors.sparkSession
    known = valid_vectors(vectors, vec_id, vector)
    dimension = common_dimension(known)
    if not dimension:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    known = known.where(F.size("vector") == dimension)
    asked = valid_vectors(queries, vec_id, vector).where(F.size("vector") == dimension)
    sample = known.orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).select("vector").collect()
    coder = OneBitCoder(np.array([r[0] for r in sample]).mean(axis=0))

    numbered = F.monotonically_increasing_id().alias("row")
    codes = known.mapInArrow(_encoder(coder), "vec_id long, vector binary, bits binary, factor double, error double")
    index = stored(codes.select("*", numbered), "codes")
    packed = stored(asked.mapInArrow(_packer, "vec_id long, vector binary").select("*", numbered), "asked")
    n_index = max(1, -(-index.count() // index_block))
    n_query = max(1, -(-packed.count() // query_block))

    def blocks(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(own_blocks)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
        )

    pairs = (
        blocks(index, "ib", n_index, "qb", n_query)
        .groupBy("ib", "qb")
        .cogroup(blocks(packed, "qb", n_query, "ib", n_index).groupBy("ib", "qb"))
    )
    found = pairs.applyInPandas(_searcher(coder, k), "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _encoder(coder: OneBitCoder) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _packer(batches):
            x = _matrix(rows.column("vector").to_pylist())
            bits, factor, error = coder.encode(x)
            packed = pa.array([r.tobytes() for r in bits], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, packed, pa.array(factor), pa.array(error)],
                names=["vec_id", "vector", "bits", "factor", "error"],
            )

    return encode


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        if rows.num_rows:
            x = rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), packed], names=["vec_id", "vector"])


def _matrix(packed: Iterable[bytes]) -> np.ndarray:
    rows = list(packed)
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _searcher(coder: OneBitCoder, k: int) -> Callable:
    def search(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(asked):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        query_ids, ids = asked["vec_id"].to_numpy(), index["vec_id"].to_numpy()
        bits = np.frombuffer(b"".join(index["bits"]), np.uint8).reshape(len(index), -1)
        codes = (bits, index["factor"].to_numpy(), index["error"].to_numpy())
        q, v, score = nearest_in_block(
            coder, query_ids, _matrix(asked["vector"]), ids, _matrix(index["vector"]), codes, k
        )
        rows = asked["row"].to_numpy()[q]
        return pd.DataFrame({"query_row": rows, "query_id": query_ids[q], "vec_id": ids[v], "score": score})

    return search
