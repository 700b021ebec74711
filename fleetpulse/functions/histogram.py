"""Bucketed histograms and quantiles estimated from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key with ``counts``: rows at or below each bound, then all rows.

    The counts are cumulative sums of conditions, so every input partition
    shrinks to one row per key before anything is shuffled.
    """
    steps = [F.count_if(F.col(value) <= F.lit(float(b))) for b in bounds]
    return df.groupBy(*keys).agg(F.array(*steps, F.count(value)).alias("counts"))


def quantile_of(counts: Column, bounds: Sequence[float], q: float) -> Column:
    """Estimate from cumulative counts, linear inside the bucket of the rank.

    The first bucket starts at 0; a rank beyond the last finite bound yields
    that bound; an empty histogram yields NULL.
    """
    total = counts[len(bounds)].cast("double")
    rank = total * F.lit(float(q))
    estimate = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        upper = float(bounds[i])
        lower = float(bounds[i - 1]) if i else 0.0
        below = counts[i - 1].cast("double") if i else F.lit(0.0)
        inside = counts[i].cast("double") - below
        within = F.when(
            inside > 0, F.lit(lower) + F.lit(upper - lower) * (rank - below) / inside
        ).otherwise(F.lit(upper))
        estimate = F.when(counts[i] >= rank, within).otherwise(estimate)
    return F.when(total > 0, estimate)


def histogram_quantiles(
    df: DataFrame,
    value: str,
    bounds: Sequence[float],
    quantiles: Sequence[float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Estimated quantiles per key as columns ``p50``, ``p95`` and so on."""
    counted = histogram(df, value, bounds, keys)
    columns = [quantile_of(F.col("counts"), bounds, q).alias(f"p{q * 100:g}") for q in quantiles]
    return counted.select(*keys, F.element_at("counts", -1).alias("sample_count"), *columns)
