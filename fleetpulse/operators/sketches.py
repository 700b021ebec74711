"""Summaries per time step that merge over any window: quantile sketches, and exact distinct counts.

Both are made once from the readings, a row per key and step. Windows and
coarser keys are then answered from those rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.times import bucket_ceil, trailing
from fleetpulse.operators.rates import lag_seconds

#: Size parameter of a sketch: its bytes grow with it, and the rank error falls.
SKETCH_SIZE = 800
#: Largest difference between the rank of an estimate and the one asked for, at this size.
RANK_ERROR = 0.01


def latency_sketches(
    readings: DataFrame, step: int, keys: Sequence[str] = ("turbine_id",), processed_at: str = "producer_ts"
) -> DataFrame:
    """``at``, keys and ``sketch``: processing latencies of the step that ends at ``at``.

    Readings of equal keys are summarised where they lie; a sketch per task and
    step is shuffled, so a machine with most of the readings is no hot key.
    """
    latency = lag_seconds(F.col(processed_at), F.col("recorded_at"))
    return readings.groupBy(bucket_ceil(F.col(processed_at), step).alias("at"), *keys).agg(
        F.kll_sketch_agg_double(latency, F.lit(SKETCH_SIZE)).alias("sketch")
    )


def sketched_quantiles(
    sketches: DataFrame,
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    keys: Sequence[str] = (),
    as_of=None,
    window: int | None = None,
) -> DataFrame:
    """Keys, ``sample_count`` and ``p50``, ``p95``, ... of merged sketches.

    With ``as_of`` and ``window`` of the steps in that window, whole steps at a
    time; otherwise of all. Keys without latencies are left out.
    """
    if as_of is not None:
        sketches = sketches.where(trailing("at", as_of, window))
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))
    counted = merged.withColumn("sample_count", F.kll_sketch_get_n_double("sketch")).where("sample_count > 0")
    estimates = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"p{q * 100:g}") for q in quantiles]
    return counted.select(*keys, "sample_count", *estimates)


def rank_errors(values: DataFrame, value: str, estimates: DataFrame, quantiles: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Keys, exact ``p50``, ..., and ``rank_error``: how far the ranks of the estimates are off, at worst.

    An estimate has all ranks from the share of smaller values to that of values
    not above it; the error is the distance of the rank asked for from these.
    ``estimates`` holds a row per key, as ``sketched_quantiles`` gives it.
    """
    names = [f"p{q * 100:g}" for q in quantiles]
    guessed = estimates.select(*keys, *[F.col(n).alias(f"_{n}") for n in names])
    total = F.count(value)

    def off(name: str, q: float) -> Column:
        below = F.count_if(F.col(value) < F.col(f"_{name}")) / total
        upto = F.count_if(F.col(value) <= F.col(f"_{name}")) / total
        return F.greatest(below - F.lit(float(q)), F.lit(float(q)) - upto, F.lit(0.0))

    exact = [F.percentile(value, F.lit(float(q))).alias(n) for n, q in zip(names, quantiles)]
    worst = F.greatest(*[off(n, q) for n, q in zip(names, quantiles)]).alias("rank_error")
    return values.join(guessed, list(keys)).groupBy(*keys).agg(total.alias("sample_count"), *exact, worst)


def machine_numbers(readings: DataFrame, machine: str = "turbine_id") -> DataFrame:
    """``machine, number``: machines numbered from 1, where the first bitmap begins, in the order of their ids."""
    known = readings.select(machine).where(F.col(machine).isNotNull()).distinct()
    return known.withColumn("number", F.row_number().over(Window.orderBy(machine)).cast("long"))


def machine_bitmaps(
    readings: DataFrame, numbers: DataFrame, step: int, ts: str = "producer_ts", machine: str = "turbine_id"
) -> DataFrame:
    """``at, bucket, machines``: a bitmap of the machines seen in the step that ends at ``at``.

    A bitmap holds 32,768 numbers, a larger fleet has several per step.
    """
    seen = readings.select(bucket_ceil(F.col(ts), step).alias("at"), machine).distinct()
    return (
        seen.join(numbers, machine)
        .groupBy("at", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("machines"))
    )


def active_machines(bitmaps: DataFrame, as_of, window: int) -> DataFrame:
    """``active_turbines``: exact number of machines seen in the steps of the window, in one row."""
    united = bitmaps.where(trailing("at", as_of, window)).groupBy("bucket").agg(F.bitmap_or_agg("machines").alias("machines"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("machines")), F.lit(0)).cast("long").alias("active_turbines"))


def active_machines_series(bitmaps: DataFrame, step: int, window: int) -> DataFrame:
    """``at, active_turbines`` at every step whose trailing window holds readings; exact.

    Counts of steps cannot be added, as a machine is in many of them; their
    bitmaps are united instead.
    """
    if window % step:
        raise ValueError("the window has to be a multiple of the step")
    shifts = F.sequence(*[F.lit(seconds * 1_000_000).cast("bigint") for seconds in (0, window - step, step)])
    spread = bitmaps.select("bucket", "machines", "at", F.explode(shifts).alias("_shift"))
    later = F.timestamp_micros(F.unix_micros("at") + F.col("_shift"))
    united = spread.groupBy(later.alias("at"), "bucket").agg(F.bitmap_or_agg("machines").alias("machines"))
    return united.groupBy("at").agg(F.sum(F.bitmap_count("machines")).alias("active_turbines"))
