"""Merged summaries against what they stand for."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.sketches import (
    RANK_ERROR,
    active_machines,
    active_machines_series,
    latency_sketches,
    machine_bitmaps,
    machine_numbers,
    rank_errors,
    sketched_quantiles,
)

START = datetime(2025, 3, 2, tzinfo=timezone.utc)
QUANTILES = (0.5, 0.95, 0.99)


@pytest.fixture(scope="module")
def readings(spark):
    """Twenty thousand readings over a day, a third of one machine, with ties and long delays."""
    source, rows = random.Random(8), []
    for _ in range(20_000):
        machine = "m-0" if source.random() < 0.33 else f"m-{source.randrange(1, 40)}"
        delay = source.choice([0.5, 1.0, source.expovariate(0.2), source.uniform(0, 3000)])
        at = START + timedelta(seconds=source.randrange(86_400))
        rows.append((machine, at - timedelta(seconds=delay), at))
    return spark.createDataFrame(rows, "turbine_id string, recorded_at timestamp, producer_ts timestamp").persist()


def test_merged_sketches_keep_their_rank_error(readings):
    sketches = latency_sketches(readings, 600)
    lag = (F.unix_micros("producer_ts") - F.unix_micros("recorded_at")) / F.lit(1e6)
    timed = readings.select("turbine_id", lag.alias("latency_s"))
    for keys in (["turbine_id"], []):
        found = sketched_quantiles(sketches, QUANTILES, keys)
        keyed = found if keys else found.withColumn("one", F.lit(1))
        values = timed if keys else timed.withColumn("one", F.lit(1))
        rows = rank_errors(values, "latency_s", keyed, QUANTILES, keys or ["one"]).collect()
        assert len(rows) == (40 if keys else 1)
        assert all(r["rank_error"] <= RANK_ERROR for r in rows)
        assert sum(r["sample_count"] for r in rows) == 20_000 == found.agg(F.sum("sample_count")).first()[0]


def test_window_of_sketches(readings):
    sketches = latency_sketches(readings, 600)
    end = START + timedelta(hours=6)
    expected = readings.where((F.col("producer_ts") > F.lit(end - timedelta(hours=1))) & (F.col("producer_ts") <= F.lit(end)))
    assert sketched_quantiles(sketches, as_of=end, window=3600).first()["sample_count"] == expected.count()
    assert sketched_quantiles(sketches.limit(0)).count() == 0


def test_distinct_machines_of_every_window(readings):
    few = readings.sample(0.004, 5)
    bitmaps = machine_bitmaps(few, machine_numbers(few), 600)
    rows = [(r["turbine_id"], r["producer_ts"].astimezone(timezone.utc)) for r in few.collect()]
    found = {r["at"].astimezone(timezone.utc): r["active_turbines"] for r in active_machines_series(bitmaps, 600, 3600).collect()}
    expected = {}
    for i in range(1, 24 * 6 + 7):
        at = START + timedelta(seconds=600 * i)
        seen = {m for m, t in rows if at - timedelta(seconds=3600) < t <= at}
        if seen:
            expected[at] = len(seen)
    found.pop(START, None)
    assert found == expected
    for at in list(expected)[::20]:
        assert active_machines(bitmaps, at, 3600).first()[0] == expected[at]
    assert active_machines(bitmaps, START - timedelta(days=9), 3600).first()[0] == 0


def test_a_fleet_of_several_bitmaps(spark):
    fleet = spark.range(70_000).selectExpr(
        "concat('m', id) AS turbine_id", "timestamp_seconds(1740873600 + id % 7 * 60 + 1) AS producer_ts"
    )
    bitmaps = machine_bitmaps(fleet.union(fleet), machine_numbers(fleet), 60)
    assert bitmaps.select("bucket").distinct().count() == 3
    counts = [r["active_turbines"] for r in active_machines_series(bitmaps, 60, 420).orderBy("at").collect()]
    assert counts[:7] == [10_000 * i for i in range(1, 8)] and counts[-1] == 10_000
