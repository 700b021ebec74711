"""Rollups read from partial sums against the rollups of all readings."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest

from fleetpulse.operators.rollups import FIVE_MINUTES, HOURLY, build_rollup
from fleetpulse.schemas import STATUSES
from fleetpulse.sources.partial_rollups import PART_SCHEMA, PartialRollups, partial_sums

START = datetime(2024, 5, 1, 22, 0, tzinfo=timezone.utc)


def rows_of(df):
    found = sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in found]


@pytest.fixture
def batches(readings):
    """Five batches over two days, late rows among them, with missing sensors."""
    source, instants = random.Random(7), list(range(0, 240, 2))
    source.shuffle(instants)
    changes = [
        {
            "turbine_id": f"turbine-{m % 3:02d}",
            "recorded_at": START + timedelta(minutes=m, days=-300 if m == 40 else 0),
            "power_output_kw": source.random() * 1000,
            "bearing_temp_c": source.choice([None, None, 40.5]),
            "status": source.choice(STATUSES),
        }
        for m in instants
    ]
    return [readings(*changes[i : i + 24]) for i in range(0, 120, 24)]


def same(spark, parts, readings):
    for rollup in (FIVE_MINUTES, HOURLY):
        assert rows_of(parts.read(spark, rollup)) == rows_of(build_rollup(readings, rollup))


def test_parts_equal_the_whole(spark, batches, tmp_path):
    assert partial_sums(batches[0]).schema.fieldNames() == PART_SCHEMA.fieldNames()
    parts, seen = PartialRollups(str(tmp_path)), batches[0].where("false")
    same(spark, parts, seen)
    for number, batch in enumerate(batches):
        parts.add(batch, number)
        parts.add(batch, number)
        seen = seen.unionByName(batch)
        same(spark, parts, seen)
    first = START.date()
    assert {r[0] for r in parts.read(spark, HOURLY, first, first).selectExpr("to_date(bucket)").collect()} == {first}


def test_compacted_days(spark, batches, tmp_path, monkeypatch):
    """Compaction between batches, one that stops before it has removed anything, and batches that run again."""
    parts, seen, day = PartialRollups(str(tmp_path)), batches[0].where("false"), START.date()
    for number, batch in enumerate(batches):
        parts.add(batch, number)
        seen = seen.unionByName(batch)
        if number in (1, 3):
            with monkeypatch.context() as patched:
                if number == 3:
                    patched.setattr(PartialRollups, "_drop", lambda *_: None)
                parts.compact(spark, day)
            same(spark, parts, seen)
            parts.add(batch, number)
            same(spark, parts, seen)
            parts.compact(spark, day)
            same(spark, parts, seen)
    left = sorted(p.name for p in (tmp_path / "batches" / f"bucket_date={day}").iterdir() if p.is_dir())
    assert left == ["batch=4"] and not list(tmp_path.glob("staged*"))
    parts.compact(spark, datetime(1999, 1, 1).date())
    parts.compact(spark, day)
    same(spark, parts, seen)
