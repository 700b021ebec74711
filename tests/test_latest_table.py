"""The merged table of newest readings against a scan, and the versions it is kept in."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.status import latest_status, thermal_health
from fleetpulse.schemas import STATUSES
from fleetpulse.sources.latest_table import LatestTable
from fleetpulse.sources.versions import KEPT, ConcurrentWriter, VersionedTable

START = datetime(2024, 5, 1, tzinfo=timezone.utc)


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_merge_equals_a_scan(spark, readings, tmp_path):
    """Shuffled, repeated and late batches, machines that come later, missing bearing temperatures."""
    source, changes = random.Random(4), []
    for machine in range(6):
        for minute in source.sample(range(400), 30):
            bearing = source.choice([None, 30.0, 64.9, 65.1])
            changes.append(
                {
                    "turbine_id": f"turbine-{machine:02d}",
                    "recorded_at": START + timedelta(minutes=minute),
                    "bearing_temp_c": None if machine == 5 else bearing,
                    "power_output_kw": float(minute),
                    "status": source.choice(STATUSES),
                }
            )
    source.shuffle(changes)
    latest, seen = LatestTable(str(tmp_path / "latest")), []
    assert latest.latest_status(spark).count() == 0
    batches = [changes[i : i + 45] for i in range(0, len(changes), 45)]
    for batch in [*batches, batches[0], [], batches[2]]:
        seen += batch
        latest.merge(readings(*batch) if batch else readings({}).where("false"))
        history = readings(*seen).dropDuplicates(["turbine_id", "recorded_at"])
        assert rows_of(latest.latest_status(spark)) == rows_of(latest_status(history))
        assert rows_of(latest.thermal_health(spark)) == rows_of(thermal_health(history))
    assert latest.table.read(spark).count() == 6 + 5


def test_a_writer_that_stops_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = VersionedTable(str(tmp_path / "t"), spark.range(1).schema)
    assert table.version(spark) == 0 and table.read(spark).count() == 0
    assert table.replace(spark.range(3), 0) == 1

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_enter", lost)
        with pytest.raises(RuntimeError):
            table.replace(spark.range(9), 1)
    assert table.version(spark) == 1 and table.read(spark).count() == 3
    assert table.replace(table.read(spark).withColumn("id", F.col("id") + 1), 1) == 2
    assert sorted(r[0] for r in table.read(spark).collect()) == [1, 2, 3]


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    table = VersionedTable(str(tmp_path / "t"), spark.range(1).schema)
    table.replace(spark.range(3), 0)
    table.replace(spark.range(4), 1)
    with pytest.raises(ConcurrentWriter):
        table.replace(spark.range(9), 1)
    # Both writers have looked before either has entered its version: the rename decides.
    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "version", lambda *_: 1)
        with pytest.raises(ConcurrentWriter):
            table.replace(spark.range(9), 1)
    assert table.read(spark).count() == 4


def test_old_versions_go(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), spark.range(1).schema)
    for n in range(6):
        table.replace(spark.range(n), n)
    assert table.version(spark) == 6 and table.read(spark).count() == 5
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == KEPT
