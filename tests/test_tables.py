from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.dedup import dedup_readings
from fleetpulse.operators.rollups import FIVE_MINUTES, HOURLY, build_rollup, refresh_rollup
from fleetpulse.plans import event_feed
from fleetpulse.schemas import TELEMETRY_SCHEMA, with_day
from fleetpulse.sources import tables
from fleetpulse.sources.rollup_tables import refresh_stored_rollup, rollup_schema, store_rollup
from fleetpulse.streaming.process import Store

TELEMETRY = with_day(TELEMETRY_SCHEMA)


def at(day, hour=0, minute=0):
    return datetime(2024, 6, day, hour, minute, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def telemetry(spark, sf_dir):
    rows = dedup_readings(event_feed.readings(spark, sf_dir), ("seq",)).select(*TELEMETRY_SCHEMA.fieldNames())
    return rows.persist()


@pytest.fixture
def filed(telemetry, tmp_path):
    path = str(tmp_path / "telemetry")
    tables.file_by_day(telemetry).coalesce(1).write.partitionBy("event_date").parquet(path)
    return path


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_dedup_keeps_the_first_arrival(readings):
    same = {"recorded_at": at(1)}
    frame = readings(same | {"power_output_kw": 1.0}, same | {"power_output_kw": 2.0}, {"recorded_at": at(2)})
    frame = frame.withColumns({"offset": F.expr("10 - cast(substring(event_id, 2) AS bigint)"), "partition": F.lit(0)})
    kept = dedup_readings(frame)
    assert sorted(r["event_id"] for r in kept.collect()) == ["e1", "e2"]
    assert rows_of(dedup_readings(kept)) == rows_of(kept)


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    plan = dedup_readings(event_feed.readings(spark, sf_dir), ("seq",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan


def test_insert_if_absent(spark, readings, tmp_path):
    store = Store(str(tmp_path))

    def arrive(*changes, first_offset=0):
        frame = readings(*changes)
        return frame.withColumns(
            {
                "offset": F.expr(f"cast(substring(event_id, 2) AS bigint) + {first_offset}"),
                "partition": F.lit(0),
                "ingested_at": F.col("producer_ts"),
            }
        )

    assert store.telemetry(spark).count() == 0
    first = arrive({"recorded_at": at(1)}, {"recorded_at": at(2)}, {"recorded_at": at(2), "power_output_kw": 9.0})
    store.insert_telemetry(first)
    store.insert_telemetry(first)
    late = arrive({"recorded_at": at(1), "power_output_kw": 7.0}, {"recorded_at": at(3)}, first_offset=10)
    store.insert_telemetry(late)
    stored = {r["recorded_at"].day: r["power_output_kw"] for r in store.telemetry(spark).collect()}
    assert stored == {1: 812.5, 2: 812.5, 3: 812.5}
    assert store.telemetry(spark).count() == 3


def test_insert_of_nothing(spark, readings, tmp_path):
    store = Store(str(tmp_path))
    nothing = readings({}).where("false").withColumns(
        {"offset": F.lit(0), "partition": F.lit(0), "ingested_at": F.col("producer_ts")}
    )
    store.insert_telemetry(nothing)
    assert store.telemetry(spark).count() == 0


def test_retention_on_disk_matches_the_operator(spark, filed):
    as_of = datetime(2024, 1, 30, 23, 0, tzinfo=timezone.utc)
    before = spark.read.schema(TELEMETRY).parquet(filed)
    expected = tables.retain(before, as_of, 7).count()
    gone = tables.drop_expired_days(spark, filed, as_of, 7)
    after = spark.read.schema(TELEMETRY).parquet(filed)
    assert after.count() == expected
    assert gone and max(gone) == date(2024, 1, 22)
    assert after.agg(F.min("event_date")).first()[0] == date(2024, 1, 23)


@pytest.mark.parametrize("in_place", [True, False])
def test_compaction_keeps_rows_and_orders_files(spark, filed, tmp_path, in_place):
    as_of = datetime(2024, 1, 30, 23, 0, tzinfo=timezone.utc)
    before = rows_of(spark.read.schema(TELEMETRY).parquet(filed))
    target = filed if in_place else str(tmp_path / "compacted")
    tables.compact(spark, filed, target, TELEMETRY, as_of, after_days=7, file_bytes=20_000)
    after = spark.read.schema(TELEMETRY).parquet(target)
    old = [row for row in before if date(2024, 1, 23) > row[TELEMETRY_ORDER.index("event_date")]]
    assert rows_of(after) == (before if in_place else sorted(old, key=repr))
    folder = f"{target}/event_date=2024-01-03"
    day_files = [f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet")]
    assert day_files and all("zstd" in f for f in day_files)
    for file in day_files:
        rows = spark.read.parquet(file).select("turbine_id", "recorded_at").collect()
        assert rows == sorted(rows, key=lambda r: (r[0], -r[1].timestamp()))


def files_of(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_compaction_rewrites_a_day_once(spark, filed, readings):
    as_of = datetime(2024, 1, 30, 23, 0, tzinfo=timezone.utc)
    tables.compact(spark, filed, filed, TELEMETRY, as_of)
    once = files_of(filed)
    tables.compact(spark, filed, filed, TELEMETRY, as_of)
    assert files_of(filed) == once
    late = readings({"recorded_at": datetime(2024, 1, 3, 5, 0, tzinfo=timezone.utc)}).withColumn("ingested_at", F.col("producer_ts"))
    tables.insert_if_absent(tables.file_by_day(late), filed, ["turbine_id", "recorded_at"], ["producer_ts"], TELEMETRY_SCHEMA.fieldNames())
    tables.compact(spark, filed, filed, TELEMETRY, as_of)
    changed = {f for f in files_of(filed) ^ once}
    assert changed and all("event_date=2024-01-03" in f for f in changed)
    assert all("zstd" in f for f in files_of(f"{filed}/event_date=2024-01-03"))


def test_fleet_snapshot_opens_only_its_days(spark, filed):
    from fleetpulse.operators.reports import fleet_snapshot

    alerts = spark.createDataFrame([], "alert_ts timestamp, severity string")
    table = spark.read.schema(TELEMETRY).parquet(filed)
    plan = fleet_snapshot(table, alerts, datetime(2024, 1, 5, tzinfo=timezone.utc))._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_refresh_removes_emptied_days(spark, telemetry, tmp_path):
    """Readings of two days are gone: their buckets go with the refresh, and so do the folders."""
    path = str(tmp_path / "rollup")
    as_of = telemetry.agg(F.max("recorded_at")).first()[0]
    store_rollup(telemetry, HOURLY, path)
    left = telemetry.where(F.col("recorded_at") < as_of - timedelta(days=4))
    refresh_stored_rollup(left, HOURLY, path, as_of + timedelta(days=1), start_offset=4 * 86400, end_offset=0)
    stored = tables.read_table(spark, path, rollup_schema(spark, HOURLY)).drop("bucket_date")
    expected = refresh_rollup(left, build_rollup(telemetry, HOURLY), HOURLY, F.lit(as_of + timedelta(days=1)), 4 * 86400, 0)
    assert rows_of(stored.select(expected.columns)) == rows_of(expected)
    days = tables.stored_days(spark, path, "bucket_date")
    assert days == sorted(r[0] for r in stored.select(F.to_date("bucket")).distinct().collect())


TELEMETRY_ORDER = sorted(TELEMETRY.fieldNames())


def test_storage_report_reads_no_data(spark, filed):
    report = tables.storage_report(spark, filed, limit=3).collect()
    assert [r["range_start"].day for r in report] == [30, 29, 28]
    newest = report[0]
    folder = f"{filed}/event_date=2024-01-30"
    sizes = [os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.endswith(".parquet")]
    assert newest["bytes"] == sum(sizes) and newest["files"] == len(sizes)


def test_time_range_prunes_days(spark, filed):
    from fleetpulse.functions.times import time_range

    table = spark.read.schema(TELEMETRY).parquet(filed)
    some = time_range(table, "2024-01-05 12:00:00", "2024-01-06 06:00:00")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    whole = table.where("recorded_at >= '2024-01-05 12:00:00' AND recorded_at < '2024-01-06 06:00:00'")
    assert rows_of(some) == rows_of(whole)
    assert {f.split("event_date=")[1][:10] for f in some.inputFiles()} >= {"2024-01-05", "2024-01-06"}


def test_rollup_buckets_and_nulls(readings):
    frame = readings(
        {"recorded_at": at(1, 0, 0), "power_output_kw": 10.0, "bearing_temp_c": 40.0},
        {"recorded_at": at(1, 0, 4), "power_output_kw": 20.0},
        {"recorded_at": at(1, 0, 5), "power_output_kw": 40.0, "status": "fault"},
    )
    five = build_rollup(frame, FIVE_MINUTES).orderBy("bucket").collect()
    assert [(r["bucket"].minute, r["sample_count"], r["avg_power_kw"]) for r in five] == [(0, 2, 15.0), (5, 1, 40.0)]
    assert five[0]["avg_bearing_temp_c"] == 40.0 and five[1]["avg_bearing_temp_c"] is None
    (hour,) = build_rollup(frame, HOURLY).collect()
    assert (hour["sample_count"], hour["non_online_count"], hour["min_power_kw"]) == (3, 1, 10.0)


def test_refresh_covers_whole_buckets_only(spark, readings):
    rollup = FIVE_MINUTES
    minutes = range(0, 60)
    old = build_rollup(readings(*[{"recorded_at": at(1, 0, m), "power_output_kw": 1.0} for m in minutes]), rollup)
    now = readings(*[{"recorded_at": at(1, 0, m), "power_output_kw": 2.0} for m in minutes])
    fresh = refresh_rollup(now, old, rollup, as_of=at(1, 0, 48) + timedelta(seconds=30))
    changed = [r["bucket"].minute for r in fresh.where("avg_power_kw = 2").orderBy("bucket").collect()]
    # [18:30, 47:30] holds the buckets 20..40 in full, 15 and 45 only in part.
    assert changed == [20, 25, 30, 35, 40]
    assert fresh.count() == 12


def test_stored_rollup_refresh(spark, telemetry, tmp_path):
    path = str(tmp_path / "rollup")
    as_of = telemetry.agg(F.max("recorded_at")).first()[0]
    early = telemetry.where(F.col("recorded_at") < as_of - timedelta(days=2))
    store_rollup(early, HOURLY, path)
    refresh_stored_rollup(telemetry, HOURLY, path, as_of, start_offset=3 * 86400, end_offset=600)
    stored = tables.read_table(spark, path, rollup_schema(spark, HOURLY)).drop("bucket_date")
    expected = refresh_rollup(telemetry, build_rollup(early, HOURLY), HOURLY, F.lit(as_of), 3 * 86400, 600)
    assert rows_of(stored.select(expected.columns)) == rows_of(expected)
    refresh_stored_rollup(telemetry, HOURLY, path, as_of, start_offset=3 * 86400, end_offset=600)
    again = tables.read_table(spark, path, rollup_schema(spark, HOURLY)).drop("bucket_date")
    assert rows_of(again.select(expected.columns)) == rows_of(expected)
