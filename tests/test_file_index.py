"""Ranges of columns that are no folders open few files, and miss no row."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import rates, reports
from fleetpulse.schemas import ALERT_SCHEMA, with_day
from fleetpulse.sources import file_index, tables
from fleetpulse.sources.file_index import FileIndex
from fleetpulse.streaming.process import Store

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
DAYS = 400


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def files_of(path):
    return [os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet") and "/_" not in d]


@pytest.fixture(scope="module")
def alert_store(spark, tmp_path_factory):
    """An alert a minute apart in pairs, 20 a day for 400 days; one in fifty is processed 30 days late."""
    store = Store(str(tmp_path_factory.mktemp("alerts")))
    day = F.floor(F.col("id") / 20)
    recorded = F.timestamp_micros((F.lit(int(START.timestamp())) + day * 86400 + F.floor(F.col("id") % 20 / 2) * 60) * 1_000_000)
    late = F.when(F.col("id") % 50 == 0, F.expr("INTERVAL 30 DAYS")).otherwise(F.expr("INTERVAL 5 SECONDS"))
    alerts = spark.range(20 * DAYS).select(
        F.format_string("a%06d", "id").alias("alert_id"),
        F.lit("turbine-01").alias("turbine_id"),
        recorded.alias("recorded_at"),
        F.when(F.col("id") % 400 == 7, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.lit("vibration_warning").alias("rule_name"),
        F.lit("m").alias("message"),
        F.lit("vibration_mms").alias("metric_name"),
        F.lit(7.0).alias("metric_value"),
        F.lit(6.0).alias("threshold"),
        F.lit("e").alias("source_event_id"),
        (recorded + late).alias("alert_ts"),
    )
    tables.file_by_day(alerts).repartition(2, "recorded_at").write.partitionBy("event_date").parquet(store.path("alerts"))
    assert store.index("alerts").update(spark) == len(files_of(store.path("alerts")))
    return store


def test_window_opens_the_files_it_reaches(spark, alert_store):
    as_of = START + timedelta(days=200, minutes=10)
    everything = alert_store.alerts(spark)
    window = alert_store.within(spark, "alerts", "alert_ts", as_of, 3600)
    expected = everything.where((F.col("alert_ts") >= F.lit(as_of - timedelta(hours=1))) & (F.col("alert_ts") <= F.lit(as_of)))
    assert rows_of(window) == rows_of(expected) and window.count() >= 20
    # Files of that day, and of the day 30 days before if one of its alerts was late; not of 400 days.
    assert len(window.inputFiles()) <= 20 < len(files_of(alert_store.path("alerts")))
    assert rows_of(rates.alert_rate(window, as_of, 3600)) == rows_of(rates.alert_rate(everything, as_of, 3600))
    late = as_of + timedelta(days=30, hours=-1)
    assert rows_of(rates.alert_rate(alert_store.within(spark, "alerts", "alert_ts", late, 7200), late, 7200)) == rows_of(
        rates.alert_rate(everything, late, 7200)
    )


@pytest.mark.parametrize("order, severity", [("recorded_at", None), ("recorded_at", "CRITICAL"), ("alert_ts", None)])
@pytest.mark.parametrize("n", [19, 50])
def test_newest_rows_read_few_files(spark, alert_store, n, order, severity):
    where = None if severity is None else F.col("severity") == severity
    few, everything = alert_store.newest(spark, "alerts", order, n, where), alert_store.alerts(spark)
    if order == "recorded_at":
        listed = [reports.recent_alerts(frame, n, severity).collect() for frame in (few, everything)]
    else:
        listed = [reports.recent_alerts_by_alert_ts(frame, n).collect() for frame in (few, everything)]
    assert listed[0] == listed[1] and len(listed[0]) == min(n, 20 if severity else n)
    if severity is None:
        days = {f.split("event_date=")[1][:10] for f in few.inputFiles()}
        assert len(days) <= (10 if order == "recorded_at" else 60)


def test_unknown_files_are_read(spark, alert_store, tmp_path):
    """A writer that stopped between rows and index; a file that is gone; merged parts."""
    path = str(tmp_path / "alerts")
    index = FileIndex(path, with_day(ALERT_SCHEMA), ("alert_ts",))
    assert index.window(spark, "alert_ts", START, START).count() == 0 and index.update(spark) == 0
    assert index.newest(spark, "alert_ts", 3).count() == 0
    rows = alert_store.alerts(spark)
    for n, day in enumerate(("2024-02-01", "2024-02-02", "2024-02-03")):
        rows.where(F.col("event_date") == day).coalesce(1).write.mode("append").partitionBy("event_date").parquet(path)
        if n < 2:
            assert index.update(spark) == 1
    last = datetime(2024, 2, 3, tzinfo=timezone.utc)
    assert index.window(spark, "alert_ts", last, last + timedelta(hours=1)).count() > 0
    assert index.newest(spark, "alert_ts", 5).agg(F.max("recorded_at")).first()[0] == rows.where("event_date = '2024-02-03'").agg(F.max("recorded_at")).first()[0]
    tables.drop_days(spark, path, "event_date", ["2024-02-01"])
    assert index.update(spark) == 1
    assert index.window(spark, "alert_ts").count() == rows.where("event_date in ('2024-02-02', '2024-02-03')").count()


def arriving(readings, at, n=10, first=0):
    """``n`` readings a second apart from ``at`` on, as an insert takes them."""
    frame = readings(*[{"recorded_at": at + timedelta(seconds=i)} for i in range(n)])
    return frame.withColumns(
        {
            "offset": F.expr(f"{first} + cast(substring(event_id, 2) AS bigint)"),
            "partition": F.lit(0),
            "ingested_at": F.col("recorded_at"),
        }
    )


def test_an_insert_reads_as_much_of_a_full_day_as_of_an_empty_one(spark, readings, tmp_path, monkeypatch):
    monkeypatch.setattr(file_index, "MERGE_AT", 4)
    store, opened, sizes = Store(str(tmp_path)), [], []
    read = FileIndex.read

    def counted(self, spark, paths, schema=None):
        if schema is not None and "turbine_id" in schema.fieldNames():
            opened.append(len(paths))
            sizes.append(sum(os.path.getsize(p.removeprefix("file:")) for p in paths))
        return read(self, spark, paths, schema)

    monkeypatch.setattr(FileIndex, "read", counted)
    for batch in range(14):
        # Every batch starts with the last two readings of the one before.
        store.insert_telemetry(arriving(readings, START + timedelta(seconds=8 * batch), first=10 * batch))
    assert opened[0] == 0 and set(opened[3:]) == {1} and max(sizes[9:]) <= 1.05 * max(sizes[2:5])
    assert store.telemetry(spark).count() == 14 * 8 + 2
    # Two late copies and a late new reading: the files around them, not those between.
    late = arriving(readings, START + timedelta(seconds=20), 2).unionByName(arriving(readings, START + timedelta(hours=5), 1))
    store.insert_telemetry(late)
    assert opened[-1] <= 3 and store.telemetry(spark).count() == 14 * 8 + 3
    store.insert_telemetry(late)
    assert store.telemetry(spark).count() == 14 * 8 + 3
    parts = [f for f in os.listdir(tmp_path / "telemetry" / "_files" / "event_date=2024-01-01") if f.endswith(".parquet")]
    assert len(parts) <= 5


def test_rows_without_an_offset_reach_their_whole_day(spark, tmp_path):
    from fleetpulse.schemas import DLQ_SCHEMA

    store = Store(str(tmp_path))

    def letters(*rows):
        full = [(i, "raw", 0, offset, "{", "json_decode_error", "m", START, 0, False, None, START.date()) for i, offset in rows]
        return spark.createDataFrame(full, with_day(DLQ_SCHEMA))

    store.insert_dlq(letters(("a", 5), ("b", None)))
    store.insert_dlq(letters(("b", None), ("c", 100_000), ("a", 5)))
    store.insert_dlq(letters(("a", 5), ("c", 100_000), ("d", 7)))
    assert sorted(r[0] for r in store.dlq(spark).select("dlq_id").collect()) == ["a", "b", "c", "d"]
    assert store.index("dlq").window(spark, "original_offset", 6, 200_000).count() == 2
