"""Topics kept as files: numbering, ranges, replays, bounded batches."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import CURRENT
from fleetpulse.sources.topic_files import TopicFiles, order_report
from fleetpulse.sources.versions import ConcurrentWriter
from fleetpulse.streaming.consume import TopicConsumer, shares
from fleetpulse.streaming.process import MessageProcessor, Store

ROWS = "key string, value string, n int"


def topic(tmp_path, partitions=3):
    return TopicFiles(str(tmp_path / "topic"), "raw", partitions)


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROWS)


def numbers(spark, published):
    return [tuple(r) for r in published.read(spark).orderBy("partition", "offset").select("partition", "offset").collect()]


def test_numbers_run_on_over_batches(spark, tmp_path):
    published = topic(tmp_path)
    hot = [("hot", f"h{i}", i) for i in range(300)]
    assert published.publish(rows(spark, *hot, ("b", "x", 1), (None, "loose", 0)), 0, ["n"], rows_per_file=50)
    assert published.publish(rows(spark, ("hot", "late", -1), ("c", "y", 0), (None, None, 0)), 1, ["n"])
    found = numbers(spark, published)
    for p in range(3):
        assert [o for q, o in found if q == p] == list(range(published.ends(spark)[p]))
    of_hot = published.read(spark).where("key = 'hot'").orderBy("sequence").collect()
    assert [r["value"] for r in of_hot] == [f"h{i}" for i in range(300)] + ["late"]
    assert [r["sequence"] for r in of_hot] == list(range(301))
    assert [r["offset"] for r in of_hot] == sorted(r["offset"] for r in of_hot)
    assert {r["sequence"] for r in published.read(spark).where("key is null").collect()} == {None}
    report = {r["key"]: tuple(r)[1:] for r in order_report(published.read(spark)).collect()}
    assert report == {"hot": (301, 0, 0, 0), "b": (1, 0, 0, 0), "c": (1, 0, 0, 0)}


def test_report_sees_gaps_copies_and_disorder(spark):
    messages = spark.createDataFrame(
        [("a", 0, 5), ("a", 1, 4), ("a", 3, 6), ("b", 0, 1), ("b", 0, 1)], "key string, sequence long, offset long"
    )
    report = {r["key"]: tuple(r)[1:] for r in order_report(messages).collect()}
    assert report == {"a": (3, 1, 0, 1), "b": (2, 0, 1, 0)}


def test_empty_topic_and_batch(spark, tmp_path):
    published = topic(tmp_path)
    assert published.read(spark).count() == 0 and published.ends(spark) == {0: 0, 1: 0, 2: 0}
    published.publish(spark.createDataFrame([], ROWS), 0)
    assert published.read(spark, {0: (0, 5)}).count() == 0
    assert TopicConsumer(published, str(tmp_path / "progress")).drain(spark, lambda *_: None) == 0


def test_batch_is_published_once_and_by_one(spark, tmp_path, monkeypatch):
    published = topic(tmp_path)
    batch = rows(spark, ("a", "x", 0), ("b", "y", 1))
    assert published.publish(batch, 0)
    assert not published.publish(batch, 0)
    assert published.read(spark).count() == 2

    # A publisher lost before the entry leaves nothing to see.
    replace = type(published.state).replace
    monkeypatch.setattr(type(published.state), "replace", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        published.publish(batch, 1)
    assert published.read(spark).count() == 2
    monkeypatch.setattr(type(published.state), "replace", replace)

    # Another one enters its batch while this one writes.
    def overtaken(state, changed, based_on):
        monkeypatch.setattr(type(published.state), "replace", replace)
        published.publish(batch, 2)
        return replace(state, changed, based_on)

    monkeypatch.setattr(type(published.state), "replace", overtaken)
    with pytest.raises(ConcurrentWriter):
        published.publish(batch, 1)
    assert published.read(spark).count() == 4


def test_range_opens_only_the_batches_it_reaches(spark, tmp_path):
    published = topic(tmp_path, 1)
    for n in range(4):
        published.publish(rows(spark, *[("a", f"{n}-{i}", i) for i in range(10)]), n, ["n"])
    part = published.read(spark, {0: (12, 18)})
    assert [r["value"] for r in part.orderBy("offset").collect()] == [f"1-{i}" for i in range(2, 8)]
    assert {f.split("/")[-2][:16] for f in part.inputFiles()} == {"batch-0000000001"}


def test_shares():
    assert shares({0: 5, 1: 100, 2: 0}, 20) == {0: 5, 1: 15, 2: 0}
    assert shares({0: 1, 1: 1}, 9) == {0: 1, 1: 1}
    assert sum(shares({p: 50 for p in range(7)}, 100).values()) == 100


def test_lost_reader_reads_each_message_once(spark, tmp_path):
    published = topic(tmp_path)
    payloads = [
        ("m", json.dumps(CURRENT | {"recorded_at": f"2025-03-02T08:15:{s:02d}+00:00", "turbine_id": f"turbine-{s % 5}"}), s)
        for s in range(40)
    ]
    keyed = rows(spark, *[(f"k{n % 5}", v, n) for _, v, n in payloads], (None, "[1]", 0))
    published.publish(keyed.withColumn("timestamp", F.timestamp_seconds(F.lit(1740900000))), 0, ["n"])
    store = Store(str(tmp_path / "tables"))
    stored, seen = MessageProcessor(store, clock=lambda: F.col("timestamp")), []

    def fails_after_writing(messages, batch):
        stored(messages, batch)
        raise RuntimeError("lost")

    def write(messages, batch):
        seen.append((batch, messages.count()))
        stored(messages, batch)

    consumer = TopicConsumer(published, str(tmp_path / "progress"), max_rows=15)
    with pytest.raises(RuntimeError):
        consumer.step(spark, fails_after_writing)
    assert consumer.waiting(spark) == 41
    again = TopicConsumer(published, str(tmp_path / "progress"), max_rows=15)
    assert again.drain(spark, write) == 3
    assert seen == [(0, 15), (1, 15), (2, 11)]
    assert again.drain(spark, write) == 0 and again.waiting(spark) == 0
    assert store.telemetry(spark).count() == 40 and store.telemetry(spark).distinct().count() == 40
    assert store.dlq(spark).count() == 1


def test_flush_by_rows_or_time(spark, tmp_path):
    published = topic(tmp_path)
    published.publish(rows(spark, *[("a", str(i), i) for i in range(130)]), 0, ["n"])
    now, sizes = [0.0], []
    consumer = TopicConsumer(published, str(tmp_path / "progress"))

    def wait(seconds):
        now[0] += seconds

    consumer.follow(
        spark, lambda m, b: sizes.append((m.count(), now[0])), lambda: len(sizes) == 2, clock=lambda: now[0], sleep=wait
    )
    assert sizes[0] == (100, 0.0)
    assert sizes[1][0] == 30 and 2.0 <= sizes[1][1] < 2.2
