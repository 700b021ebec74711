"""How often the rows of a job are computed: work that repeats per action grows with the number of actions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from fleetpulse.operators.rules import detect
from fleetpulse.operators.validate import check_messages, rejected
from fleetpulse.plans import event_feed as feed
from fleetpulse.plans import queries
from fleetpulse.sources.messages import alert_messages, alerts_from_messages
from fleetpulse.sources.topic_files import TopicFiles
from fleetpulse.streaming import process
from fleetpulse.streaming.consume import TopicConsumer
from fleetpulse.streaming.process import MessageProcessor, Store


def counted(df, counter):
    """The same rows; every row that is computed is added to the counter."""

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def hot(readings, day: int, minutes: int):
    start = datetime(2025, 3, day, 8, tzinfo=timezone.utc)
    changes = [
        {"event_id": f"e{day}-{m}", "recorded_at": start + timedelta(minutes=m), "producer_ts": start + timedelta(minutes=m), "temperature_c": 96.0}
        for m in range(minutes)
    ]
    return readings(*changes)


def test_first_batch_of_a_table_is_computed_once_and_a_later_one_twice(spark, readings, tmp_path):
    store, first, second = Store(str(tmp_path)), spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    batch = detect(hot(readings, 2, 30), alert_ts=F.col("producer_ts"))
    store.insert_alerts(counted(batch, first))
    assert first.value == 60
    more = batch.union(detect(hot(readings, 3, 10), alert_ts=F.col("producer_ts")))
    store.insert_alerts(counted(more, second))
    assert second.value == 2 * 80
    stored = store.alerts(spark)
    assert stored.count() == stored.select("alert_id").distinct().count() == 80


def test_batch_without_rows_leaves_a_new_table_empty(spark, readings, tmp_path):
    store = Store(str(tmp_path))
    batch = detect(hot(readings, 2, 3), alert_ts=F.col("producer_ts"))
    store.insert_alerts(batch.where("false"))
    assert store.alerts(spark).isEmpty()
    for _ in range(2):
        store.insert_alerts(batch)
        store.insert_alerts(batch.where("false"))
    assert store.alerts(spark).count() == 6


def test_stored_alerts_read_the_feed_for_bounds_and_twice_per_batch(spark, sf_dir, tmp_path, monkeypatch):
    counter, plain = spark.sparkContext.accumulator(0), feed.readings
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(feed, "readings", lambda *where: counted(plain(*where), counter))
    stored = queries._stored_alerts(spark, sf_dir).alerts(spark).count()
    assert counter.value <= 8 * plain(spark, sf_dir).count()
    monkeypatch.undo()
    assert stored == queries.alerts(spark, sf_dir).count()


def test_main_stream_works_out_alerts_and_dead_letters_of_a_first_batch_once(spark, sf_dir, tmp_path, monkeypatch):
    hits, bad = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    monkeypatch.setattr(process, "detect", lambda *a: counted(detect(*a), hits))
    monkeypatch.setattr(process, "rejected", lambda *a, **k: counted(rejected(*a, **k), bad))
    store = Store(str(tmp_path))
    MessageProcessor(store, clock=lambda: F.col("timestamp"))(feed.messages(spark, sf_dir), 0)
    assert hits.value == store.alerts(spark).count() > 0
    assert bad.value == store.dlq(spark).count() > 0


def test_stored_dead_letters_are_checked_once(spark, sf_dir, tmp_path, monkeypatch):
    counter = spark.sparkContext.accumulator(0)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(queries, "check_messages", lambda messages: check_messages(counted(messages, counter)))
    assert queries._stored_dlq(spark, sf_dir).dlq(spark).count() > 0
    assert counter.value == feed.readings(spark, sf_dir).count()


def test_batch_metrics_make_each_payload_once(spark, sf_dir, tmp_path, monkeypatch):
    counter, plain = spark.sparkContext.accumulator(0), feed.messages_of
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(feed, "messages_of", lambda readings, *keep: plain(counted(readings, counter), *keep))
    assert queries.batch_metrics(spark, sf_dir).count() == 4
    assert counter.value == feed.readings(spark, sf_dir).count()


def test_alert_messages_are_written_and_parsed_once(readings):
    alerts = detect(hot(readings, 2, 3), alert_ts=F.col("producer_ts"))
    back = alerts_from_messages(alert_messages(alerts))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == plan.count("StructsToJson") == 1
    assert sorted(back.collect()) == sorted(alerts.collect())


def test_batch_of_a_topic_is_spread_over_tasks(spark, tmp_path):
    topic = TopicFiles(f"{tmp_path}/topic")
    sent = spark.range(400).selectExpr("'m' AS key", "cast(id AS string) AS value", "id").coalesce(1)
    topic.publish(sent, 0, ["id"])
    tasks, offsets = [], []

    def write(rows, batch):
        found = rows.select("offset", F.spark_partition_id().alias("task")).collect()
        tasks.append(len({r["task"] for r in found}))
        offsets.extend(r["offset"] for r in found)

    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "1b")
    try:
        TopicConsumer(topic, f"{tmp_path}/progress", max_rows=200).drain(spark, write)
    finally:
        spark.conf.unset(least)
    assert min(tasks) > 1 and sorted(offsets) == list(range(400))


def test_consumed_copies_of_an_event_stay_as_many(spark, sf_dir, tmp_path, monkeypatch):
    plain, ends = feed.readings, []
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(feed, "readings", lambda *where: plain(*where).limit(50).union(plain(*where).limit(50)))
    publish = TopicFiles.publish
    monkeypatch.setattr(TopicFiles, "publish", lambda self, rows, *a: ends.append(rows.count()) or publish(self, rows, *a))
    queries._consumed(spark, sf_dir)
    assert ends == [100]


def tasks_of(df) -> int:
    return df.select(F.spark_partition_id()).distinct().count()


def test_messages_of_a_table_of_one_row_group_are_made_in_many_tasks(spark, sf_dir):
    assert tasks_of(feed.events(spark, sf_dir)) == 1
    assert tasks_of(feed.messages(spark, sf_dir)) > 8


def test_main_stream_checks_messages_of_one_row_group_in_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    tasks = []
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(MessageProcessor, "store_checked", lambda self, checked, batch: tasks.append(tasks_of(checked)))
    queries._processed(spark, sf_dir)
    assert min(tasks) > 8
