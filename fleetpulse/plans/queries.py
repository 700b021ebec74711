"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.text import message_id
from fleetpulse.functions.times import seconds_before
from fleetpulse.operators import dlq as letters
from fleetpulse.operators import rates, reports, sketches, status
from fleetpulse.operators.dedup import READING_KEY, dedup_readings
from fleetpulse.operators.rollups import FIVE_MINUTES, HOURLY, build_rollup, refresh_rollup, rollup_coverage
from fleetpulse.operators.rules import RULES, Rule, any_hit, detect
from fleetpulse.operators.validate import accepted, check_messages, ingest_summary, rejected
from fleetpulse.plans import event_feed as feed
from fleetpulse.plans.maintenance import replay_stored_dlq
from fleetpulse.schemas import JSON_ERROR, NUMERIC_BOUNDS, READING_COLUMNS, SCHEMA_ERROR, TELEMETRY_SCHEMA, with_day
from fleetpulse.session import scratch_folder
from fleetpulse.sources import extracts, logs, tables
from fleetpulse.sources.latest_table import LatestTable
from fleetpulse.sources.messages import (
    JSON_OPTIONS,
    alert_messages,
    alerts_from_messages,
    dlq_from_messages,
    dlq_messages,
    reading_messages,
)
from fleetpulse.sources.partial_rollups import PartialRollups
from fleetpulse.sources.rollup_tables import refresh_stored_rollup, rollup_schema, store_rollup
from fleetpulse.sources.topic_files import TopicFiles, order_report
from fleetpulse.streaming.consume import TopicConsumer
from fleetpulse.streaming.process import MessageProcessor, Store, process_stream
from fleetpulse.streaming.windows import (
    dedup_stream,
    latest_stream,
    partial_rollup_stream,
    rollup_stream,
    stream_telemetry,
)

Query = Callable[[SparkSession, str], DataFrame]

DAY = 86400
TELEMETRY_COLUMNS = TELEMETRY_SCHEMA.fieldNames()
# Fine enough that no average of up to 64 values with three decimals is a tie.
AVERAGE_DIGITS = 9


# --- inputs ------------------------------------------------------------------


def latest_event(spark: SparkSession, folder: str) -> Column:
    """``as_of``: the newest event, as a subquery evaluated once."""
    return feed.events(spark, folder).select(F.max(F.col("ts").cast("timestamp"))).scalar()


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of every reading, copies included, stamped with the publish time."""
    return detect(feed.readings(spark, folder), alert_ts=F.col("producer_ts"))


def stored(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Readings as the telemetry table holds them, or some columns of them.

    Deduplication carries whole rows, so columns are cut before it, not after.
    """
    arriving = feed.readings(spark, folder)
    if columns:
        arriving = arriving.select("turbine_id", "recorded_at", "seq", *columns)
    return dedup_readings(arriving, ("seq",))


def checked(spark: SparkSession, folder: str) -> DataFrame:
    return check_messages(feed.messages(spark, folder))


def dlq(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(checked(spark, folder), F.col("timestamp"))


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, and averages without the noise of the summing order or a signed zero."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if f.dataType == T.TimestampType():
            column = column.cast("timestamp_ntz")
        elif f.name.startswith("avg_"):
            column = F.round(column, AVERAGE_DIGITS) + F.lit(0.0)
        columns.append(column.alias(f.name))
    return df.select(*columns)


# --- decode, rules, dedup ------------------------------------------------------


def alerts_by_rule_severity(spark, folder):
    return reports.alerts_by_rule(alerts(spark, folder))


def alerts_detail(spark, folder):
    return comparable(alerts(spark, folder))


def _one_rule(rule: Rule) -> Query:
    def query(spark, folder):
        hits = detect(feed.readings(spark, folder), [rule], F.col("producer_ts"))
        return comparable(
            hits.select("turbine_id", "recorded_at", "message", "metric_value", "threshold", "source_event_id")
        )

    return query


def normalised_telemetry(spark, folder):
    return comparable(accepted(checked(spark, folder)))


def with_payload(rows: DataFrame, column: str = "raw_payload") -> DataFrame:
    """The raw text by what can be told of it in SQL: itself where it is fixed, else the machine it names."""
    raw = F.col(column)
    named = F.regexp_extract(raw, '"(?:turbine_id|Turbine_ID)":"([^"]+)"', 1)
    return rows.withColumn("payload", F.when(raw.isin(*feed.FIXED_PAYLOADS), raw).otherwise(named)).drop(column)


def dlq_rows(spark, folder):
    rows = dlq(spark, folder)
    return comparable(with_payload(rows))


def decode_error_counts(spark, folder):
    return letters.error_counts(dlq(spark, folder))


def validation_failures(spark, folder):
    return rates.failure_counts(dlq(spark, folder))


def dlq_watch(spark, folder):
    watched = letters.watch(dlq(spark, folder)).withColumn("preview_length", F.length("payload_preview"))
    return comparable(with_payload(watched, "payload_preview"))


def variant_telemetry(spark, folder):
    """Readings whose numbers came as text and whose machine ids came amid blanks."""
    return comparable(accepted(check_messages(feed.variants_of(feed.readings(spark, folder)))))


def variant_dlq(spark, folder):
    """Messages refused for a machine id that is blank or too long, or for a number that is none."""
    refused = rejected(check_messages(feed.variants_of(feed.readings(spark, folder))), F.col("timestamp"))
    return comparable(refused.drop("raw_payload"))


def log_lines(spark, folder):
    """The raw messages written as log files with a blank line every 25 rows, and read back."""
    path = scratch_folder(spark, "log")
    blank_after = F.when(F.col("offset") % 25 == 0, F.array("value", F.lit(""))).otherwise(F.array("value"))
    feed.messages(spark, folder).select(F.explode(blank_after).alias("value")).write.text(path)
    return logs.read_log(spark, path)


def log_ingest_summary(spark, folder):
    return ingest_summary(check_messages(log_lines(spark, folder)))


def log_telemetry(spark, folder):
    """Readings of the log files; ids of lines without one depend on the file, so they are left out."""
    good = accepted(check_messages(logs.skip_blank(log_lines(spark, folder))))
    return comparable(good.drop("event_id", "producer_ts"))


def dedup_telemetry(spark, folder):
    return comparable(stored(spark, folder).select(*TELEMETRY_COLUMNS))


# --- messages, extracts, tables ------------------------------------------------


def reading_round_trip(spark, folder):
    """Readings to keyed JSON messages and back through the decode chain."""
    sent = reading_messages(feed.readings(spark, folder).select(*READING_COLUMNS))
    received = sent.select(
        F.lit("raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        "value",
    )
    return comparable(accepted(check_messages(received)))


def alert_round_trip(spark, folder):
    return comparable(alerts_from_messages(alert_messages(alerts(spark, folder))))


def dlq_round_trip(spark, folder):
    return comparable(with_payload(dlq_from_messages(dlq_messages(dlq(spark, folder)))))


def alerts_csv(spark, folder):
    path = scratch_folder(spark, "csv")
    extracts.write_csv(alerts(spark, folder), path)
    return comparable(extracts.read_alerts_csv(spark, path))


def telemetry_csv(spark, folder):
    path = scratch_folder(spark, "csv")
    extracts.write_csv(stored(spark, folder).select(*TELEMETRY_COLUMNS), path)
    return comparable(extracts.read_telemetry_csv(spark, path))


def telemetry_inserted_twice(spark, folder):
    """Every reading inserted, then all of them again: the second run adds nothing."""
    store = Store(scratch_folder(spark, "store"))
    arriving = feed.readings(spark, folder).withColumns({"offset": F.col("seq"), "partition": F.lit(0)})
    store.insert_telemetry(arriving)
    store.insert_telemetry(arriving)
    return comparable(store.telemetry(spark).select(*TELEMETRY_COLUMNS))


def _filed_telemetry(spark, folder) -> str:
    path = scratch_folder(spark, "telemetry")
    rows = tables.file_by_day(stored(spark, folder).select(*TELEMETRY_COLUMNS))
    tables.spread_by_day(rows, tables.EVENT_DAY).write.partitionBy(tables.EVENT_DAY).parquet(path)
    return path


def compact(spark, folder):
    """Days older than a week rewritten in order; read back from the new files."""
    source, target = _filed_telemetry(spark, folder), scratch_folder(spark, "compacted")
    schema = with_day(TELEMETRY_SCHEMA)
    tables.compact(spark, source, target, schema, latest_event(spark, folder), after_days=7)
    return comparable(spark.read.schema(schema).parquet(target))


def partition_report(spark, folder):
    return comparable(reports.partition_report(stored(spark, folder, "event_id")))


def storage_report(spark, folder):
    report = tables.storage_report(spark, _filed_telemetry(spark, folder))
    return comparable(report.select("range_start", "range_end", (F.col("bytes") > 0).alias("has_data")))


def retention_7d(spark, folder):
    kept = tables.retain(stored(spark, folder, "event_id"), latest_event(spark, folder), keep_days=7)
    return comparable(kept.select("event_id", "turbine_id", "recorded_at"))


# --- rollups -------------------------------------------------------------------


def rollup_5min(spark, folder):
    return comparable(build_rollup(stored(spark, folder, *NUMERIC_BOUNDS, "status"), FIVE_MINUTES))


def rollup_1h(spark, folder):
    return comparable(build_rollup(stored(spark, folder, *NUMERIC_BOUNDS, "status"), HOURLY))


def _refreshed(spark, folder, rollup, known_until: int, **offsets) -> DataFrame:
    """A summary of what was stored ``known_until`` seconds ago, refreshed now."""
    telemetry, as_of = stored(spark, folder, *NUMERIC_BOUNDS, "status", "ingested_at"), latest_event(spark, folder)
    before = telemetry.where(F.col("ingested_at") <= seconds_before(as_of, known_until))
    return comparable(refresh_rollup(telemetry, build_rollup(before, rollup), rollup, as_of, **offsets))


def rollup_refresh(spark, folder):
    return _refreshed(spark, folder, HOURLY, 2 * DAY, start_offset=3 * DAY)


def rollup_refresh_5min(spark, folder):
    return _refreshed(spark, folder, FIVE_MINUTES, 3600)


def rollup_coverage_report(spark, folder):
    telemetry = stored(spark, folder, *NUMERIC_BOUNDS, "status")
    summaries = {r.name: build_rollup(telemetry, r) for r in (FIVE_MINUTES, HOURLY)}
    return comparable(rollup_coverage(summaries))


def rollup_refresh_stored(spark, folder):
    """The hourly table of what was stored two days ago, refreshed in place and read back."""
    path, as_of = scratch_folder(spark, "rollup"), latest_event(spark, folder)
    telemetry = spark.read.parquet(_filed_telemetry(spark, folder))
    before = telemetry.where(F.col("ingested_at") <= seconds_before(as_of, 2 * DAY))
    store_rollup(before, HOURLY, path)
    now = feed.events(spark, folder).agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    refresh_stored_rollup(telemetry, HOURLY, path, now, start_offset=3 * DAY)
    return comparable(tables.read_table(spark, path, rollup_schema(spark, HOURLY)).drop(tables.BUCKET_DAY))


def retention_on_disk(spark, folder):
    """The telemetry table after its day folders past a week were removed."""
    path = _filed_telemetry(spark, folder)
    tables.drop_expired_days(spark, path, latest_event(spark, folder), keep_days=7)
    return comparable(spark.read.parquet(path).select("event_id", "turbine_id", "recorded_at"))


# --- status and reports --------------------------------------------------------


def _latest(spark, folder):
    return status.latest_status(feed.readings(spark, folder), arrival="seq")


def _thermal(spark, folder):
    # A copy of a reading that arrived later may have a bearing temperature the stored one lacks.
    return status.thermal_health(stored(spark, folder, *NUMERIC_BOUNDS))


def latest_status(spark, folder):
    return comparable(_latest(spark, folder))


def latest_status_stored(spark, folder):
    return comparable(status.latest_status(stored(spark, folder, *NUMERIC_BOUNDS, "status")))


def fleet_status(spark, folder):
    return comparable(status.fleet_status(_latest(spark, folder)))


def latest_core(spark, folder):
    return comparable(status.latest_core(_latest(spark, folder)))


def latest_extended(spark, folder):
    return comparable(status.latest_extended(_latest(spark, folder)))


def thermal_health(spark, folder):
    return comparable(status.thermal_list(_thermal(spark, folder)))


def thermal_ranked(spark, folder):
    return comparable(status.thermal_ranked(_thermal(spark, folder)))


def alert_summary_by_severity(spark, folder):
    return reports.alert_summary(alerts(spark, folder), latest_event(spark, folder))


def _power(spark, folder) -> DataFrame:
    return stored(spark, folder, "power_output_kw", "wind_speed_ms")


def fleet_snapshot(spark, folder):
    return reports.fleet_snapshot(_power(spark, folder), alerts(spark, folder), latest_event(spark, folder))


def fleet_snapshot_24h(spark, folder):
    as_of = latest_event(spark, folder)
    return reports.fleet_snapshot(_power(spark, folder), alerts(spark, folder), as_of, window=DAY, alert_window=DAY)


def table_counts(spark, folder):
    return reports.table_counts(
        stored(spark, folder, "ingested_at"), alerts(spark, folder), dlq(spark, folder), latest_event(spark, folder)
    )


def recent_alerts(spark, folder):
    return comparable(reports.recent_alerts(alerts(spark, folder)))


def recent_critical_alerts(spark, folder):
    return comparable(reports.recent_alerts(alerts(spark, folder), limit=1000, severity="critical"))


def recent_alerts_by_alert_ts(spark, folder):
    return comparable(reports.recent_alerts_by_alert_ts(alerts(spark, folder)))


def recent_dlq(spark, folder):
    return comparable(reports.recent_dlq(dlq(spark, folder)))


def tail_messages(spark, folder):
    return comparable(with_payload(reports.tail_messages(feed.messages(spark, folder), 5), "value"))


def tail_messages_long(spark, folder):
    """A long tail of every partition."""
    return comparable(with_payload(reports.tail_messages(feed.messages(spark, folder), 1500), "value"))


# --- replay --------------------------------------------------------------------


def dlq_replay_summary(spark, folder):
    return letters.replay_summary(letters.replay(dlq(spark, folder)))


def dlq_replay_listing(spark, folder):
    return letters.replay_listing(letters.replay(dlq(spark, folder)))


def dlq_replay_outcome(spark, folder):
    outcome = letters.replay_outcome(letters.replay(dlq(spark, folder)), F.col("failed_at"))
    return comparable(with_payload(outcome))


def _old_letters(spark, folder) -> DataFrame:
    """Dead letters of a reader that did not know the older layout: by now good, out of bounds, or no JSON."""
    kind = F.col("offset") % 20
    sent = feed.messages(spark, folder).where(kind.isin(3, 7, 11))
    return sent.select(
        message_id(sent, F.lit("dlq")).alias("dlq_id"),
        F.col("topic").alias("original_topic"),
        F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"),
        F.col("value").alias("raw_payload"),
        F.when(kind == 7, F.lit(JSON_ERROR)).otherwise(F.lit(SCHEMA_ERROR)).alias("error_type"),
        F.lit("refused").alias("error_message"),
        F.col("timestamp").alias("failed_at"),
        F.lit(0).alias("retry_count"),
        F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )


def dlq_replay_recovered(spark, folder):
    """Readings that a replay of old dead letters finds good."""
    replayed = letters.replay(_old_letters(spark, folder))
    return comparable(letters.recovered_readings(replayed).drop("event_id"))


def _replayed_store(spark, folder) -> Store:
    store = Store(scratch_folder(spark, "replay"))
    store.insert_dlq(_old_letters(spark, folder).withColumn(tables.EVENT_DAY, F.to_date("failed_at")))
    replay_stored_dlq(spark, store)
    return store


def dlq_replay_stored(spark, folder):
    """The dead-letter table after a replay: resolved, tried again, or left alone."""
    after = _replayed_store(spark, folder).dlq(spark)
    state = ("dlq_id", "original_offset", "error_type", "error_message", "failed_at", "retry_count", "resolved")
    return comparable(after.select(*state, F.col("resolved_at").isNotNull().alias("stamped")))


# --- rates ---------------------------------------------------------------------


def events_per_minute(spark, folder):
    return rates.events_per_minute(feed.readings(spark, folder), latest_event(spark, folder))


def events_per_minute_series(spark, folder):
    return comparable(rates.events_per_minute_series(feed.readings(spark, folder)))


def inserts_per_minute(spark, folder):
    return rates.inserts_per_minute(stored(spark, folder, "ingested_at"), latest_event(spark, folder))


def alert_window_counts(spark, folder):
    return rates.recent_activity(
        feed.readings(spark, folder), alerts(spark, folder), dlq(spark, folder), latest_event(spark, folder), DAY
    )


def event_rate_by_turbine(spark, folder):
    return rates.event_rate_by_turbine(feed.readings(spark, folder), latest_event(spark, folder), DAY)


def event_rate_by_turbine_series(spark, folder):
    return comparable(rates.event_rate_by_turbine_series(feed.readings(spark, folder), step=3600, window=6 * 3600))


def alert_rate_by_rule(spark, folder):
    return rates.alert_rate(alerts(spark, folder), latest_event(spark, folder), DAY)


def critical_alert_rate(spark, folder):
    return rates.alert_rate(alerts(spark, folder), latest_event(spark, folder), DAY, severity="CRITICAL")


def warning_alert_rate(spark, folder):
    return rates.alert_rate(alerts(spark, folder), latest_event(spark, folder), DAY, severity="WARNING")


def consumption_rate(spark, folder):
    """Rows read per second over a day of batches, one batch per 100 events."""
    batches = (
        feed.events(spark, folder)
        .groupBy(F.floor(F.col("event_id") / 100).alias("batch_id"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col("ts").cast("timestamp")).alias("finished_at"))
        .withColumns({"query_name": F.lit("process"), "table_name": F.lit("messages")})
    )
    return rates.consumption_rate(batches, latest_event(spark, folder), DAY)


def _batches(spark, folder) -> DataFrame:
    """Batch statistics of which all is known: a batch per hour and type of event, its write time set by its size."""
    return (
        feed.events(spark, folder)
        .groupBy(F.col("event_type").alias("table_name"), F.date_trunc("hour", "ts").alias("batch"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("elapsed_s", (F.col("row_count") * 37 % 1000).cast("double") / 400)
    )


def write_latency(spark, folder):
    return _rounded(rates.write_latency(_batches(spark, folder)), "p95")


def batch_sizes(spark, folder):
    sizes = rates.batch_sizes(_batches(spark, folder))
    return sizes.withColumn("counts", F.array_join(F.col("counts").cast("array<string>"), ","))


def alert_rate_series(spark, folder):
    return comparable(rates.alert_rate_series(alerts(spark, folder), step=3600, window=6 * 3600))


def sensor_alert_rate(spark, folder):
    return rates.gear_train_alert_rate(alerts(spark, folder), latest_event(spark, folder), DAY)


def dlq_rate_by_type(spark, folder):
    return rates.dlq_rate(dlq(spark, folder), latest_event(spark, folder), DAY)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def latency_quantiles(spark, folder):
    return _rounded(rates.latency_quantiles(feed.readings(spark, folder)), "p50", "p95", "p99")


def latency_quantiles_by_turbine(spark, folder):
    by_turbine = rates.latency_quantiles(
        feed.readings(spark, folder), latest_event(spark, folder), DAY, keys=["turbine_id"]
    )
    return _rounded(by_turbine, "p50", "p95", "p99")


def latency_sketches(spark, folder):
    """Hourly sketches per machine, merged to the whole time: exact quantiles, and that the estimates keep to their bound."""
    arriving, quantiles = feed.readings(spark, folder), (0.5, 0.95, 0.99)
    estimates = sketches.sketched_quantiles(sketches.latency_sketches(arriving, 3600), quantiles, ["turbine_id"])
    timed = arriving.select("turbine_id", rates.lag_seconds(F.col("producer_ts"), F.col("recorded_at")).alias("latency_s"))
    checked_rows = sketches.rank_errors(timed, "latency_s", estimates, quantiles, ["turbine_id"])
    within = (F.col("rank_error") <= sketches.RANK_ERROR).alias("within_bound")
    # Between two instants in microseconds, a hundredth of the way: nine digits are never a tie.
    exact = [F.round(c, AVERAGE_DIGITS).alias(c) for c in ("p50", "p95", "p99")]
    return checked_rows.select("turbine_id", "sample_count", *exact, within)


def active_machines_series(spark, folder):
    """Machines seen in the six hours up to every full hour, from bitmaps per hour."""
    arriving = feed.readings(spark, folder)
    bitmaps = sketches.machine_bitmaps(arriving, sketches.machine_numbers(arriving), 3600)
    return comparable(sketches.active_machines_series(bitmaps, 3600, 6 * 3600))


def lag_by_turbine(spark, folder):
    return _rounded(rates.lag_by_turbine(feed.readings(spark, folder)), "lag_s")


# --- the same lists and rates from stored tables -------------------------------


def _now(spark, folder):
    return feed.events(spark, folder).agg(F.max(F.col("ts").cast("timestamp"))).first()[0]


def _stored_alerts(spark, folder) -> Store:
    """All alerts in the alert table, in four batches of one processing time after the other."""
    store = Store(scratch_folder(spark, "alerts"))
    arriving, at = feed.readings(spark, folder), F.unix_micros("producer_ts")
    first, last = arriving.where(any_hit()).agg(F.min(at), F.max(at)).first()
    if first is None:
        return store
    # Readings are cut, not alerts, so that each is worked on in its own batch only.
    for batch in _four_batches(arriving, F.floor((at - first) * 4 / (last - first + 1))):
        store.insert_alerts(detect(batch, alert_ts=F.col("producer_ts")))
    return store


def _stored_dlq(spark, folder) -> Store:
    store = Store(scratch_folder(spark, "dlq"))
    filed = checked(spark, folder).withColumn(tables.EVENT_DAY, F.to_date("timestamp"))
    store.insert_dlq(rejected(filed, F.col("timestamp"), keep=[tables.EVENT_DAY]))
    return store


def alert_rate_by_rule_stored(spark, folder):
    now = _now(spark, folder)
    window = _stored_alerts(spark, folder).within(spark, "alerts", "alert_ts", now, DAY)
    return rates.alert_rate(window, now, DAY)


def dlq_rate_by_type_stored(spark, folder):
    now = _now(spark, folder)
    return rates.dlq_rate(_stored_dlq(spark, folder).within(spark, "dlq", "failed_at", now, DAY), now, DAY)


def inserts_per_minute_stored(spark, folder):
    now, store = _now(spark, folder), Store(scratch_folder(spark, "store"))
    store.insert_telemetry(feed.readings(spark, folder).withColumns({"offset": F.col("seq"), "partition": F.lit(0)}))
    return rates.inserts_per_minute(store.within(spark, "telemetry", "ingested_at", now, 60), now)


def recent_alerts_stored(spark, folder):
    """The newest alerts by event time, from as many files as it takes."""
    return comparable(reports.recent_alerts(_stored_alerts(spark, folder).newest(spark, "alerts", "recorded_at", 50)))


def recent_alerts_by_alert_ts_stored(spark, folder):
    newest = _stored_alerts(spark, folder).newest(spark, "alerts", "alert_ts", 20)
    return comparable(reports.recent_alerts_by_alert_ts(newest))


def recent_dlq_stored(spark, folder):
    return comparable(reports.recent_dlq(_stored_dlq(spark, folder).newest(spark, "dlq", "failed_at", 20)))


# --- streams -------------------------------------------------------------------


def _processed(spark, folder) -> Store:
    """The main stream drained into new tables, with the message time as the clock."""
    base = scratch_folder(spark, "stream")
    store = Store(f"{base}/tables")
    processor = MessageProcessor(store, clock=lambda: F.col("timestamp"))
    process_stream(feed.stream_messages(spark, folder), processor, f"{base}/checkpoint", drain=True).start().awaitTermination()
    return store


def stream_process(spark, folder):
    """Alerts of the main stream."""
    return comparable(_processed(spark, folder).alerts(spark).drop(tables.EVENT_DAY))


def stream_telemetry_table(spark, folder):
    return comparable(_processed(spark, folder).telemetry(spark).drop(tables.EVENT_DAY))


def stream_dlq_table(spark, folder):
    return comparable(_processed(spark, folder).dlq(spark).transform(with_payload).drop(tables.EVENT_DAY))


def batch_stats(spark, folder):
    """Rows per target table, from the statistics of the main stream's batches."""
    stats = _processed(spark, folder).batch_stats(spark)
    return stats.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def batch_metrics(spark, folder):
    """Write-time quantile and batch-size histogram per table, of four batches timed by a clock that ticks when read."""
    store, ticks = Store(scratch_folder(spark, "timed")), itertools.count()
    processor = MessageProcessor(store, clock=lambda: F.col("timestamp"), timer=lambda: next(ticks) / 8)
    # Readings are cut, not messages, so that each payload is made in its own batch only.
    for number, batch in enumerate(_four_batches(feed.readings(spark, folder), F.col("seq"))):
        processor(feed.messages_of(batch), number)
    stats = store.batch_stats(spark)
    sizes = rates.batch_sizes(stats).withColumn("counts", F.array_join("counts", ","))
    return _rounded(rates.write_latency(stats), "p95").join(sizes, "table_name")


def _four_batches(df: DataFrame, by: Column) -> list[DataFrame]:
    return [df.where(F.pmod(by, F.lit(4)) == part) for part in range(4)]


def _published_readings(spark, folder) -> TopicFiles:
    """Readings published in four batches, in the order of their instants within a batch."""
    topic = TopicFiles(scratch_folder(spark, "topic"), "telemetry")
    for number, batch in enumerate(_four_batches(feed.readings(spark, folder), F.col("seq"))):
        payload = F.to_json(F.struct(*READING_COLUMNS), JSON_OPTIONS).alias("value")
        keyed = batch.select(F.col("turbine_id").alias("key"), payload, "recorded_at", "seq")
        topic.publish(keyed, number, ["recorded_at", "seq"])
    return topic


def published_readings(spark, folder):
    """The readings of a topic with their number per machine, decoded again."""
    sent = _published_readings(spark, folder).read(spark)
    # The number takes the place of the offset, which the decode chain keeps.
    numbered = sent.withColumn("offset", F.col("sequence")).drop("key", "sequence")
    received = accepted(check_messages(numbered), keep=["offset"])
    return comparable(received.withColumnRenamed("offset", "sequence"))


def published_order(spark, folder):
    """Gaps, copies and disorder per machine of a topic."""
    return order_report(_published_readings(spark, folder).read(spark)).withColumnRenamed("key", "turbine_id")


def _consumed(spark, folder) -> Store:
    """Raw messages published as a topic and read from it in five batches."""
    base = scratch_folder(spark, "consumed")
    topic = TopicFiles(f"{base}/topic")
    keyed = feed.messages_of(feed.readings(spark, folder), F.col("turbine_id").alias("key"))
    topic.publish(keyed.select("key", "offset", "timestamp", "value"), 0, ["offset"])
    processor = MessageProcessor(Store(f"{base}/tables"), clock=lambda: F.col("timestamp"))
    most = -(-sum(topic.ends(spark).values()) // 5)
    TopicConsumer(topic, f"{base}/progress", max_rows=max(1, most)).drain(spark, processor)
    return processor.store


def consumed_telemetry(spark, folder):
    """Readings stored from a topic by offsets; ids made from positions are left out."""
    return comparable(_consumed(spark, folder).telemetry(spark).drop(tables.EVENT_DAY, "event_id"))


def stream_rollup_5min(spark, folder):
    """The rollup kept current while readings, late and future ones among them, are stored batch by batch."""
    base = scratch_folder(spark, "rollup")
    source, path = f"{base}/telemetry", f"{base}/rollup"
    arriving = feed.readings(spark, folder)
    for batch in _four_batches(arriving, F.xxhash64("turbine_id", "recorded_at")):
        tables.insert_if_absent(tables.file_by_day(batch), source, READING_KEY, ["seq"], TELEMETRY_COLUMNS)
        stream = rollup_stream(
            stream_telemetry(spark, source), FIVE_MINUTES, source, path, f"{base}/checkpoint", drain=True
        )
        stream.start().awaitTermination()
    table = tables.read_table(spark, path, rollup_schema(spark, FIVE_MINUTES))
    return comparable(table.drop(tables.BUCKET_DAY))


def _partial_rollups(spark, folder) -> PartialRollups:
    """Partial sums of four batches whose times are mixed; old days compacted after the second, which then runs again."""
    base = scratch_folder(spark, "parts")
    source, parts = f"{base}/telemetry", PartialRollups(f"{base}/parts")
    for n, batch in enumerate(_four_batches(feed.readings(spark, folder), F.xxhash64("turbine_id", "recorded_at"))):
        tables.insert_if_absent(tables.file_by_day(batch), source, READING_KEY, ["seq"], TELEMETRY_COLUMNS)
        stream = partial_rollup_stream(stream_telemetry(spark, source), parts.path, f"{base}/checkpoint", drain=True)
        stream.start().awaitTermination()
        if n == 1:
            second = tables.read_table(spark, source, with_day(TELEMETRY_SCHEMA)).join(batch.select("event_id"), "event_id", "left_semi")
            for day in tables.stored_days(spark, source, tables.EVENT_DAY)[:2]:
                parts.compact(spark, day)
            parts.add(second, n)
    return parts


def partial_rollup_5min(spark, folder):
    return comparable(_partial_rollups(spark, folder).read(spark, FIVE_MINUTES))


def partial_rollup_1h(spark, folder):
    return comparable(_partial_rollups(spark, folder).read(spark, HOURLY))


def _merged_latest(spark, folder) -> LatestTable:
    """The table of newest readings, merged from four batches whose times are mixed, the last of them twice."""
    base = scratch_folder(spark, "latest")
    source, latest = f"{base}/telemetry", LatestTable(f"{base}/latest")
    arriving = feed.readings(spark, folder)
    for batch in _four_batches(arriving, F.xxhash64("turbine_id", "recorded_at")):
        tables.insert_if_absent(tables.file_by_day(batch), source, READING_KEY, ["seq"], TELEMETRY_COLUMNS)
        stream = latest_stream(stream_telemetry(spark, source), latest.path, f"{base}/checkpoint", drain=True)
        stream.start().awaitTermination()
    latest.merge(batch.join(tables.read_table(spark, source, with_day(TELEMETRY_SCHEMA)).select("event_id"), "event_id", "left_semi"))
    return latest


def latest_status_merged(spark, folder):
    return comparable(_merged_latest(spark, folder).latest_status(spark))


def thermal_health_merged(spark, folder):
    return comparable(status.thermal_list(_merged_latest(spark, folder).thermal_health(spark)))


def stream_dedup(spark, folder):
    """All columns of the first arrival, from batches in order of arrival whose times are mixed."""
    base = scratch_folder(spark, "dedup")
    arriving = feed.readings(spark, folder).select(*TELEMETRY_COLUMNS, "seq")
    last = arriving.select(F.max("seq")).scalar()
    for batch in _four_batches(arriving, F.floor(F.col("seq") * 4 / (last + 1))):
        batch.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(arriving.schema).parquet(f"{base}/in")
        dedup_stream(stream, f"{base}/rows", f"{base}/checkpoint", ["seq"], drain=True).start().awaitTermination()
    return comparable(spark.read.parquet(f"{base}/rows").drop("seq", tables.EVENT_DAY))


QUERIES: dict[str, Query] = {
    "alerts_by_rule_severity": alerts_by_rule_severity,
    "alerts_detail": alerts_detail,
    **{f"rule_{rule.name}": _one_rule(rule) for rule in RULES},
    "normalised_telemetry": normalised_telemetry,
    "dlq_rows": dlq_rows,
    "decode_error_counts": decode_error_counts,
    "validation_failures": validation_failures,
    "dlq_watch": dlq_watch,
    "variant_telemetry": variant_telemetry,
    "variant_dlq": variant_dlq,
    "ingest_summary": log_ingest_summary,
    "log_telemetry": log_telemetry,
    "dedup_telemetry": dedup_telemetry,
    "reading_round_trip": reading_round_trip,
    "alert_round_trip": alert_round_trip,
    "dlq_round_trip": dlq_round_trip,
    "alerts_csv": alerts_csv,
    "telemetry_csv": telemetry_csv,
    "telemetry_inserted_twice": telemetry_inserted_twice,
    "compact": compact,
    "partition_report": partition_report,
    "storage_report": storage_report,
    "retention_7d": retention_7d,
    "rollup_5min": rollup_5min,
    "rollup_1h": rollup_1h,
    "rollup_refresh": rollup_refresh,
    "rollup_refresh_5min": rollup_refresh_5min,
    "rollup_refresh_stored": rollup_refresh_stored,
    "retention_on_disk": retention_on_disk,
    "rollup_coverage": rollup_coverage_report,
    "latest_status": latest_status,
    "latest_status_stored": latest_status_stored,
    "fleet_status": fleet_status,
    "latest_core": latest_core,
    "latest_extended": latest_extended,
    "thermal_health": thermal_health,
    "thermal_ranked": thermal_ranked,
    "alert_summary_by_severity": alert_summary_by_severity,
    "fleet_snapshot": fleet_snapshot,
    "fleet_snapshot_24h": fleet_snapshot_24h,
    "table_counts": table_counts,
    "recent_alerts": recent_alerts,
    "recent_critical_alerts": recent_critical_alerts,
    "recent_alerts_by_alert_ts": recent_alerts_by_alert_ts,
    "recent_dlq": recent_dlq,
    "tail_messages": tail_messages,
    "tail_messages_long": tail_messages_long,
    "dlq_replay_summary": dlq_replay_summary,
    "dlq_replay_listing": dlq_replay_listing,
    "dlq_replay_outcome": dlq_replay_outcome,
    "dlq_replay_recovered": dlq_replay_recovered,
    "dlq_replay_stored": dlq_replay_stored,
    "events_per_minute": events_per_minute,
    "events_per_minute_series": events_per_minute_series,
    "inserts_per_minute": inserts_per_minute,
    "alert_window_counts": alert_window_counts,
    "event_rate_by_turbine": event_rate_by_turbine,
    "event_rate_by_turbine_series": event_rate_by_turbine_series,
    "alert_rate_by_rule": alert_rate_by_rule,
    "critical_alert_rate": critical_alert_rate,
    "warning_alert_rate": warning_alert_rate,
    "consumption_rate": consumption_rate,
    "write_latency": write_latency,
    "batch_sizes": batch_sizes,
    "alert_rate_series": alert_rate_series,
    "sensor_alert_rate": sensor_alert_rate,
    "dlq_rate_by_type": dlq_rate_by_type,
    "alert_rate_by_rule_stored": alert_rate_by_rule_stored,
    "dlq_rate_by_type_stored": dlq_rate_by_type_stored,
    "inserts_per_minute_stored": inserts_per_minute_stored,
    "recent_alerts_stored": recent_alerts_stored,
    "recent_alerts_by_alert_ts_stored": recent_alerts_by_alert_ts_stored,
    "recent_dlq_stored": recent_dlq_stored,
    "latency_quantiles": latency_quantiles,
    "latency_quantiles_by_turbine": latency_quantiles_by_turbine,
    "latency_sketches": latency_sketches,
    "active_machines_series": active_machines_series,
    "lag_by_turbine": lag_by_turbine,
    "stream_process": stream_process,
    "stream_telemetry_table": stream_telemetry_table,
    "stream_dlq_table": stream_dlq_table,
    "batch_stats": batch_stats,
    "batch_metrics": batch_metrics,
    "published_readings": published_readings,
    "published_order": published_order,
    "consumed_telemetry": consumed_telemetry,
    "stream_rollup_5min": stream_rollup_5min,
    "partial_rollup_5min": partial_rollup_5min,
    "partial_rollup_1h": partial_rollup_1h,
    "latest_status_merged": latest_status_merged,
    "thermal_health_merged": thermal_health_merged,
    "stream_dedup": stream_dedup,
}
