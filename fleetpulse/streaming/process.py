"""Raw messages to telemetry, alerts and dead letters, one decode per micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import add

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetpulse.operators.dedup import ALERT_KEY, DLQ_KEY, READING_KEY
from fleetpulse.operators.rules import RULES, Rule, detect
from fleetpulse.operators.validate import accepted, check_messages, rejected
from fleetpulse.schemas import ALERT_COLUMNS, ALERT_SCHEMA, BATCH_STATS_SCHEMA, DLQ_SCHEMA, TELEMETRY_SCHEMA, with_day
from fleetpulse.sources.file_index import FileIndex
from fleetpulse.sources.logs import number_lines
from fleetpulse.sources.messages import alerts_from_messages
from fleetpulse.sources.tables import EVENT_DAY, Reach, file_by_day, insert_if_absent, read_table

# Fixed value: a batch is flushed after 2 seconds.
FLUSH_SECONDS = 2.0

ARRIVAL = ("offset", "partition")
# Per table its layout, and the columns whose span is kept for every file: what copies share, and processing time.
INDEXED = {
    "telemetry": (TELEMETRY_SCHEMA, ("recorded_at", "ingested_at")),
    "alerts": (ALERT_SCHEMA, ("recorded_at", "alert_ts")),
    "dlq": (DLQ_SCHEMA, ("original_offset", "failed_at")),
}
Sink = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Store:
    """The tables below one root folder."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def telemetry(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("telemetry"), with_day(TELEMETRY_SCHEMA))

    def alerts(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("alerts"), with_day(ALERT_SCHEMA))

    def dlq(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("dlq"), with_day(DLQ_SCHEMA))

    def batch_stats(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("batch_stats"), BATCH_STATS_SCHEMA)

    def index(self, table: str) -> FileIndex:
        """What times and offsets the files of a table span."""
        schema, columns = INDEXED[table]
        return FileIndex(self.path(table), with_day(schema), columns)

    def within(self, spark: SparkSession, table: str, column: str, as_of: datetime, seconds: float) -> DataFrame:
        """Rows whose ``column``, a processing time for example, lies in the ``seconds`` up to ``as_of``.

        Opens the files that reach into the window, not the days. The start is
        included; operators with an open start leave it out.
        """
        return self.index(table).window(spark, column, as_of - timedelta(seconds=seconds), as_of)

    def newest(self, spark: SparkSession, table: str, column: str, n: int, where: Column | None = None) -> DataFrame:
        """Few rows that hold the ``n`` newest by ``column``, for the lists of recent rows."""
        return self.index(table).newest(spark, column, n, where)

    def insert_telemetry(self, readings: DataFrame, reach: Reach | None = None) -> None:
        """Good readings with their message position; the first arrival is stored."""
        columns = TELEMETRY_SCHEMA.fieldNames()
        insert_if_absent(
            file_by_day(readings), self.path("telemetry"), READING_KEY, ARRIVAL, columns,
            reach=reach, index=self.index("telemetry"),
        )

    def insert_alerts(self, alerts: DataFrame, reach: Reach | None = None) -> None:
        insert_if_absent(
            file_by_day(alerts), self.path("alerts"), ALERT_KEY, ("alert_ts",), ALERT_COLUMNS,
            reach=reach, index=self.index("alerts"),
        )

    def insert_dlq(self, dlq: DataFrame, reach: Reach | None = None) -> None:
        """Dead letters with ``event_date``, the day their message arrived."""
        columns = DLQ_SCHEMA.fieldNames()
        insert_if_absent(
            dlq, self.path("dlq"), DLQ_KEY, ("failed_at",), columns,
            span="original_offset", reach=reach, index=self.index("dlq"),
        )

    def append_batch_stats(self, stats: DataFrame) -> None:
        stats.write.mode("append").parquet(self.path("batch_stats"))


@dataclass(frozen=True)
class MessageProcessor:
    """The ``foreachBatch`` function of the main stream, usable on a batch as well.

    Alerts are raised before readings are deduplicated, so every copy of a
    reading alerts. All ids follow from the message position: a batch that is
    run again after a failure inserts nothing twice.

    ``clock`` gives the processing time as a column of the message frame,
    ``timer`` the seconds that write times are taken from;
    ``extra_sinks`` receive the frames named ``telemetry``, ``alerts`` and
    ``dlq`` too, for example to publish them to topics.
    """

    store: Store
    name: str = "process"
    rules: Sequence[Rule] = RULES
    clock: Callable[[], Column] = F.current_timestamp
    timer: Callable[[], float] = time.monotonic
    extra_sinks: dict[str, Sequence[Sink]] = field(default_factory=dict)

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        """Check and store a batch of raw messages or of log lines."""
        if "origin" in messages.columns:
            messages = number_lines(messages)
        self.store_checked(check_messages(messages), batch_id)

    def store_checked(self, checked: DataFrame, batch_id: int) -> None:
        """Store a batch that was checked already."""
        spark = checked.sparkSession
        checked = checked.withColumn("processed_at", self.clock()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            readings = accepted(checked, keep=[*ARRIVAL, F.col("processed_at").alias("ingested_at")])
            alerts = detect(readings, self.rules, F.col("ingested_at"))
            filed = checked.withColumn(EVENT_DAY, F.to_date(F.coalesce("timestamp", "processed_at")))
            dlq = rejected(filed, F.col("processed_at"), keep=[EVENT_DAY])

            stats = []
            rows, reach = self._extent(filed)
            for table, frame, insert in (
                ("telemetry", readings, self.store.insert_telemetry),
                ("alerts", alerts, self.store.insert_alerts),
                ("dlq", dlq, self.store.insert_dlq),
            ):
                began = self.timer()
                if rows[table]:
                    insert(frame, reach[table])
                stats.append((table, rows[table], self.timer() - began))
                for sink in self.extra_sinks.get(table, ()):
                    sink(frame)
            stats.append(("messages", rows["messages"], sum(elapsed for _, _, elapsed in stats)))
            self._record(spark, batch_id, stats)
        finally:
            checked.unpersist()

    def _extent(self, filed: DataFrame) -> tuple[dict[str, int], dict[str, Reach]]:
        """Rows headed for every table, and the days and ranges they reach, from one pass over the checked batch."""
        good = F.col("error_type").isNull()
        hits = reduce(add, [F.coalesce(rule.predicate(), F.lit(False)).cast("int") for rule in self.rules])
        sides = filed.withColumns(
            {
                "good_day": F.when(good, F.to_date("recorded_at")),
                "good_at": F.when(good, F.col("recorded_at")),
                "bad_day": F.when(~good, F.col(EVENT_DAY)),
            }
        )
        row = sides.agg(
            F.count(F.lit(1)).alias("messages"),
            F.count_if(good).alias("telemetry"),
            F.coalesce(F.sum(F.when(good, hits)), F.lit(0)).alias("alerts"),
            F.count_if(~good).alias("dlq"),
            F.min("good_day"),
            F.max("good_day"),
            F.min("good_at"),
            F.max("good_at"),
            F.min("bad_day"),
            F.max("bad_day"),
            F.when(F.count_if(~good & F.col("offset").isNull()) == 0, F.min(F.when(~good, F.col("offset")))),
            F.when(F.count_if(~good & F.col("offset").isNull()) == 0, F.max(F.when(~good, F.col("offset")))),
        ).first()
        rows = dict(zip(("messages", "telemetry", "alerts", "dlq"), row[:4]))
        readings = Reach(*row[4:8])
        return rows, {"telemetry": readings, "alerts": readings, "dlq": Reach(*row[8:12])}

    def _record(self, spark: SparkSession, batch_id: int, stats: list[tuple[str, int, float]]) -> None:
        now = datetime.now(timezone.utc)
        lines = [(self.name, table, batch_id, rows, elapsed, now) for table, rows, elapsed in stats]
        self.store.append_batch_stats(spark.createDataFrame(lines, BATCH_STATS_SCHEMA).coalesce(1))


def process_stream(
    messages: DataFrame,
    processor: MessageProcessor,
    checkpoint: str,
    drain: bool = False,
    flush_seconds: float = FLUSH_SECONDS,
) -> DataStreamWriter:
    """The main stream, ready to ``start()``.

    Batches are bounded by the source (``max_offsets`` or ``max_files``) and by
    the flush interval. ``drain`` works off what is there and ends.

    Messages are checked on the stream itself, so the plan of the checks is
    built once. Log lines get their position per batch and are checked there.
    """
    if "origin" in messages.columns:
        return _writer(messages, processor, processor.name, checkpoint, drain, flush_seconds)
    checked = check_messages(messages)
    return _writer(checked, processor.store_checked, processor.name, checkpoint, drain, flush_seconds)


def alert_writer_stream(
    alert_topic: DataFrame, store: Store, checkpoint: str, drain: bool = False, flush_seconds: float = FLUSH_SECONDS
) -> DataStreamWriter:
    """Alert topic to alert table, reading independently of the main stream."""

    def write(messages: DataFrame, batch_id: int) -> None:
        alerts = alerts_from_messages(messages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store.insert_alerts(alerts)
        finally:
            alerts.unpersist()

    return _writer(alert_topic, write, "alert-writer", checkpoint, drain, flush_seconds)


def _writer(stream, write, name, checkpoint, drain, flush_seconds) -> DataStreamWriter:
    writer = stream.writeStream.foreachBatch(write).queryName(name).option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{flush_seconds} seconds")
