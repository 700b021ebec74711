"""Parquet tables filed by day: idempotent inserts, replacement, retention, compaction.

Each table has one writer at a time (a job or a streaming query); readers see
whole files only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import instant, seconds_before
from fleetpulse.operators.dedup import first_per_key
from fleetpulse.sources.file_index import FileIndex

EVENT_DAY = "event_date"
BUCKET_DAY = "bucket_date"
# Files of compacted days are told from others by their compression.
WRITTEN, COMPACTED = "snappy", "zstd"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def file_by_day(df: DataFrame, ts: str = "recorded_at", day: str = EVENT_DAY) -> DataFrame:
    return df.withColumn(day, F.to_date(ts))


def spread_by_day(df: DataFrame, day: str) -> DataFrame:
    """Group rows by day for writing.

    Tasks are sized while the plan runs: small days share one, a busy day is
    split over as many as its bytes need.
    """
    return df.hint("rebalance", F.col(day))


@dataclass(frozen=True)
class Reach:
    """Days, and range of one column, that the rows of a batch lie in."""

    first_day: date | None
    last_day: date | None
    low: object = None
    high: object = None

    @staticmethod
    def columns(day: str, span: str) -> dict[str, Column]:
        """Aggregates that make a reach; a caller may take them with its own counts."""
        known = F.count_if(F.col(span).isNull()) == 0
        return {
            "first_day": F.min(day),
            "last_day": F.max(day),
            "low": F.when(known, F.min(span)),
            "high": F.when(known, F.max(span)),
        }

    @classmethod
    def of(cls, batch: DataFrame, day: str, span: str) -> Reach:
        return cls(**batch.agg(*[c.alias(n) for n, c in cls.columns(day, span).items()]).first().asDict())

    @classmethod
    def of_ranges(cls, ranges: DataFrame, day: str, value: Callable[[Column], Column]) -> Reach:
        """The same from ``FileIndex.ranges``, whose numbers ``value`` turns back; a row without a slot holds nulls."""
        known = F.count_if(F.col("slot").isNull()) == 0
        low, high = (F.when(known, value(f(c))) for f, c in ((F.min, "from"), (F.max, "to")))
        return cls(*ranges.agg(F.min(day), F.max(day), low, high).first())

    def covers(self, day: str, span: str) -> Column:
        """Predicate for stored rows: two comparisons for the days and two for the range, for any batch."""
        where = F.col(day).between(F.lit(self.first_day), F.lit(self.last_day))
        if self.low is not None:
            where = where & F.col(span).between(F.lit(self.low), F.lit(self.high))
        return where


def insert_if_absent(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    arrival: Sequence[str],
    columns: Sequence[str],
    day: str = EVENT_DAY,
    span: str = "recorded_at",
    reach: Reach | None = None,
    index: FileIndex | None = None,
) -> None:
    """Append the rows whose key is neither stored nor earlier in the batch.

    Equal keys share their day and their ``span`` value. So only the stored days
    between the first and last of the batch are read, of those only the row
    groups in its range, and of those only the key columns; the day is one of
    the keys that are joined. With an ``index`` of ``span`` only files that reach
    into the batch's ranges are opened, however many the day has by then, and
    the new files are entered. Writing a batch twice changes nothing, which makes
    a restarted stream safe.

    With an ``index`` the batch is computed once for its ranges and once to be
    written, and a table without a folder is written at once: a batch that is
    costly to compute need not be persisted.
    """
    spark = batch.sparkSession
    wanted = [*columns, day]
    fresh = first_per_key(batch.select(*dict.fromkeys([*wanted, *arrival])), keys, arrival).select(*wanted)
    searched = [f for f in batch.schema if f.name in {*keys, span}] + [T.StructField(day, T.DateType())]
    days, paths = None, []
    if index is None:
        reach = reach or Reach.of(batch, day, span)
        if reach.first_day is None:
            return
        stored = read_table(spark, path, T.StructType(searched))
    else:
        if not index.unwritten(spark):
            ranges = index.ranges(batch, span).persist()
            try:
                reach = reach or Reach.of_ranges(ranges, day, partial(index.value, span))
                days = [row[0] for row in ranges.select(day).distinct().collect() if row[0] is not None]
                if not days:
                    return
                paths = index.touched(ranges, span, days)
            finally:
                ranges.unpersist()
        stored = index.read(spark, paths, T.StructType(searched))
    if index is None or paths:
        stored = stored.where(reach.covers(day, span)).select(*keys, day)
        fresh = fresh.join(stored, [*keys, day], "left_anti").select(*wanted)
    spread_by_day(fresh, day).write.mode("append").option("compression", WRITTEN).partitionBy(day).parquet(path)
    if index is not None:
        index.update(spark, days)


def replace_days(df: DataFrame, path: str, day: str, compression: str = WRITTEN) -> None:
    """Write the frame over exactly the days it holds; other days stay.

    Files are staged, so the frame may read the same table. At commit the
    folders are swapped one after the other: if the driver is lost just then,
    days not yet swapped in can be missing, and the call has to be repeated from
    rows that do not come from this table. Rows added to these days by another
    writer meanwhile are lost; a table has one writer at a time.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(day)
        .parquet(path)
    )


def drop_days(spark: SparkSession, path: str, day: str, days: Sequence) -> None:
    """Remove day folders."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for value in days:
        folder = hadoop.Path(f"{path.rstrip('/')}/{day}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored_days(spark: SparkSession, path: str, day: str, where: Column | None = None) -> list:
    """Days that have files, in order: a value per calendar day of the table."""
    try:
        files = list_files(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if day not in files.columns:
        return []
    days = files.select(day).distinct()
    return [row[0] for row in (days if where is None else days.where(where)).orderBy(day).collect()]


def upsert(changes: DataFrame, path: str, keys: Sequence[str], day: str, schema: T.StructType) -> None:
    """Replace stored rows by key within the days of the changes, add the others.

    A key keeps its day. Days without changes are not read beyond their folder
    names and not written; see ``replace_days`` for what a crash leaves.
    """
    spark = changes.sparkSession
    row = changes.agg(F.min(day), F.max(day)).first()
    if row[0] is None:
        return
    stored = read_table(spark, path, schema).where(F.col(day).between(F.lit(row[0]), F.lit(row[1])))
    stored = stored.join(changes.select(day).distinct(), day, "left_semi")
    kept = stored.join(changes.select(*keys, day), [*keys, day], "left_anti")
    merged = kept.select(*schema.fieldNames()).unionByName(changes.select(*schema.fieldNames()))
    replace_days(spread_by_day(merged, day), path, day)


def expired(day: Column, as_of, keep_days: int) -> Column:
    """The whole day lies before the cut-off."""
    cutoff = seconds_before(instant(as_of), keep_days * 86400)
    return F.date_add(day, 1).cast("timestamp") <= cutoff


def retain(df: DataFrame, as_of, keep_days: int = 90, ts: str = "recorded_at") -> DataFrame:
    """Drop days that ended ``keep_days`` before ``as_of``; a day in part newer stays whole."""
    day = F.col(EVENT_DAY) if EVENT_DAY in df.columns else F.to_date(ts)
    return df.where(~expired(day, as_of, keep_days))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file with its day and size; no data is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.drop("content")


def storage_report(spark: SparkSession, path: str, day: str = EVENT_DAY, limit: int = 10) -> DataFrame:
    """Newest day folders of a table: range, files and bytes, from the listing alone."""
    return (
        list_files(spark, path)
        .groupBy(day)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .select(
            F.col(day).cast("timestamp").alias("range_start"),
            F.date_add(day, 1).cast("timestamp").alias("range_end"),
            "files",
            "bytes",
        )
        .orderBy(F.desc("range_start"))
        .limit(limit)
    )


def drop_expired_days(spark: SparkSession, path: str, as_of, keep_days: int = 90, day: str = EVENT_DAY) -> list:
    """Remove the day folders that are past retention; returns the days removed."""
    gone = stored_days(spark, path, day, expired(F.col(day), as_of, keep_days))
    drop_days(spark, path, day, gone)
    return gone


def compacted(df: DataFrame, partitions: int, day: str = EVENT_DAY) -> DataFrame:
    """Rows ordered by day, machine and falling time over evenly filled tasks.

    Range partitioning on all three cuts a busy day or machine into several
    tasks. Each file then holds few machines and a short time range, which is
    what makes its column statistics skip well.
    """
    order = [F.col(day), F.col("turbine_id"), F.desc("recorded_at")]
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    as_of,
    after_days: int = 7,
    file_bytes: int = 512 * 1024 * 1024,
    day: str = EVENT_DAY,
) -> None:
    """Rewrite the days that ended ``after_days`` ago, in order and zstd-compressed, to ``target``.

    ``target`` may be the table itself: only the rewritten days are replaced. A
    day whose files are all compacted is left alone, so each day is rewritten
    once, and again only after rows were added to it.
    """
    done = F.col("path").endswith(f".{COMPACTED}.parquet")
    sizes = (
        list_files(spark, path)
        .where(expired(F.col(day), as_of, after_days))
        .groupBy(day)
        .agg(F.count_if(~done).alias("loose"), F.sum("length").alias("bytes"))
        .where("loose > 0")
        .collect()
    )
    if not sizes:
        return
    rows = spark.read.schema(schema).parquet(path).where(F.col(day).isin([r[day] for r in sizes]))
    parts = max(1, math.ceil(sum(r["bytes"] for r in sizes) / file_bytes))
    replace_days(compacted(rows, parts, day), target, day, COMPACTED)
