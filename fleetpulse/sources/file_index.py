"""Smallest and largest values per data file, so that a range of any column opens only the files it reaches.

A table is filed by day of its event time. Processing times, insert times and
message offsets are no folders; what they span in each file is kept in a small
table of its own below the data, in a folder that readers of the data skip.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import instant

FOLDER = "_files"
#: Parts of the index of the days concerned from which on they are merged.
MERGE_AT = 64
#: Days whose folders are listed one by one; more are listed with the whole table.
LISTED_DAYS = 32
#: A batch is compared by ranges per hour, or per so many offsets.
SLOT_MICROS, SLOT_NUMBERS = 3_600_000_000, 65_536
#: Files that the first step of ``newest`` reads; each further step reads twice as many.
FIRST_FILES = 8

_LONGEST = 2**63 - 1


@dataclass(frozen=True)
class FileIndex:
    """The index of the table at ``path`` for some of its timestamp or integer ``columns``.

    The index may lag behind the data, never lie about it: a file it does not
    know counts as reached by every range, an entry of a file that is gone is
    not used. So a writer that stops before ``update`` costs time, not rows.
    """

    path: str
    schema: T.StructType
    columns: tuple[str, ...]
    day: str = "event_date"

    @property
    def folder(self) -> str:
        return f"{self.path.rstrip('/')}/{FOLDER}"

    @property
    def _layout(self) -> T.StructType:
        numbers = [T.StructField(c, T.LongType()) for c in ("low", "high", "nulls")]
        texts = [T.StructField(c, T.StringType()) for c in ("file", "column")]
        return T.StructType([*texts, *numbers, T.StructField(self.day, T.DateType())])

    def _is_instant(self, column: str) -> bool:
        return isinstance(self.schema[column].dataType, T.TimestampType)

    def position(self, column: str) -> Column:
        """A value as a number that orders alike."""
        return F.unix_micros(column) if self._is_instant(column) else F.col(column).cast("long")

    def value(self, column: str, position: Column) -> Column:
        """The value at a position."""
        return F.timestamp_micros(position) if self._is_instant(column) else position

    # --- listing ---------------------------------------------------------------

    def unwritten(self, spark: SparkSession) -> bool:
        """The table has no folder yet, so no row either."""
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    def files(self, spark: SparkSession, days: Iterable[date] | None = None) -> DataFrame | None:
        """``path, file`` and day of the data files, of some days or all; None before the first write."""
        folders = [self.path]
        if days is not None and len(days := sorted(set(days))) <= LISTED_DAYS:
            hadoop = spark._jvm.org.apache.hadoop.fs
            named = [f"{self.path.rstrip('/')}/{self.day}={d}" for d in days]
            folders = []
            for name in named:
                at = hadoop.Path(name)
                if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
                    folders.append(name)
        if not folders:
            return None
        try:
            found = (
                spark.read.format("binaryFile")
                .option("pathGlobFilter", "*.parquet")
                .option("basePath", self.path)
                .load(folders)
            )
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if self.day not in found.columns:
            return None
        return found.select("path", self._named(F.element_at(F.split("path", "/"), -1)), F.col(self.day).cast("date"))

    def _named(self, name: Column) -> Column:
        """A task gives its files of several days the same name, so the day is part of it."""
        return F.concat_ws("/", F.col(self.day).cast("date").cast("string"), name).alias("file")

    def entries(self, spark: SparkSession, days: Iterable[date] | None = None) -> DataFrame:
        """What is known: a row per file and column."""
        try:
            known = spark.read.schema(self._layout).parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self._layout)
        if days is None:
            return known
        days = sorted(set(days))
        if len(days) <= LISTED_DAYS:
            return known.where(F.col(self.day).isin(days))
        return known.where(F.col(self.day).between(F.lit(days[0]), F.lit(days[-1])))

    def read(self, spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
        """The rows of some data files."""
        schema = schema or self.schema
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    # --- writing ---------------------------------------------------------------

    def update(self, spark: SparkSession, days: Iterable[date] | None = None) -> int:
        """Enter the files of these days that are not known yet; returns how many.

        Only the indexed columns of new files are read. Entries come as one small
        part per day and call; many parts are merged, without those of files that
        are gone.
        """
        listed = self.files(spark, days)
        if listed is None:
            return 0
        known = self.entries(spark, days)
        fresh = [r[0] for r in listed.join(known.select("file").distinct(), "file", "left_anti").select("path").collect()]
        if fresh:
            self._measured(spark, fresh).write.mode("append").partitionBy(self.day).parquet(self.folder)
            if len(known.inputFiles()) >= MERGE_AT:
                self._merge(spark, listed, days)
        return len(fresh)

    def _measured(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        fields = [self.schema[c] for c in self.columns] + [T.StructField(self.day, T.DateType())]
        rows = self.read(spark, paths, T.StructType(fields)).withColumn("file", self._named(F.col("_metadata.file_name")))
        spans = []
        for i, column in enumerate(self.columns):
            at = self.position(column)
            spans += [F.min(at).alias(f"low{i}"), F.max(at).alias(f"high{i}"), F.count_if(at.isNull()).alias(f"nulls{i}")]
        lines = F.array(
            *[
                F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in ("low", "high", "nulls")])
                for i, c in enumerate(self.columns)
            ]
        )
        spans = rows.groupBy("file", self.day).agg(*spans)
        return spans.select("file", F.inline(lines), self.day).select(*self._layout.fieldNames()).coalesce(1)

    def _merge(self, spark: SparkSession, listed: DataFrame, days: Iterable[date] | None) -> None:
        """Entries of the days in few parts. Written as a whole before the old parts go."""
        kept = self.entries(spark, days).dropDuplicates(["file", "column"])
        kept = kept.join(listed.select("file"), "file", "left_semi").select(*self._layout.fieldNames())
        (
            kept.repartition(self.day)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.day)
            .parquet(self.folder)
        )

    # --- reading ---------------------------------------------------------------

    def _reached(self, spark: SparkSession, listed: DataFrame | None, known: DataFrame, reached: DataFrame) -> list[str]:
        """Paths of the listed files that are reached, or not known."""
        if listed is None:
            return []
        reached = reached.select("file").distinct().withColumn("reached", F.lit(True))
        seen = known.select("file").distinct().withColumn("known", F.lit(True))
        chosen = listed.join(seen, "file", "left").join(reached, "file", "left").where("known is null or reached")
        return [row[0] for row in chosen.select("path").collect()]

    def window(
        self, spark: SparkSession, column: str, start: datetime | int | None = None, end: datetime | int | None = None
    ) -> DataFrame:
        """The rows with ``start <= column <= end``, from the files that reach into that range."""

        def at(value) -> Column:
            return F.unix_micros(instant(value)) if self._is_instant(column) else F.lit(value)

        known = self.entries(spark).where(F.col("column") == column)
        reached, rows = known.where(F.col("high").isNotNull()), F.col(column).isNotNull()
        if start is not None:
            reached, rows = reached.where(F.col("high") >= at(start)), rows & (self.position(column) >= at(start))
        if end is not None:
            reached, rows = reached.where(F.col("low") <= at(end)), rows & (self.position(column) <= at(end))
        return self.read(spark, self._reached(spark, self.files(spark), known, reached)).where(rows)

    def ranges(self, batch: DataFrame, column: str) -> DataFrame:
        """What the batch spans of ``column`` per day and hour (or run of offsets): few rows, from one pass over it."""
        at = self.position(column)
        slot = F.floor(at / (SLOT_MICROS if self._is_instant(column) else SLOT_NUMBERS))
        return batch.groupBy(F.col(self.day), slot.alias("slot")).agg(F.min(at).alias("from"), F.max(at).alias("to"))

    def touched_by(self, batch: DataFrame, column: str, days: Iterable[date]) -> list[str]:
        """Paths of the files of these days that can hold a row with a day and ``column`` of the batch."""
        return self.touched(self.ranges(batch, column), column, days)

    def touched(self, ranges: DataFrame, column: str, days: Iterable[date]) -> list[str]:
        """Paths of the files of these days that the ``ranges`` of a batch reach.

        A single late row reaches the files around it and none between it and the
        rest. Rows without a value reach all files of their day.
        """
        spark, days = ranges.sparkSession, list(days)
        known = self.entries(spark, days).where(F.col("column") == column)
        overlap = F.col("from").isNull() | ((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")))
        reached = known.join(ranges, self.day).where(overlap)
        return self._reached(spark, self.files(spark, days), known, reached)

    def newest(self, spark: SparkSession, column: str, n: int, where: Column | None = None) -> DataFrame:
        """Rows among which are the ``n`` of the largest ``column``, ties included, and few others.

        Files are read from the one that reaches highest, in steps, until ``n``
        rows lie above all that is left unread. Without enough rows everything is
        read. Unknown files are read first; nulls rank below all values.
        """
        listed = self.files(spark)
        if listed is None:
            return self.read(spark, [])
        known = self.entries(spark).where(F.col("column") == column).select("file", "high", F.lit(True).alias("known"))
        top = F.when(F.col("known").isNull(), F.lit(_LONGEST)).otherwise(F.coalesce("high", F.lit(-_LONGEST)))
        ranked = listed.join(known.dropDuplicates(["file"]), "file", "left").select("path", top.alias("top"))
        take = FIRST_FILES
        while True:
            chosen = ranked.orderBy(F.desc("top"), "path").limit(take + 1).collect()
            rows = self.read(spark, [r["path"] for r in chosen[:take]])
            rows = rows if where is None else rows.where(where)
            if len(chosen) <= take:
                return rows
            if rows.where(self.position(column) > chosen[take]["top"]).limit(n).count() >= n:
                return rows
            take *= 2
