"""Rollups kept as mergeable partial sums, a part per batch of new readings.

A batch costs as much as its own rows: it adds its sums, counts and extremes per
machine and five minutes, and reads or rewrites nothing. Averages are divided
when the rollup is read, from the sums of all parts; wider buckets are made from
the same parts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import bucket_floor
from fleetpulse.operators.rollups import AVG, COUNT, FIVE_MINUTES, HOURLY, MAX, MIN, NOT_ONLINE, Measure, Rollup
from fleetpulse.sources.tables import BUCKET_DAY

#: Every column that a rollup measures.
_COLUMNS = tuple(dict.fromkeys(m.column for r in (FIVE_MINUTES, HOURLY) for m in r.spec if m.column))
_ADDED = ("samples", "not_online", *(f"{p}_{c}" for c in _COLUMNS for p in ("sum", "n")))
_EXTREMES = {f"{p}_{c}": f for c in _COLUMNS for p, f in (("min", F.min), ("max", F.max))}

_KIND = {"samples": T.LongType(), "not_online": T.LongType(), **{f"n_{c}": T.LongType() for c in _COLUMNS}}
PART_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("turbine_id", T.StringType()),
        *[T.StructField(c, _KIND.get(c, T.DoubleType())) for c in (*_ADDED, *_EXTREMES)],
    ]
)


def partial_sums(readings: DataFrame) -> DataFrame:
    """What the readings add, per machine and five minutes."""
    added = [
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.col("status") != "online").alias("not_online"),
        *[f(c).alias(f"{p}_{c}") for c in _COLUMNS for p, f in (("sum", F.sum), ("n", F.count), ("min", F.min), ("max", F.max))],
    ]
    bucket = bucket_floor(F.col("recorded_at"), FIVE_MINUTES.seconds)
    summed = readings.groupBy(bucket.alias("bucket"), "turbine_id").agg(*added)
    return summed.select(*PART_SCHEMA.fieldNames())


def merged(parts: DataFrame) -> DataFrame:
    """One part per machine and bucket from several."""
    sums = [F.sum(c).alias(c) for c in _ADDED] + [f(c).alias(c) for c, f in _EXTREMES.items()]
    return parts.groupBy("bucket", "turbine_id").agg(*sums).select(*PART_SCHEMA.fieldNames())


def _measured(measure: Measure) -> Column:
    c = measure.column
    if measure.kind == AVG:
        column = F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}"))
    elif measure.kind in (MAX, MIN):
        column = F.col(f"{measure.kind}_{c}")
    else:
        column = F.col({COUNT: "samples", NOT_ONLINE: "not_online"}[measure.kind])
    return column.alias(measure.name)


@dataclass(frozen=True)
class PartialRollups:
    """The parts below ``path``: one folder per day and batch, and one per compacted day.

    A batch that runs again writes over its own folders. A compacted day says up
    to which batch it goes; parts of those batches do not count any more, whether
    they have been removed yet or not. Batch numbers rise; after the loss of the
    stream's checkpoint the parts have to be built anew.
    """

    path: str

    def _root(self, kind: str) -> str:
        return f"{self.path.rstrip('/')}/{kind}"

    def add(self, readings: DataFrame, batch: int) -> None:
        """Take in newly stored readings, each one once: unique by machine and instant."""
        parts = partial_sums(readings).withColumns({BUCKET_DAY: F.to_date("bucket"), "batch": F.lit(batch).cast("long")})
        (
            parts.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET_DAY, "batch")
            .parquet(self._root("batches"))
        )

    def _stored(self, spark: SparkSession, kind: str, number: str) -> DataFrame:
        schema = T.StructType([*PART_SCHEMA, T.StructField(BUCKET_DAY, T.DateType()), T.StructField(number, T.LongType())])
        try:
            return spark.read.schema(schema).parquet(self._root(kind))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def parts(self, spark: SparkSession, first: date | None = None, last: date | None = None) -> DataFrame:
        """The parts that count, of some days or all."""
        batches, compacted = self._stored(spark, "batches", "batch"), self._stored(spark, "compacted", "upto")
        for limit, holds in ((first, F.col(BUCKET_DAY) >= F.lit(first)), (last, F.col(BUCKET_DAY) <= F.lit(last))):
            if limit is not None:
                batches, compacted = batches.where(holds), compacted.where(holds)
        # A row per compacted day; taken from folder names, as no other column is read.
        newest = compacted.groupBy(F.col(BUCKET_DAY).alias("day")).agg(F.max("upto").alias("newest"))
        loose = batches.join(newest, F.col(BUCKET_DAY) == F.col("day"), "left")
        loose = loose.where("newest IS NULL OR batch > newest").drop("day", "newest", "batch")
        whole = compacted.join(newest, (F.col(BUCKET_DAY) == F.col("day")) & (F.col("upto") == F.col("newest")))
        return loose.unionByName(whole.drop("day", "newest", "upto"))

    def read(self, spark: SparkSession, rollup: Rollup, first: date | None = None, last: date | None = None) -> DataFrame:
        """The rollup, as ``build_rollup`` of all readings taken in."""
        parts = self.parts(spark, first, last).withColumn("bucket", bucket_floor(F.col("bucket"), rollup.seconds))
        return merged(parts).select("bucket", "turbine_id", *[_measured(m) for m in rollup.spec])

    def compact(self, spark: SparkSession, day: date) -> None:
        """Merge the parts of a day into one folder, which appears by a single rename; then remove them."""
        files = self._stored(spark, "batches", "batch").where(F.col(BUCKET_DAY) == F.lit(day))
        upto = files.agg(F.max("batch")).first()[0]
        if upto is None:
            return
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        staged = hadoop.Path(f"{self._root('staged')}-{uuid.uuid4().hex}")
        merged(self.parts(spark, day, day)).write.parquet(staged.toString())
        home = hadoop.Path(f"{self._root('compacted')}/{BUCKET_DAY}={day}")
        system = home.getFileSystem(conf)
        known = {e.getPath().getName() for e in system.listStatus(home)} if system.exists(home) else set()
        system.mkdirs(home)
        final = hadoop.Path(home, f"upto={upto}")
        if final.getName() in known or not system.rename(staged, final):
            system.delete(staged, True)
            if final.getName() not in known:
                raise RuntimeError(f"cannot rename to {final.toString()}")
        self._drop(spark, day, upto, known - {final.getName()})

    def _drop(self, spark: SparkSession, day: date, upto: int, older: set[str]) -> None:
        """Remove what a compacted day stands for."""
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        loose = hadoop.Path(f"{self._root('batches')}/{BUCKET_DAY}={day}")
        system = loose.getFileSystem(conf)
        for entry in system.listStatus(loose):
            name = entry.getPath().getName()
            if name.startswith("batch=") and int(name.removeprefix("batch=")) <= upto:
                system.delete(entry.getPath(), True)
        for name in older:
            system.delete(hadoop.Path(f"{self._root('compacted')}/{BUCKET_DAY}={day}/{name}"), True)
