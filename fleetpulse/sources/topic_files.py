"""A topic kept as files: messages numbered per partition and per key, readable by ranges of offsets."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.schemas import MESSAGE_SCHEMA
from fleetpulse.sources.versions import VersionedTable

TOPIC_SCHEMA = T.StructType(
    [*MESSAGE_SCHEMA, T.StructField("key", T.StringType()), T.StructField("sequence", T.LongType())]
)
# A row without key is the run of offsets that one batch added to a partition;
# a row with a key says which number the key's next message gets.
_STATE = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("next", T.LongType()),
        T.StructField("folder", T.StringType()),
    ]
)
#: Offsets from the first to before the last, by partition.
Ranges = Mapping[int, tuple[int, int]]


@dataclass(frozen=True)
class TopicFiles:
    """A topic at ``path`` with ``partitions`` partitions, which must not change.

    All messages of a key are in one partition, in the order given when they
    were published. Offsets of a partition and sequence numbers of a key run
    from 0 without gaps. A published batch is entered by one rename: readers see
    all of it or nothing, a second publisher is refused, and a batch that was
    entered already is not published again.
    """

    path: str
    topic: str = "raw"
    partitions: int = 6

    @property
    def state(self) -> VersionedTable:
        return VersionedTable(f"{self.path.rstrip('/')}/_state", _STATE)

    def publish(self, messages: DataFrame, batch: int, order: Sequence[str] = (), rows_per_file: int = 0) -> bool:
        """Add ``key, value`` rows, and ``timestamp`` where there is one, as batch number ``batch``.

        Rows of a key are put in the order of the columns ``order``, then of
        their value. Rows without key are spread by their value and have no
        sequence number. Rows are range partitioned, so a key of any size is
        shared by several tasks; they are numbered from counts per task and key.
        Returns whether the batch is new.
        """
        spark = messages.sparkSession
        version = self.state.version(spark)
        state = self.state.read(spark, version)
        if not state.where(F.col("key").isNull() & (F.col("batch") == batch)).isEmpty():
            return False
        folder = f"{self.path.rstrip('/')}/_staged/{uuid.uuid4().hex}"
        place = ["partition", "key", *order, "value"]
        stamped = messages if "timestamp" in messages.columns else messages.withColumn("timestamp", F.current_timestamp())
        (
            stamped.withColumn("partition", F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(self.partitions)).cast("int"))
            .repartitionByRange(*place)
            .sortWithinPartitions(*place)
            .select("partition", "key", "timestamp", "value", F.spark_partition_id().alias("slice"))
            .withColumn("at", F.monotonically_increasing_id())
            .write.parquet(folder)
        )
        staged = spark.read.parquet(folder)

        # A run is what one task holds of a key; runs follow each other as they are numbered.
        runs = staged.groupBy("partition", "key", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))

        def earlier(*group: str) -> Column:
            window = Window.partitionBy(*group).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
            return F.coalesce(F.sum("n").over(window), F.lit(0))

        tops = state.where(F.col("key").isNull()).groupBy("partition").agg(F.max("next").alias("top"))
        keys = state.where(F.col("key").isNotNull()).select("key", F.col("next").alias("known"))
        runs = (
            runs.withColumns({"offset": earlier("partition"), "sequence": earlier("partition", "key")})
            .join(tops, "partition", "left")
            .join(keys, "key", "left")
            .select(
                "partition", "key", "slice", "n", "start",
                (F.col("offset") + F.coalesce("top", F.lit(0))).alias("offset"),
                F.when(F.col("key").isNotNull(), F.col("sequence") + F.coalesce("known", F.lit(0))).alias("sequence"),
            )
        )
        run = runs.alias("run")
        same = (
            (F.col("row.slice") == F.col("run.slice"))
            & (F.col("row.partition") == F.col("run.partition"))
            & F.col("row.key").eqNullSafe(F.col("run.key"))
        )
        within = F.col("row.at") - F.col("run.start")
        numbered = (
            staged.alias("row")
            .join(run, same)
            .select(
                F.lit(self.topic).alias("topic"), "row.partition", (F.col("run.offset") + within).alias("offset"),
                "row.timestamp", "row.value", "row.key", (F.col("run.sequence") + within).alias("sequence"),
            )
        )
        name = f"batch-{batch:010d}-{uuid.uuid4().hex}"
        (
            numbered.repartitionByRange("partition", "offset")
            .sortWithinPartitions("partition", "offset")
            .write.option("maxRecordsPerFile", rows_per_file)
            .parquet(f"{self.path.rstrip('/')}/{name}")
        )

        added = runs.groupBy("partition").agg(
            F.min("offset").alias("first"), F.max(F.col("offset") + F.col("n")).alias("next")
        )
        added = added.select(
            F.lit(batch).cast("long").alias("batch"), "partition", F.lit(None).cast("string").alias("key"),
            "first", "next", F.lit(name).alias("folder"),
        )
        counted = runs.where(F.col("key").isNotNull()).select(
            "partition", "key", (F.col("sequence") + F.col("n")).alias("next")
        )
        known = state.where(F.col("key").isNotNull()).select("partition", "key", "next")
        ahead = known.union(counted).groupBy("partition", "key").agg(F.max("next").alias("next"))
        ahead = ahead.select(
            F.lit(None).cast("long").alias("batch"), "partition", "key", F.lit(0).cast("long").alias("first"),
            "next", F.lit(None).cast("string").alias("folder"),
        )
        kept = state.where(F.col("key").isNull()).select(*_STATE.fieldNames())
        self.state.replace(kept.union(added).union(ahead).coalesce(1), version)
        return True

    def ends(self, spark: SparkSession) -> dict[int, int]:
        """The offset after the last, by partition."""
        runs = self.state.read(spark).where(F.col("key").isNull())
        found = dict(tuple(r) for r in runs.groupBy("partition").agg(F.max("next")).collect())
        return {p: found.get(p, 0) for p in range(self.partitions)}

    def read(self, spark: SparkSession, ranges: Ranges | None = None) -> DataFrame:
        """The messages of some ranges of offsets, or all. Opens only batches that reach into a range."""
        runs = self.state.read(spark).where(F.col("key").isNull())
        wanted = None
        if ranges is not None:
            spans = [(p, a, b) for p, (a, b) in ranges.items() if a < b]
            if not spans:
                return spark.createDataFrame([], TOPIC_SCHEMA)
            reached = [(F.col("partition") == p) & (F.col("first") < b) & (F.col("next") > a) for p, a, b in spans]
            runs = runs.where(reduce(or_, reached))
            wanted = reduce(or_, [(F.col("partition") == p) & F.col("offset").between(a, b - 1) for p, a, b in spans])
        folders = [f"{self.path.rstrip('/')}/{r[0]}" for r in runs.select("folder").distinct().collect()]
        if not folders:
            return spark.createDataFrame([], TOPIC_SCHEMA)
        rows = spark.read.schema(TOPIC_SCHEMA).parquet(*folders)
        return rows if wanted is None else rows.where(wanted)


def order_report(messages: DataFrame) -> DataFrame:
    """Per key its messages, how many numbers are missing or repeated, and how many come before their predecessor.

    Every message is joined to the next number of its key, so a key of any size is spread.
    """
    keyed = messages.where(F.col("key").isNotNull()).select("key", "sequence", "offset")
    numbers = keyed.groupBy("key", "sequence").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")
    )
    before = numbers.select("key", (F.col("sequence") + 1).alias("sequence"), F.col("high").alias("previous"))
    joined = numbers.join(before, ["key", "sequence"], "left")
    return joined.groupBy("key").agg(
        F.sum("n").alias("messages"),
        (F.max("sequence") + 1 - F.count(F.lit(1))).alias("missing"),
        F.sum(F.col("n") - 1).alias("repeated"),
        F.count_if(F.col("low") <= F.col("previous")).alias("out_of_order"),
    )
