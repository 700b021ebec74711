"""Log files with one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.functions.text import strip


# A frequent line of a file is counted in so many parts.
SPREAD = 16


def _as_lines(df: DataFrame, topic: str, received_at: Column | None) -> DataFrame:
    stamp = F.col("_metadata.file_modification_time") if received_at is None else received_at
    return df.select(
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        stamp.cast("timestamp").alias("timestamp"),
        strip(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("origin"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Give every line of a batch an ``origin`` of its own, and its order of arrival as ``offset``.

    The origin is the file, a hash of the line and its number among the equal
    lines of that file. So it is the same however the file is split, whenever
    and wherever it is read: ids that follow from it make a second run harmless.
    Equal lines are counted, not ranked; they share the offset of the first.
    """
    keys = [c for c in lines.columns if c != "offset"]
    counted = (
        lines.withColumn("offset", F.monotonically_increasing_id())
        .groupBy(*keys, F.pmod("offset", F.lit(SPREAD)).alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("offset").alias("offset"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    numbered = counted.withColumn("_before", before).withColumn(
        "_number", F.explode(F.sequence(F.col("_before"), F.col("_before") + F.col("_n") - 1))
    )
    origin = F.concat_ws("#", "origin", F.md5("value"), "_number")
    return numbered.withColumn("origin", origin).select(*lines.columns)


def read_log(spark: SparkSession, path: str, topic: str = "raw", received_at: Column | None = None) -> DataFrame:
    """All lines of the files as messages; blank lines have an empty ``value``.

    A line counts as received when its file was last written, so that reading it
    again files its dead letter under the same day.
    """
    return number_lines(_as_lines(spark.read.text(path), topic, received_at))


def stream_log(
    spark: SparkSession,
    path: str,
    topic: str = "raw",
    max_files: int | None = None,
    received_at: Column | None = None,
) -> DataFrame:
    """New log files as they arrive; lines are numbered per micro-batch."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _as_lines(reader.load(path), topic, received_at)


def skip_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value") != "")
