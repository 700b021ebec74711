"""Reading a topic kept as files: batches by offsets, bounded in rows and in waiting time."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetpulse.schemas import MESSAGE_SCHEMA
from fleetpulse.sources.topic_files import TopicFiles
from fleetpulse.sources.versions import VersionedTable
from fleetpulse.streaming.process import FLUSH_SECONDS

# Fixed value: a batch is flushed at 100 rows.
FLUSH_ROWS = 100

_PROGRESS = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("next", T.LongType()),
        T.StructField("done", T.BooleanType()),
    ]
)
Write = Callable[[DataFrame, int], None]


def shares(waiting: dict[int, int], most: int) -> dict[int, int]:
    """``most`` rows over partitions: equal shares, and what one does not need goes to the others."""
    given = dict.fromkeys(waiting, 0)
    open_ones, left = [p for p, n in sorted(waiting.items()) if n], most
    while open_ones and left:
        share, over = divmod(left, len(open_ones))
        for i, p in enumerate(open_ones):
            take = min(waiting[p] - given[p], share + (i < over))
            given[p] += take
            left -= take
        open_ones = [p for p in open_ones if given[p] < waiting[p]]
    return given


@dataclass(frozen=True)
class TopicConsumer:
    """One reader of a topic, with its offsets in a table of its own at ``progress``.

    It starts at the earliest offset. A batch is planned, written and closed: its
    ranges are entered before ``write`` runs and marked after. A reader that is
    lost in between runs the same ranges under the same batch number again, so an
    idempotent ``write`` stores every message once; two readers cannot share a
    progress table.
    """

    topic: TopicFiles
    progress: str
    max_rows: int = FLUSH_ROWS
    flush_seconds: float = FLUSH_SECONDS

    @property
    def _table(self) -> VersionedTable:
        return VersionedTable(self.progress, _PROGRESS)

    def _enter(self, spark: SparkSession, version: int, batch: int, ranges: dict, done: bool) -> int:
        rows = [(batch, p, first, end, done) for p, (first, end) in sorted(ranges.items())]
        return self._table.replace(spark.createDataFrame(rows, _PROGRESS).coalesce(1), version)

    def _position(self, spark: SparkSession) -> tuple[int, int, dict[int, tuple[int, int]], bool]:
        """Version of the progress, last batch, its ranges, and whether it was closed."""
        version = self._table.version(spark)
        rows = self._table.read(spark, version).collect() if version else []
        ranges = {r["partition"]: (r["first"], r["next"]) for r in rows}
        return version, rows[0]["batch"] if rows else -1, ranges, all(r["done"] for r in rows)

    def waiting(self, spark: SparkSession) -> int:
        """Messages that no closed batch has read."""
        _, _, ranges, done = self._position(spark)
        read = {p: end if done else first for p, (first, end) in ranges.items()}
        return sum(end - read.get(p, 0) for p, end in self.topic.ends(spark).items())

    def step(self, spark: SparkSession, write: Write) -> int:
        """Read and write the next batch, or the one that was begun; returns its rows."""
        version, batch, ranges, done = self._position(spark)
        if done:
            begin = {p: ranges.get(p, (0, 0))[1] for p in range(self.topic.partitions)}
            ends = self.topic.ends(spark)
            take = shares({p: ends[p] - begin[p] for p in begin}, self.max_rows)
            if not any(take.values()):
                return 0
            batch, ranges = batch + 1, {p: (begin[p], begin[p] + take[p]) for p in begin}
            version = self._enter(spark, version, batch, ranges, False)
        # A range lies in few files, often in one run of them: without an exchange few tasks have all its rows.
        rows = self.topic.read(spark, ranges).select(*MESSAGE_SCHEMA.fieldNames())
        write(rows.repartition("partition", "offset"), batch)
        self._enter(spark, version, batch, ranges, True)
        return sum(end - first for first, end in ranges.values())

    def drain(self, spark: SparkSession, write: Write) -> int:
        """Work off what is there; returns the number of batches."""
        batches = 0
        while self.step(spark, write):
            batches += 1
        return batches

    def follow(
        self,
        spark: SparkSession,
        write: Write,
        stopped: Callable[[], bool],
        clock: Callable[[], float] = time.monotonic,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        """Read until ``stopped``: a batch begins when ``max_rows`` wait, or ``flush_seconds`` after the first did."""
        since = None
        while not stopped():
            waiting = self.waiting(spark)
            if waiting and since is None:
                since = clock()
            if waiting and (waiting >= self.max_rows or clock() - since >= self.flush_seconds):
                self.step(spark, write)
                since = None
            else:
                sleep(self.flush_seconds / 20)
