"""Jobs over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators import dlq as letters
from fleetpulse.operators.dedup import DLQ_KEY
from fleetpulse.operators.rules import RULES, Rule, detect
from fleetpulse.schemas import DLQ_SCHEMA, with_day
from fleetpulse.sources.tables import EVENT_DAY, upsert
from fleetpulse.streaming.process import Store


def replay_stored_dlq(
    spark: SparkSession,
    store: Store,
    letters_to_replay: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    first_day=None,
    last_day=None,
) -> dict[str, int]:
    """Read unresolved dead letters again; store what is good by now.

    ``first_day`` and ``last_day`` limit the days of the table that are read.
    The days of the replayed letters are rewritten: letters that the main stream
    adds to them meanwhile are lost, so replay days that are closed, or stop it.

    Recovered readings and their alerts are inserted first, which can be
    repeated safely; then the letters get their new state, in their own days
    only. A run that fails in between is simply run again.
    """
    waiting = store.dlq(spark) if letters_to_replay is None else letters_to_replay
    if first_day is not None:
        waiting = waiting.where(F.col(EVENT_DAY) >= F.lit(first_day))
    if last_day is not None:
        waiting = waiting.where(F.col(EVENT_DAY) <= F.lit(last_day))
    replayed = letters.replay(waiting).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        summary = letters.replay_summary(replayed).first().asDict()
        readings = letters.recovered_readings(replayed).withColumn("ingested_at", F.current_timestamp())
        store.insert_telemetry(readings)
        store.insert_alerts(detect(readings, rules, F.col("ingested_at")))
        tried = replayed.where(F.col("action") != "skipped")
        outcome = letters.replay_outcome(tried, keep=[EVENT_DAY])
        upsert(outcome, store.path("dlq"), DLQ_KEY, EVENT_DAY, with_day(DLQ_SCHEMA))
        return summary
    finally:
        replayed.unpersist()
