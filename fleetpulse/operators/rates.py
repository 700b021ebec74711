"""Operational rates, counts and lags over trailing windows.

A snapshot looks at the window that ends at ``as_of``. A series evaluates the
same window at every step. Counts are exact: a window ``(t - w, t]`` holds the
rows it holds, nothing is extrapolated at its ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.histogram import histogram, histogram_quantiles
from fleetpulse.functions.times import bucket_ceil, trailing
from fleetpulse.schemas import BATCH_ROW_BUCKETS, PROCESSING_BUCKETS, WRITE_BUCKETS

MINUTE = 60
# Fixed value: the rules of the gear train, matched as a whole name.
GEAR_TRAIN_RULES = r"^(bearing_temp.*|gearbox_sump.*|gear_temp.*)$"


def count_in_window(df: DataFrame, ts: str, as_of, window: int, keys: Sequence[str] = (), name: str = "cnt") -> DataFrame:
    return df.where(trailing(ts, as_of, window)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rate_in_window(
    df: DataFrame, ts: str, as_of, window: int, keys: Sequence[str] = (), per: float = 1.0, name: str = "rate"
) -> DataFrame:
    """Rows per ``per`` seconds in the window that ends at ``as_of``."""
    counted = count_in_window(df, ts, as_of, window, keys)
    return counted.select(*keys, (F.col("cnt") * F.lit(float(per)) / F.lit(float(window))).alias(name))


def rate_series(
    df: DataFrame, ts: str, step: int, window: int, keys: Sequence[str] = (), per: float = 1.0, name: str = "rate"
) -> DataFrame:
    """Rate at every step whose trailing window holds rows.

    Rows are counted per step first. Only those counts are spread over the
    windows that cover them, so the input is shuffled once, already reduced.
    """
    if window % step:
        raise ValueError("the window has to be a multiple of the step")
    counted = df.groupBy(bucket_ceil(F.col(ts), step).alias("_step"), *keys).agg(F.count(F.lit(1)).alias("_cnt"))
    shifts = F.sequence(*[F.lit(seconds * 1_000_000).cast("bigint") for seconds in (0, window - step, step)])
    spread = counted.select(*keys, "_step", "_cnt", F.explode(shifts).alias("_shift"))
    at = F.timestamp_micros(F.unix_micros("_step") + F.col("_shift"))
    return (
        spread.groupBy(at.alias("at"), *keys)
        .agg(F.sum("_cnt").alias("_cnt"))
        .select("at", *keys, (F.col("_cnt") * F.lit(float(per)) / F.lit(float(window))).alias(name))
    )


def events_per_minute(readings: DataFrame, as_of, ts: str = "producer_ts") -> DataFrame:
    return rate_in_window(readings, ts, as_of, MINUTE, per=MINUTE, name="events_per_minute")


def events_per_minute_series(readings: DataFrame, ts: str = "producer_ts") -> DataFrame:
    return rate_series(readings, ts, MINUTE, MINUTE, per=MINUTE, name="events_per_minute")


def inserts_per_minute(telemetry: DataFrame, as_of) -> DataFrame:
    """Rows stored per minute."""
    return rate_in_window(telemetry, "ingested_at", as_of, MINUTE, per=MINUTE, name="inserts_per_minute")


def recent_activity(readings: DataFrame, alerts: DataFrame, dlq: DataFrame, as_of, window: int = 5 * MINUTE) -> DataFrame:
    """Alerts, dead letters and active machines in the window, in one row."""
    active = readings.where(trailing("producer_ts", as_of, window)).agg(
        F.countDistinct("turbine_id").alias("active_turbines")
    )
    # Each side is a global aggregate of exactly one row.
    return (
        count_in_window(alerts, "alert_ts", as_of, window, name="alert_count")
        .crossJoin(count_in_window(dlq, "failed_at", as_of, window, name="dlq_count"))
        .crossJoin(active)
    )


def event_rate_by_turbine(readings: DataFrame, as_of, window: int = MINUTE, ts: str = "producer_ts") -> DataFrame:
    return rate_in_window(readings, ts, as_of, window, ["turbine_id"])


def event_rate_by_turbine_series(
    readings: DataFrame, step: int, window: int, ts: str = "producer_ts"
) -> DataFrame:
    return rate_series(readings, ts, step, window, ["turbine_id"])


def consumption_rate(batch_stats: DataFrame, as_of, window: int = MINUTE) -> DataFrame:
    """Rows consumed per second by streaming query, from its batch statistics."""
    read = batch_stats.where((F.col("table_name") == "messages") & trailing("finished_at", as_of, window))
    return read.groupBy("query_name").agg((F.sum("row_count") / F.lit(float(window))).alias("rate"))


def alert_rate(alerts: DataFrame, as_of, window: int = 2 * MINUTE, severity: str | None = None) -> DataFrame:
    """Alerts per second by rule and severity, or of one severity."""
    if severity:
        alerts = alerts.where(F.col("severity") == severity)
    return rate_in_window(alerts, "alert_ts", as_of, window, ["rule_name", "severity"])


def alert_rate_series(alerts: DataFrame, step: int, window: int) -> DataFrame:
    return rate_series(alerts, "alert_ts", step, window, ["rule_name", "severity"])


def gear_train_alert_rate(alerts: DataFrame, as_of, window: int = 2 * MINUTE) -> DataFrame:
    """Alert rate of the bearing, gearbox and gear rules."""
    return alert_rate(alerts.where(F.col("rule_name").rlike(GEAR_TRAIN_RULES)), as_of, window)


def dlq_rate(dlq: DataFrame, as_of, window: int = 2 * MINUTE) -> DataFrame:
    return rate_in_window(dlq, "failed_at", as_of, window, ["error_type"])


def failure_counts(dlq: DataFrame) -> DataFrame:
    """Refused readings by reason, all time."""
    return dlq.groupBy("error_type").agg(F.count(F.lit(1)).alias("failures"))


def lag_seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def lag_by_turbine(readings: DataFrame) -> DataFrame:
    """Seconds from measurement to publication of the last published reading."""
    lag = lag_seconds(F.col("producer_ts"), F.col("recorded_at"))
    return readings.groupBy("turbine_id").agg(F.max_by(lag, "producer_ts").alias("lag_s"))


def latency_quantiles(
    readings: DataFrame,
    as_of=None,
    window: int = 2 * MINUTE,
    processed_at: str = "producer_ts",
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Processing latency estimated from the fixed buckets."""
    if as_of is not None:
        readings = readings.where(trailing(processed_at, as_of, window))
    timed = readings.withColumn("latency_s", lag_seconds(F.col(processed_at), F.col("recorded_at")))
    return histogram_quantiles(timed, "latency_s", PROCESSING_BUCKETS, quantiles, keys)


def write_latency(batch_stats: DataFrame, as_of=None, window: int = 2 * MINUTE, q: float = 0.95) -> DataFrame:
    """Estimated write time by table."""
    if as_of is not None:
        batch_stats = batch_stats.where(trailing("finished_at", as_of, window))
    return histogram_quantiles(batch_stats, "elapsed_s", WRITE_BUCKETS, [q], ["table_name"])


def batch_sizes(batch_stats: DataFrame) -> DataFrame:
    """Histogram of rows per batch by table: cumulative counts per bound, then all batches."""
    return histogram(batch_stats, "row_count", BATCH_ROW_BUCKETS, ["table_name"])
