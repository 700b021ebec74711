"""Counts, snapshots and recent-row lists over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fleetpulse.functions.text import round_exact
from fleetpulse.functions.times import after, seconds_before, time_range

MINUTE, HOUR, DAY = 60, 3600, 86400
LARGEST_ALERT_PAGE = 500


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("rule_name", "severity")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "rule_name", "severity")
    )


def alert_summary(alerts: DataFrame, as_of) -> DataFrame:
    """Alerts by severity: last hour, last day, all time."""
    return alerts.groupBy("severity").agg(
        F.count_if(after("alert_ts", as_of, HOUR)).alias("last_1h"),
        F.count_if(after("alert_ts", as_of, DAY)).alias("last_24h"),
        F.count(F.lit(1)).alias("all_time"),
    )


def fleet_snapshot(
    telemetry: DataFrame, alerts: DataFrame, as_of, window: int = 5 * MINUTE, alert_window: int = HOUR
) -> DataFrame:
    """Machines seen and mean power and wind lately, with the alerts of the last hour.

    Averages are NULL only where no reading is in the window.
    """
    recent = time_range(telemetry, start=seconds_before(as_of, window))
    fleet = recent.where(after("recorded_at", as_of, window)).agg(
        F.countDistinct("turbine_id").alias("turbine_count"),
        round_exact(F.avg("power_output_kw"), 1).alias("avg_power_kw"),
        round_exact(F.avg("wind_speed_ms"), 2).alias("avg_wind_ms"),
    )
    # Both sides are global aggregates of exactly one row.
    return fleet.crossJoin(alert_totals(alerts, as_of, alert_window))


def alert_totals(alerts: DataFrame, as_of, window: int = HOUR) -> DataFrame:
    return alerts.where(after("alert_ts", as_of, window)).agg(
        F.count(F.lit(1)).alias("alerts_last_hour"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts_last_hour"),
    )


def table_counts(telemetry: DataFrame, alerts: DataFrame, dlq: DataFrame, as_of) -> DataFrame:
    """Eight labelled counts from one scan per table."""
    critical = F.col("severity") == "CRITICAL"
    per_table = (
        (
            telemetry,
            {
                "telemetry": F.count(F.lit(1)),
                "telemetry last 5m": F.count_if(after("recorded_at", as_of, 5 * MINUTE)),
                "telemetry last 1h": F.count_if(after("recorded_at", as_of, HOUR)),
            },
        ),
        (
            alerts,
            {
                "alerts": F.count(F.lit(1)),
                "alerts last 1h": F.count_if(after("alert_ts", as_of, HOUR)),
                "alerts CRITICAL last 1h": F.count_if(critical & after("alert_ts", as_of, HOUR)),
            },
        ),
        (
            dlq,
            {
                "dlq": F.count(F.lit(1)),
                "dlq unresolved": F.count_if(~F.col("resolved")),
            },
        ),
    )
    report = None
    for table, counts in per_table:
        one_row = table.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts.values())])
        pairs = [F.struct(F.lit(k).alias("label"), F.col(f"n{i}").alias("cnt")) for i, k in enumerate(counts)]
        lines = one_row.select(F.inline(F.array(*pairs)))
        report = lines if report is None else report.unionByName(lines)
    return report


def recent_alerts(alerts: DataFrame, limit: int = 50, severity: str | None = None) -> DataFrame:
    """Newest alerts by event time, at most 500 a page, on request of one severity."""
    if severity:
        alerts = alerts.where(F.col("severity") == severity.upper())
    return (
        alerts.orderBy(F.desc("recorded_at"), "alert_id")
        .limit(min(limit, LARGEST_ALERT_PAGE))
        .select("alert_id", "turbine_id", "recorded_at", "severity", "rule_name", "message", "metric_value")
    )


def recent_alerts_by_alert_ts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """Newest alerts by processing time."""
    return (
        alerts.orderBy(F.desc("alert_ts"), "alert_id")
        .limit(limit)
        .select("turbine_id", F.col("recorded_at").alias("ts"), "severity", "rule_name", "metric_value")
    )


def recent_dlq(dlq: DataFrame, limit: int = 20) -> DataFrame:
    return (
        dlq.orderBy(F.desc("failed_at"), "dlq_id")
        .limit(limit)
        .select(
            "dlq_id", "original_topic", "error_type", F.col("failed_at").alias("ts"), "retry_count", "resolved"
        )
    )


def tail_messages(messages: DataFrame, n: int, spread: int = 64) -> DataFrame:
    """The last ``n`` messages of every topic partition.

    A first ranking in ``spread`` parts of each topic partition keeps a large one
    out of a single task; at most ``spread * n`` rows of it meet in the second.
    """
    newest = [F.desc("offset")]
    parts = Window.partitionBy("topic", "partition", F.pmod(F.hash("offset"), F.lit(spread)))
    messages = messages.withColumn("_n", F.row_number().over(parts.orderBy(*newest))).where(F.col("_n") <= n).drop("_n")
    place = F.row_number().over(Window.partitionBy("topic", "partition").orderBy(*newest))
    return messages.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")


def partition_report(telemetry: DataFrame, limit: int = 10) -> DataFrame:
    """Newest days of the readings: range, rows, first and last instant."""
    day = F.col("event_date") if "event_date" in telemetry.columns else F.to_date("recorded_at")
    return (
        telemetry.groupBy(day.alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("recorded_at").alias("first_at"),
            F.max("recorded_at").alias("last_at"),
        )
        .select(
            "event_date",
            F.col("event_date").cast("timestamp").alias("range_start"),
            F.date_add("event_date", 1).cast("timestamp").alias("range_end"),
            "rows",
            "first_at",
            "last_at",
        )
        .orderBy(F.desc("event_date"))
        .limit(limit)
    )
