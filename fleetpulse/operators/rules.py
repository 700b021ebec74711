"""Threshold rules as data, and the operator that applies them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.text import fixed, stable_id
from fleetpulse.schemas import ALERT_COLUMNS

# Names a message may use besides ``value`` and ``threshold``.
MESSAGE_FIELDS = {"wind_speed": "wind_speed_ms", "rpm": "rotor_rpm", "power": "power_output_kw"}


@dataclass(frozen=True)
class Rule:
    """A named condition on one reading.

    ``condition`` is a SQL predicate or a function that returns a column.
    ``message`` may use ``{value:.1f}``, ``{threshold}`` and the MESSAGE_FIELDS.
    """

    name: str
    severity: str
    metric: str
    threshold: float
    condition: str | Callable[[], Column]
    message: str

    def predicate(self) -> Column:
        return F.expr(self.condition) if isinstance(self.condition, str) else self.condition()

    def message_column(self) -> Column:
        parts = []
        for text, field, spec, _ in Formatter().parse(self.message):
            if text:
                parts.append(F.lit(text))
            if field == "threshold":
                parts.append(F.lit(str(float(self.threshold))))
            elif field:
                column = F.col(self.metric if field == "value" else MESSAGE_FIELDS[field])
                parts.append(fixed(column, int(spec.strip(".f"))) if spec else column.cast("string"))
        return F.concat(*parts)


# The standard rules, in order.
RULES: tuple[Rule, ...] = (
    Rule("nacelle_temp_warning", "WARNING", "temperature_c", 85.0, "temperature_c > 85",
         "Nacelle temperature {value:.1f}°C exceeds warning threshold {threshold}°C"),
    Rule("nacelle_temp_critical", "CRITICAL", "temperature_c", 95.0, "temperature_c > 95",
         "CRITICAL: Nacelle temperature {value:.1f}°C — emergency shutdown risk"),
    Rule("vibration_warning", "WARNING", "vibration_mms", 6.0, "vibration_mms > 6",
         "Vibration {value:.2f} mm/s RMS exceeds warning threshold {threshold} mm/s"),
    Rule("vibration_critical", "CRITICAL", "vibration_mms", 9.0, "vibration_mms > 9",
         "CRITICAL: Vibration {value:.2f} mm/s — imminent mechanical failure risk"),
    Rule("low_power_output", "WARNING", "power_output_kw", 50.0,
         "wind_speed_ms > 5 AND power_output_kw < 50 AND rotor_rpm > 1",
         "Low power {value:.0f} kW at wind speed {wind_speed:.1f} m/s — possible curtailment or underperformance"),
    Rule("power_dropout", "CRITICAL", "power_output_kw", 5.0,
         "wind_speed_ms > 8 AND power_output_kw < 5 AND rotor_rpm > 2",
         "CRITICAL: Power dropout — {value:.1f} kW at wind {wind_speed:.1f} m/s with RPM {rpm:.1f}"),
    Rule("unplanned_downtime", "CRITICAL", "rotor_rpm", 0.1,
         "wind_speed_ms > 3 AND rotor_rpm < 0.1 AND power_output_kw < 1",
         "CRITICAL: Unplanned downtime — RPM={value:.2f}, power={power:.0f} kW while wind={wind_speed:.1f} m/s"),
    Rule("blade_pitch_extreme", "WARNING", "blade_pitch_deg", 88.0, "blade_pitch_deg > 88 AND wind_speed_ms < 20",
         "Blade pitch {value:.1f}° at wind {wind_speed:.1f} m/s — feathered outside expected conditions"),
    Rule("rotor_overspeed", "CRITICAL", "rotor_rpm", 18.0, "rotor_rpm > 18",
         "CRITICAL: Rotor overspeed {value:.1f} RPM — protection system may activate"),
    Rule("bearing_temp_warning", "WARNING", "bearing_temp_c", 60.0, "bearing_temp_c > 60",
         "Bearing temperature {value:.1f}°C exceeds warning threshold {threshold}°C — check lubrication"),
    Rule("bearing_temp_critical", "CRITICAL", "bearing_temp_c", 70.0, "bearing_temp_c > 70",
         "CRITICAL: Bearing temperature {value:.1f}°C — imminent bearing failure risk"),
    Rule("gearbox_sump_temp_warning", "WARNING", "gearbox_sump_temp_c", 95.0, "gearbox_sump_temp_c > 95",
         "Gearbox sump temperature {value:.1f}°C — oil viscosity may be compromised"),
    Rule("gearbox_sump_temp_critical", "CRITICAL", "gearbox_sump_temp_c", 120.0, "gearbox_sump_temp_c > 120",
         "CRITICAL: Gearbox sump {value:.1f}°C — oil breakdown risk, shutdown advised"),
    Rule("gear_temp_warning", "WARNING", "gear_temp_c", 250.0, "gear_temp_c > 250",
         "Gear mesh temperature {value:.1f}°C — elevated friction or lubrication loss"),
    Rule("gear_temp_critical", "CRITICAL", "gear_temp_c", 320.0, "gear_temp_c > 320",
         "CRITICAL: Gear temperature {value:.1f}°C — gear tooth damage risk"),
)


def any_hit(rules: Sequence[Rule] = RULES) -> Column:
    """At least one rule hits the reading, so it has an alert."""
    return reduce(or_, [rule.predicate() for rule in rules])


def detect(readings: DataFrame, rules: Sequence[Rule] = RULES, alert_ts: Column | None = None) -> DataFrame:
    """Every rule hit as one alert row: 0..n alerts per reading.

    One pass: readings without any hit are dropped first by the union of the
    conditions, which also reaches a Parquet scan. The rest is expanded by rule
    and empty slots are dropped. A missing sensor value never hits.
    """
    stamp = F.current_timestamp() if alert_ts is None else alert_ts
    hits = [
        F.when(
            rule.predicate(),
            F.struct(
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.name).alias("rule_name"),
                rule.message_column().alias("message"),
                F.lit(rule.metric).alias("metric_name"),
                F.col(rule.metric).alias("metric_value"),
                F.lit(float(rule.threshold)).alias("threshold"),
            ),
        )
        for rule in rules
    ]
    alerts = (
        readings.where(any_hit(rules))
        .select(
            "turbine_id",
            "recorded_at",
            F.col("event_id").alias("source_event_id"),
            stamp.alias("alert_ts"),
            F.explode(F.array(*hits)).alias("hit"),
        )
        .where(F.col("hit").isNotNull())
        .select("turbine_id", "recorded_at", "source_event_id", "alert_ts", "hit.*")
    )
    alert_id = stable_id(F.col("source_event_id"), F.col("rule_name"))
    return alerts.withColumn("alert_id", alert_id).select(*ALERT_COLUMNS)
