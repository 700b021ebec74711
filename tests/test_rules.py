from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.rules import RULES, Rule, detect
from fleetpulse.plans import event_feed
from fleetpulse.sources.extracts import read_alerts_csv, read_telemetry_csv, write_csv

# What the rules are to do, apart from how they are written: limits of single sensors, and what goes with them.
LIMITS = {
    "temperature_c": {85: "nacelle_temp_warning", 95: "nacelle_temp_critical"},
    "vibration_mms": {6: "vibration_warning", 9: "vibration_critical"},
    "rotor_rpm": {18: "rotor_overspeed"},
    "blade_pitch_deg": {88: "blade_pitch_extreme"},
    "bearing_temp_c": {60: "bearing_temp_warning", 70: "bearing_temp_critical"},
    "gearbox_sump_temp_c": {95: "gearbox_sump_temp_warning", 120: "gearbox_sump_temp_critical"},
    "gear_temp_c": {250: "gear_temp_warning", 320: "gear_temp_critical"},
}
POWER = ("wind_speed_ms", "rotor_rpm", "power_output_kw")
LOW, DROPOUT, DOWN = "low_power_output", "power_dropout", "unplanned_downtime"
# Each border of the power rules from both sides.
POWER_CASES = {
    (5.25, 1.25, 49.75): {LOW},
    (5.0, 1.25, 49.75): set(),
    (5.25, 1.0, 49.75): set(),
    (5.25, 1.25, 50.0): set(),
    (8.25, 2.25, 4.75): {LOW, DROPOUT},
    (8.0, 2.25, 4.75): {LOW},
    (8.25, 2.0, 4.75): {LOW},
    (8.25, 2.25, 5.0): {LOW},
    (3.25, 0.05, 0.75): {DOWN},
    (3.0, 0.05, 0.75): set(),
    (3.25, 0.1, 0.75): set(),
    (3.25, 0.05, 1.0): set(),
    (None, 2.25, 4.75): set(),
    (8.25, None, 4.75): set(),
    (8.25, 2.25, None): set(),
}


def _cases():
    yield {}, set()
    for metric, limits in LIMITS.items():
        yield {metric: None}, set()
        for value in [limit + step for limit in limits for step in (-0.25, 0.0, 0.25)]:
            yield {metric: value}, {name for limit, name in limits.items() if value > limit}
    for values, expected in POWER_CASES.items():
        yield dict(zip(POWER, values)), expected
    yield {"blade_pitch_deg": 88.25, "wind_speed_ms": 19.75}, {"blade_pitch_extreme"}
    yield {"blade_pitch_deg": 88.25, "wind_speed_ms": 20.0}, set()
    for (one, first), (two, second) in zip(list(LIMITS.items()), list(LIMITS.items())[1:]):
        both = {one: max(first) + 0.25, two: max(second) + 0.25, "status": "maintenance"}
        yield both, {*first.values(), *second.values()}


CASES = list(_cases())


def test_rules_fire_as_expected(readings):
    rows = detect(readings(*[change for change, _ in CASES])).collect()
    found = {}
    for row in rows:
        found.setdefault(row["source_event_id"], set()).add(row["rule_name"])
    wrong = [(c, e, found.get(f"e{i}", set())) for i, (c, e) in enumerate(CASES) if found.get(f"e{i}", set()) != e]
    assert not wrong


def test_alert_carries_the_reading(readings):
    alerts = detect(readings({"temperature_c": 86.5}), alert_ts=F.col("producer_ts"))
    (row,) = alerts.collect()
    assert row["metric_value"] == 86.5 and row["threshold"] == 85.0 and row["severity"] == "WARNING"
    assert row["message"] == "Nacelle temperature 86.5°C exceeds warning threshold 85.0°C"
    assert row["turbine_id"] == "turbine-08" and row["source_event_id"] == "e0"
    assert detect(readings({"temperature_c": 86.5})).first()["alert_id"] == row["alert_id"]


def test_message_numbers_are_formatted_like_c(readings):
    values = [9.005, 9.015, 9.125, 9.375, 12.345, 10.235, 49.995]
    rows = detect(readings(*[{"vibration_mms": v} for v in values])).where("rule_name = 'vibration_critical'")
    shown = {r["metric_value"]: r["message"] for r in rows.collect()}
    assert shown == {v: f"CRITICAL: Vibration {v:.2f} mm/s — imminent mechanical failure risk" for v in values}


def test_every_message_matches_the_format_of_its_template(spark, sf_dir):
    from fleetpulse.operators.rules import MESSAGE_FIELDS

    feed = event_feed.readings(spark, sf_dir)
    templates = {r.name: r for r in RULES}
    joined = detect(feed).join(feed.select(F.col("event_id").alias("source_event_id"), *MESSAGE_FIELDS.values()), "source_event_id")
    rows = joined.collect()
    assert {r["rule_name"] for r in rows} == set(templates)
    for row in rows:
        fields = {short: row[column] for short, column in MESSAGE_FIELDS.items()}
        rule = templates[row["rule_name"]]
        assert row["message"] == rule.message.format(value=row["metric_value"], threshold=rule.threshold, **fields)


def test_own_rules(readings):
    rules = [
        Rule("cold", "WARNING", "temperature_c", -10.0, lambda: F.col("temperature_c") < -10, "cold: {value:.1f} below {threshold}"),
        Rule("any", "CRITICAL", "rotor_rpm", 0.0, "rotor_rpm >= 0", "rpm {rpm:.0f}"),
    ]
    rows = {r["rule_name"]: r["message"] for r in detect(readings({"temperature_c": -20.0}), rules).collect()}
    assert rows == {"cold": "cold: -20.0 below -10.0", "any": "rpm 11"}


def test_detect_is_one_pass(spark, sf_dir):
    plan = detect(event_feed.readings(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
    assert plan.count("Generate ") == 1


def test_known_counts_per_rule(spark, sf_dir):
    """Counts of the fixed projection at the smallest scale."""
    expected = dict(
        zip([r.name for r in RULES], [223, 132, 441, 162, 140, 10, 172, 20, 77, 199, 100, 221, 63, 237, 70])
    )
    counted = detect(event_feed.readings(spark, sf_dir)).groupBy("rule_name").count().collect()
    assert {r["rule_name"]: r["count"] for r in counted} == expected


def test_readings_from_an_extract_give_these_alerts(readings, spark, tmp_path):
    """Written out, read back and detected: the alerts word for word."""
    rows = readings(
        {"temperature_c": 95.5},
        {"wind_speed_ms": 8.5, "rotor_rpm": 2.5, "power_output_kw": 4.25},
        {"gear_temp_c": 320.5, "bearing_temp_c": 60.25},
        {},
    )
    write_csv(rows, str(tmp_path / "telemetry"))
    found = detect(read_telemetry_csv(spark, str(tmp_path / "telemetry")))
    assert sorted((r["source_event_id"], r["severity"], r["message"]) for r in found.collect()) == [
        ("e0", "CRITICAL", "CRITICAL: Nacelle temperature 95.5°C — emergency shutdown risk"),
        ("e0", "WARNING", "Nacelle temperature 95.5°C exceeds warning threshold 85.0°C"),
        ("e1", "CRITICAL", "CRITICAL: Power dropout — 4.2 kW at wind 8.5 m/s with RPM 2.5"),
        ("e1", "WARNING", "Low power 4 kW at wind speed 8.5 m/s — possible curtailment or underperformance"),
        ("e2", "CRITICAL", "CRITICAL: Gear temperature 320.5°C — gear tooth damage risk"),
        ("e2", "WARNING", "Bearing temperature 60.2°C exceeds warning threshold 60.0°C — check lubrication"),
        ("e2", "WARNING", "Gear mesh temperature 320.5°C — elevated friction or lubrication loss"),
    ]


@pytest.mark.skipif("TELEMETRY_EXTRACTS" not in os.environ, reason="folder with CSV extracts not given")
def test_extract_of_real_readings_gives_its_alerts(spark):
    """The alerts of an extract whose readings are in it are exactly those the rules raise."""
    folder = Path(os.environ["TELEMETRY_EXTRACTS"])
    telemetry = read_telemetry_csv(spark, str(next(folder.glob("telemetry*.csv"))))
    alerts = read_alerts_csv(spark, str(next(folder.glob("alerts*.csv"))))
    names = ["source_event_id", "rule_name", "severity", "message", "metric_name", "metric_value", "threshold", "recorded_at"]
    known = alerts.join(telemetry.select(F.col("event_id").alias("source_event_id")), "source_event_id", "left_semi")
    raised = {tuple(r) for r in detect(telemetry).select(*names).collect()}
    assert raised == {tuple(r) for r in known.select(*names).collect()} and raised
