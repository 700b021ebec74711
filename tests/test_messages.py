"""Decode, normalise and validate, case by case. All cases of a test share one Spark job."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import CURRENT, LEGACY
from fleetpulse.operators.validate import accepted, check_messages, ingest_summary, rejected
from fleetpulse.schemas import JSON_ERROR, SCHEMA_ERROR


def without(payload, *names):
    return {k: v for k, v in payload.items() if k not in names}


def checked_rows(messages, *payloads):
    return check_messages(messages(*payloads)).orderBy("offset").collect()


ACCEPTED = {
    "base": (CURRENT, {}),
    "wind at low bound": (CURRENT | {"wind_speed_ms": 0.0}, {"wind_speed_ms": 0.0}),
    "wind at high bound": (CURRENT | {"wind_speed_ms": 100.0}, {"wind_speed_ms": 100.0}),
    "offline": (CURRENT | {"status": "offline"}, {"status": "offline"}),
    "maintenance": (CURRENT | {"status": "maintenance"}, {"status": "maintenance"}),
    "fault": (CURRENT | {"status": "fault"}, {"status": "fault"}),
    "no status": (without(CURRENT, "status"), {"status": "online"}),
    "no vibration": (without(CURRENT, "vibration_mms"), {"vibration_mms": 0.0}),
    "id is trimmed": (CURRENT | {"turbine_id": "  turbine-07\t"}, {"turbine_id": "turbine-07"}),
    "id of 64 characters": (CURRENT | {"turbine_id": "x" * 64}, {"turbine_id": "x" * 64}),
    "numbers as text": (CURRENT | {"wind_speed_ms": "7.5", "rotor_rpm": " 3 "}, {"wind_speed_ms": 7.5, "rotor_rpm": 3.0}),
    "integers": (CURRENT | {"power_output_kw": 12}, {"power_output_kw": 12.0}),
    "all numbers as text": (
        CURRENT | {k: str(v) for k, v in CURRENT.items() if isinstance(v, float)},
        {k: v for k, v in CURRENT.items() if isinstance(v, float)},
    ),
    "id of 64 after trimming": (CURRENT | {"turbine_id": " " + "y" * 62 + " "}, {"turbine_id": "y" * 62}),
    "mixed layouts": (
        without(CURRENT, "wind_speed_ms", "recorded_at") | {"Wind_Speed": 4.5, "Timestamp": "2025-03-02 08:15:40"},
        {"wind_speed_ms": 4.5, "recorded_at": datetime(2025, 3, 2, 8, 15, 40), "turbine_id": CURRENT["turbine_id"]},
    ),
    "unknown keys": (CURRENT | {"extra": {"a": [1, {"b": "}"}]}}, {"turbine_id": CURRENT["turbine_id"]}),
    "sensor null": (CURRENT | {"bearing_temp_c": None}, {"bearing_temp_c": None}),
    "null keeps the older name out": (CURRENT | {"bearing_temp_c": None, "Bearing_Temp": 50}, {"bearing_temp_c": None}),
    "current name wins": (CURRENT | {"Wind_Speed": 1.0}, {"wind_speed_ms": CURRENT["wind_speed_ms"]}),
    "zone offset": (CURRENT | {"recorded_at": "2025-03-02T10:15:40+02:00"}, {"recorded_at": datetime(2025, 3, 2, 8, 15, 40)}),
    "Z": (CURRENT | {"recorded_at": "2025-03-02T08:15:40.250Z"}, {"recorded_at": datetime(2025, 3, 2, 8, 15, 40, 250000)}),
    "no zone": (CURRENT | {"recorded_at": "2025-03-02 08:15:40"}, {"recorded_at": datetime(2025, 3, 2, 8, 15, 40)}),
    "date only": (CURRENT | {"recorded_at": "2025-03-02"}, {"recorded_at": datetime(2025, 3, 2)}),
    "single digits": (CURRENT | {"recorded_at": "2024-6-5 4:2:1"}, {"recorded_at": datetime(2024, 6, 5, 4, 2, 1)}),
    "epoch seconds": (CURRENT | {"recorded_at": 1740903340}, {"recorded_at": datetime(2025, 3, 2, 8, 15, 40)}),
    "epoch millis": (CURRENT | {"recorded_at": 1740903340500}, {"recorded_at": datetime(2025, 3, 2, 8, 15, 40, 500000)}),
    "standing in wind": (
        CURRENT | {"wind_speed_ms": 8.0, "rotor_rpm": 0.0, "power_output_kw": 0.0}, {"status": "fault"}
    ),
    "standing in calm": (
        CURRENT | {"wind_speed_ms": 2.0, "rotor_rpm": 0.0, "power_output_kw": 0.0}, {"status": "online"}
    ),
    "standing in maintenance": (
        CURRENT | {"rotor_rpm": 0.0, "power_output_kw": 0.0, "status": "maintenance"}, {"status": "maintenance"}
    ),
    "own event id": (CURRENT | {"event_id": "abc"}, {"event_id": "abc"}),
    "white space around": ("  \n" + json.dumps(CURRENT) + "\t\n", {"turbine_id": CURRENT["turbine_id"]}),
    "last of equal keys": ('{"turbine_id": "old", ' + json.dumps(CURRENT)[1:], {"turbine_id": CURRENT["turbine_id"]}),
    "legacy": (
        LEGACY,
        {
            "turbine_id": "turbine-09",
            "recorded_at": datetime(2025, 3, 2, 8, 15, 40),
            "status": "online",
            "wind_speed_ms": 6.75,
            "wind_direction_deg": 48.5,
            "nacelle_position_deg": 51.25,
            "power_output_kw": 640.0,
            "rotor_rpm": 4.71,
            "hub_speed": 4.0,
            "blade_pitch_deg": 21.0,
            "vibration_mms": 0.0,
            "ambient_temp_c": -3.5,
            "temperature_c": 61.75,
            "bearing_temp_c": 38.5,
            "gearbox_sump_temp_c": 55.25,
            "gear_temp_c": 143.0,
        },
    ),
    "pitch 95": (LEGACY | {"BladePitchAngle": 95.0}, {"blade_pitch_deg": 5.0}),
    "pitch 180": (LEGACY | {"BladePitchAngle": 180.0}, {"blade_pitch_deg": 0.0}),
    "pitch 210": (LEGACY | {"BladePitchAngle": 210.0}, {"blade_pitch_deg": 30.0}),
    "pitch 90": (LEGACY | {"BladePitchAngle": 90.0}, {"blade_pitch_deg": 90.0}),
    "pitch below 0": (LEGACY | {"BladePitchAngle": -4.0}, {"blade_pitch_deg": 0.0}),
    "legacy numbers as text": (LEGACY | {"Generator_Speed": "38.2", "Hub_Speed": "2"}, {"rotor_rpm": 3.82, "hub_speed": 2.0}),
    "binary rounding": (LEGACY | {"Generator_Speed": 26.75}, {"rotor_rpm": 2.67}),
    "id 12": (LEGACY | {"Turbine_ID": "Turbine_12"}, {"turbine_id": "turbine-12"}),
    "id in new spelling": (LEGACY | {"Turbine_ID": "turbine-4"}, {"turbine_id": "turbine-04"}),
    "id is a number": (LEGACY | {"Turbine_ID": 5}, {"turbine_id": "turbine-05"}),
    "id without number": (LEGACY | {"Turbine_ID": "Turbine_X_1"}, {"turbine_id": "turbine-x-1"}),
    "id null": (LEGACY | {"Turbine_ID": None}, {"turbine_id": "none"}),
    "legacy standing": (
        LEGACY | {"Generator_Speed": 0, "Power": 0}, {"status": "fault", "rotor_rpm": 0.0}
    ),
}


def test_accepted_payloads(messages):
    rows = checked_rows(messages, *[payload for payload, _ in ACCEPTED.values()])
    wrong = []
    for (case, (_, expected)), row in zip(ACCEPTED.items(), rows, strict=True):
        found = row.asDict()
        if found["error_type"] is not None:
            wrong.append((case, found["error_message"]))
        wrong += [(case, name, found[name]) for name, value in expected.items() if found[name] != value]
    assert not wrong


REJECTED = {
    "no id": (without(CURRENT, "turbine_id"), SCHEMA_ERROR, "turbine_id"),
    "blank id": (CURRENT | {"turbine_id": "   "}, SCHEMA_ERROR, "turbine_id: blank"),
    "empty id": (CURRENT | {"turbine_id": ""}, SCHEMA_ERROR, "turbine_id: blank"),
    "long id": (CURRENT | {"turbine_id": " " + "x" * 64}, SCHEMA_ERROR, "over 64"),
    "numeric id": (CURRENT | {"turbine_id": 5}, SCHEMA_ERROR, "turbine_id"),
    "id null": (CURRENT | {"turbine_id": None, "Turbine_ID": "Turbine_1"}, SCHEMA_ERROR, "turbine_id"),
    "wind low": (CURRENT | {"wind_speed_ms": -1}, SCHEMA_ERROR, "wind_speed_ms: outside 0..100"),
    "wind high": (CURRENT | {"wind_speed_ms": 101}, SCHEMA_ERROR, "wind_speed_ms: outside 0..100"),
    "rpm low": (CURRENT | {"rotor_rpm": -0.1}, SCHEMA_ERROR, "rotor_rpm: outside"),
    "rpm high": (CURRENT | {"rotor_rpm": 31}, SCHEMA_ERROR, "rotor_rpm: outside"),
    "temperature high": (CURRENT | {"temperature_c": 151}, SCHEMA_ERROR, "temperature_c: outside -40..150"),
    "temperature low": (CURRENT | {"temperature_c": -41}, SCHEMA_ERROR, "temperature_c: outside"),
    "sensor out of range": (CURRENT | {"hub_speed": 51}, SCHEMA_ERROR, "hub_speed: outside 0..50"),
    "NaN": (CURRENT | {"wind_speed_ms": float("nan")}, SCHEMA_ERROR, "wind_speed_ms: outside"),
    "infinite": (CURRENT | {"wind_speed_ms": float("inf")}, SCHEMA_ERROR, "wind_speed_ms: outside"),
    "status": (CURRENT | {"status": "BROKEN"}, SCHEMA_ERROR, "status"),
    "status case": (CURRENT | {"status": "Online"}, SCHEMA_ERROR, "status"),
    "status null": (CURRENT | {"status": None}, SCHEMA_ERROR, "status"),
    "no wind": (without(CURRENT, "wind_speed_ms"), SCHEMA_ERROR, "wind_speed_ms: missing"),
    "no rpm": (without(CURRENT, "rotor_rpm"), SCHEMA_ERROR, "rotor_rpm: missing"),
    "no power": (without(CURRENT, "power_output_kw"), SCHEMA_ERROR, "power_output_kw: missing"),
    "no temperature": (without(CURRENT, "temperature_c"), SCHEMA_ERROR, "temperature_c: missing"),
    "no pitch": (without(CURRENT, "blade_pitch_deg"), SCHEMA_ERROR, "blade_pitch_deg: missing"),
    "no time": (without(CURRENT, "recorded_at"), SCHEMA_ERROR, "recorded_at"),
    "bad time": (CURRENT | {"recorded_at": "yesterday"}, SCHEMA_ERROR, "recorded_at"),
    "year only": (CURRENT | {"recorded_at": "2024"}, SCHEMA_ERROR, "recorded_at"),
    "month 13": (CURRENT | {"recorded_at": "2024-13-01 00:00:00"}, SCHEMA_ERROR, "recorded_at"),
    "number as time text": (CURRENT | {"recorded_at": "1740903340"}, SCHEMA_ERROR, "recorded_at"),
    "wind null": (CURRENT | {"wind_speed_ms": None, "Wind_Speed": 5}, SCHEMA_ERROR, "wind_speed_ms: missing"),
    "wind text": (CURRENT | {"wind_speed_ms": "fast"}, SCHEMA_ERROR, "wind_speed_ms: missing or not a number"),
    "wind list": (CURRENT | {"wind_speed_ms": [1]}, SCHEMA_ERROR, "wind_speed_ms: missing or not a number"),
    "vibration null": (CURRENT | {"vibration_mms": None}, SCHEMA_ERROR, "vibration_mms: not a number"),
    "sensor text": (CURRENT | {"bearing_temp_c": "hot"}, SCHEMA_ERROR, "wrong type: bearing_temp_c"),
    "legacy sensor text": (LEGACY | {"Bearing_Temp": "hot"}, SCHEMA_ERROR, "wrong type: bearing_temp_c"),
    "legacy rpm null": (LEGACY | {"Generator_Speed": None}, SCHEMA_ERROR, "rotor_rpm: missing"),
    "legacy pitch null": (LEGACY | {"BladePitchAngle": None}, SCHEMA_ERROR, "blade_pitch_deg: missing"),
    "event id null": (CURRENT | {"event_id": None}, SCHEMA_ERROR, "event_id: not text"),
    "event id number": (CURRENT | {"event_id": 7}, SCHEMA_ERROR, "event_id: not text"),
    "publish time": (CURRENT | {"producer_ts": "soon"}, SCHEMA_ERROR, "wrong type: producer_ts"),
    "empty object": ("{}", SCHEMA_ERROR, "turbine_id"),
    "list": ("[1, 2]", SCHEMA_ERROR, "not a JSON object"),
    "list of objects": (json.dumps([CURRENT]), SCHEMA_ERROR, "not a JSON object"),
    "number": ("42", SCHEMA_ERROR, "not a JSON object"),
    "text": ('"text"', SCHEMA_ERROR, "not a JSON object"),
    "null": ("null", SCHEMA_ERROR, "not a JSON object"),
    "cut": ('{"turbine_id": "turbine-01", ', JSON_ERROR, "not valid JSON"),
    "trailing text": (json.dumps(CURRENT) + " trailing", JSON_ERROR, "not valid JSON"),
    "trailing brace": (json.dumps(CURRENT) + "}", JSON_ERROR, "not valid JSON"),
    "two objects": (json.dumps(CURRENT) + json.dumps(CURRENT), JSON_ERROR, "not valid JSON"),
    "brackets that close the guard": (json.dumps(CURRENT) + "],[1", JSON_ERROR, "not valid JSON"),
    "keys that close the guard": (json.dumps(CURRENT) + ',"x":{}', JSON_ERROR, "not valid JSON"),
    "single quotes": ("{'turbine_id': 'turbine-01'}", JSON_ERROR, "not valid JSON"),
    "trailing comma": ('{"turbine_id": "turbine-01",}', JSON_ERROR, "not valid JSON"),
    "words": ("not json", JSON_ERROR, "not valid JSON"),
    "empty": ("", JSON_ERROR, "not valid JSON"),
}


def test_rejected_payloads(messages):
    rows = checked_rows(messages, *[payload for payload, _, _ in REJECTED.values()])
    wrong = [
        (case, row["error_type"], row["error_message"])
        for (case, (_, error, text)), row in zip(REJECTED.items(), rows, strict=True)
        if row["error_type"] != error or text not in row["error_message"]
    ]
    assert not wrong


def test_all_faults_are_named(messages):
    (row,) = checked_rows(messages, CURRENT | {"wind_speed_ms": 500, "status": "odd", "turbine_id": ""})
    for name in ("wind_speed_ms", "status", "turbine_id"):
        assert name in row["error_message"]


def test_split_is_a_partition_of_the_input(messages):
    everything = [p for p, _ in ACCEPTED.values()] + [p for p, _, _ in REJECTED.values()]
    checked = check_messages(messages(*everything))
    assert accepted(checked).count() == len(ACCEPTED)
    bad = rejected(checked, F.col("timestamp"))
    assert bad.count() == len(REJECTED)
    assert bad.select("dlq_id").distinct().count() == len(REJECTED)


def test_ids_follow_from_the_message_position(messages):
    first = [r["event_id"] for r in checked_rows(messages, CURRENT, CURRENT)]
    again = [r["event_id"] for r in checked_rows(messages, CURRENT, CURRENT)]
    assert first == again and len(set(first)) == 2


def test_blank_lines_are_counted_and_kept_out(spark, tmp_path):
    from fleetpulse.sources.logs import read_log, skip_blank

    lines = [json.dumps(LEGACY), "", "   ", "broken", json.dumps(CURRENT | {"rotor_rpm": 99}), "\t"]
    (tmp_path / "a.log").write_text("\n".join(lines))
    (tmp_path / "b.log").write_text(json.dumps(LEGACY) + "\n")
    read = read_log(spark, str(tmp_path))
    summary = ingest_summary(check_messages(read)).first()
    assert summary.asDict() == {"published": 2, "validation_failures": 1, "json_failures": 1, "skipped_empty": 3}
    checked = check_messages(skip_blank(read))
    assert accepted(checked).select("event_id").distinct().count() == 2
    bad = rejected(checked).collect()
    assert {r["raw_payload"] for r in bad} == {lines[3], lines[4]}
    assert {r["original_topic"] for r in bad} == {"raw"}


def test_line_ids_do_not_depend_on_the_split_or_the_time(spark, tmp_path):
    """Equal lines of a file are told apart; reading again, in other pieces and later, gives the same ids and days."""
    import time

    from fleetpulse.sources.logs import read_log, skip_blank

    lines = [json.dumps(LEGACY | {"Power": i}) if i % 3 else "{broken" for i in range(3000)]
    (tmp_path / "a.log").write_text("\n".join(lines) + "\n")

    def ids():
        checked = check_messages(skip_blank(read_log(spark, str(tmp_path))))
        good = [r[0] for r in accepted(checked).select("event_id").collect()]
        bad = rejected(checked, F.current_timestamp(), keep=[F.to_date("timestamp").alias("day")]).select("dlq_id", "day").collect()
        assert len(good) == 2000 and len(bad) == 1000
        return set(good), {tuple(r) for r in bad}

    first = ids()
    assert len(first[0]) == 2000 and len(first[1]) == 1000
    time.sleep(0.01)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16_384)
    try:
        assert ids() == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("step", ["decode", "accepted"])
def test_one_scan_and_no_shuffle(messages, step):
    checked = check_messages(messages(CURRENT))
    plan = (checked if step == "decode" else accepted(checked))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("Generate ") == 1
