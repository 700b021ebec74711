from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetpulse.schemas import MESSAGE_SCHEMA, READING_SCHEMA  # noqa: E402
from fleetpulse.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

# A quiet reading of a made-up machine, in both layouts; keys in the order of the schema.
CURRENT = {
    "turbine_id": "turbine-08",
    "recorded_at": "2025-03-02T08:15:40+00:00",
    "wind_speed_ms": 7.25,
    "rotor_rpm": 10.6,
    "power_output_kw": 812.5,
    "temperature_c": 36.5,
    "vibration_mms": 2.25,
    "blade_pitch_deg": 6.5,
    "status": "online",
}
LEGACY = {
    "Turbine_ID": "Turbine_9",
    "Timestamp": "2025-03-02 08:15:40",
    "Wind_Speed": 6.75,
    "Generator_Speed": 47.1,
    "Power": 640.0,
    "GeneratorTemp": 61.75,
    "BladePitchAngle": 21.0,
    "Nacelle_Position": 51.25,
    "Wind_direction": 48.5,
    "Ambient_Air_temp": -3.5,
    "Bearing_Temp": 38.5,
    "GearBoxSumpTemp": 55.25,
    "GearTemp": 143.0,
    "Hub_Speed": 4,
}


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, memory="8g")


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def messages(spark):
    """Frame of raw messages; objects are sent as JSON, text as it is."""

    def build(*payloads, partition=0, first_offset=0):
        from datetime import datetime, timezone

        now = datetime(2025, 3, 2, 9, 0, tzinfo=timezone.utc)
        rows = [
            ("raw", partition, first_offset + i, now, p if isinstance(p, str) else json.dumps(p))
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1)

    return build


@pytest.fixture
def readings(spark):
    """Frame of readings from changes to the base reading."""

    def build(*changes):
        from datetime import datetime, timezone

        rows = []
        for i, change in enumerate(changes):
            row = dict.fromkeys(READING_SCHEMA.fieldNames()) | CURRENT | {"event_id": f"e{i}"} | change
            if isinstance(row["recorded_at"], str):
                row["recorded_at"] = datetime.fromisoformat(row["recorded_at"])
            row["producer_ts"] = row["producer_ts"] or datetime(2025, 3, 2, 8, 15, 44, tzinfo=timezone.utc)
            rows.append(tuple(row[c] for c in READING_SCHEMA.fieldNames()))
        return spark.createDataFrame(rows, READING_SCHEMA).coalesce(1)

    return build
