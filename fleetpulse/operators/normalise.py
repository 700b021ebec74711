"""One set of field names, units and defaults for both message layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.text import message_id, round_exact, strip
from fleetpulse.functions.times import epoch_instant, parse_instant
from fleetpulse.operators.decode import legacy
from fleetpulse.schemas import EXTENDED_BOUNDS, NUMERIC_BOUNDS


def _doc(name: str) -> Column:
    return F.col(f"doc.{name}")


def _mentioned(name: str) -> Column:
    """The key occurs with a null or an unreadable value; NULL or false otherwise."""
    return F.array_contains("mentioned", name)


def _present(name: str) -> Column:
    return _doc(name).isNotNull() | F.coalesce(_mentioned(name), F.lit(False))


def _current_or_legacy(name: str, current: Column, older: Column) -> Column:
    """The older name counts only where the current one is absent."""
    return F.when(_doc(name).isNotNull(), current).when(_mentioned(name), F.lit(None)).otherwise(older)


def _json_text(field: Column) -> Column:
    """Text of a JSON string; NULL for any other JSON type."""
    return F.when(F.schema_of_variant(field) == "STRING", F.try_variant_get(field, "$", "string"))


def _json_instant(field: Column) -> Column:
    """Instant from a JSON string or number. No number is spelled like a date."""
    kind = F.schema_of_variant(field)
    numeric = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    return F.coalesce(
        parse_instant(F.try_variant_get(field, "$", "string")),
        F.when(numeric, epoch_instant(F.try_variant_get(field, "$", "double"))),
    )


def _legacy_machine_id(field: Column) -> Column:
    """``Turbine_3`` becomes ``turbine-03``; what holds no number is only respelled."""
    shown = F.when(F.is_variant_null(field), F.lit("None")).otherwise(F.try_variant_get(field, "$", "string"))
    digits = strip(F.replace(F.replace(shown, F.lit("Turbine_")), F.lit("turbine-")))
    number = F.when(digits.rlike(r"^[+-]?\d+$"), digits.try_cast("bigint"))
    respelled = F.replace(F.lower(shown), F.lit("_"), F.lit("-"))
    return F.when(number.isNotNull(), F.format_string("turbine-%02d", number)).otherwise(respelled)


def _pitch(angle: Column) -> Column:
    """Angles over a quarter turn wrap by 90 degrees (95 becomes 5), then stay in 0..90."""
    wrapped = F.when(angle > 90, angle % 90).otherwise(angle)
    # least and greatest pass over NULL, so a missing angle has to be kept out.
    return F.when(angle.isNotNull(), F.least(F.lit(90.0), F.greatest(F.lit(0.0), wrapped)))


def _numbers() -> dict[str, Column]:
    converted = {
        "rotor_rpm": round_exact(_doc(legacy("rotor_rpm")) / 10, 2),
        "blade_pitch_deg": _pitch(_doc(legacy("blade_pitch_deg"))),
        "vibration_mms": F.lit(0.0),
    }
    return {
        name: _current_or_legacy(name, _doc(name), converted[name] if name in converted else _doc(legacy(name)))
        for name in NUMERIC_BOUNDS
    }


def _wrong_types() -> Column:
    """Fields that may be absent but are there with an unusable value; NULL as a rule.

    Only messages under suspicion get as far as the list, because Spark runs the
    arguments of ``filter`` without generated code.
    """
    published = _doc("producer_ts")
    time_unusable = published.isNotNull() & ~F.is_variant_null(published) & _json_instant(published).isNull()
    sensors = ", ".join(
        f"CASE WHEN array_contains(unreadable, '{name}')"
        f" OR (NOT array_contains(mentioned, '{name}') AND array_contains(unreadable, '{legacy(name)}')) THEN '{name}' END"
        for name in EXTENDED_BOUNDS
    )
    found = F.concat(F.array(F.when(time_unusable, F.lit("producer_ts"))), F.expr(f"array({sensors})"))
    suspicious = (F.size("unreadable") > 0) | time_unusable
    return F.when(suspicious, F.filter(found, lambda name: name.isNotNull()))


def normalise(decoded: DataFrame) -> DataFrame:
    """Replace the parsed documents by reading columns, not yet checked.

    Adds ``id_text`` (machine id before trimming) and ``wrong_types`` (names of
    fields with a value of an unusable type), and keeps the message columns and
    ``shape``. An ``event_id`` that is no text and a vibration that is no number
    come out as NULL; absent ones have their defaults.
    """
    id_text = _current_or_legacy("turbine_id", _json_text(_doc("turbine_id")), _legacy_machine_id(_doc(legacy("turbine_id"))))
    recorded_at = _current_or_legacy(
        "recorded_at", _json_instant(_doc("recorded_at")), _json_instant(_doc(legacy("recorded_at")))
    )
    kept = [c for c in decoded.columns if c not in ("doc", "mentioned", "unreadable")]
    fields = decoded.select(
        *kept,
        F.when(_present("event_id"), _json_text(_doc("event_id"))).otherwise(message_id(decoded)).alias("event_id"),
        id_text.alias("id_text"),
        recorded_at.alias("recorded_at"),
        *[column.alias(name) for name, column in _numbers().items()],
        F.when(_doc("status").isNotNull(), _doc("status"))
        .when(_mentioned("status"), F.lit("null"))
        .otherwise(F.lit("online"))
        .alias("status"),
        F.when(_present("producer_ts"), _json_instant(_doc("producer_ts")))
        .otherwise(F.col("timestamp"))
        .alias("producer_ts"),
        _wrong_types().alias("wrong_types"),
    )
    return fields.withColumns({"turbine_id": strip(F.col("id_text")), "status": corrected_status()})


def corrected_status() -> Column:
    """A machine reported online that stands still in good wind is at fault."""
    zero = F.lit(0.0)
    standing = (
        (F.coalesce("wind_speed_ms", zero) > 3)
        & (F.coalesce("rotor_rpm", zero) < 0.1)
        & (F.coalesce("power_output_kw", zero) < 1)
    )
    return F.when(standing & (F.col("status") == "online"), F.lit("fault")).otherwise(F.col("status"))
