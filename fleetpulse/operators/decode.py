"""JSON text to typed fields, telling broken text, wrong shape and a document apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.schemas import LEGACY_NAMES, NUMERIC_BOUNDS

MALFORMED = "_malformed"

# Fields whose JSON type matters (a number is no machine id, but a valid instant).
_TYPED_BY_JSON = ("event_id", "turbine_id", "recorded_at", "producer_ts")

# Strict JSON as a standard parser reads it: no single quotes. NaN is let through
# and fails the range check later.
_STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": MALFORMED}


def legacy(name: str) -> str:
    """Name of a field of the older layout inside ``doc``."""
    return f"legacy_{name}"


NUMBER_FIELDS = tuple(NUMERIC_BOUNDS) + tuple(legacy(c) for c in NUMERIC_BOUNDS if c in LEGACY_NAMES)


def _document_schema(number_type: T.DataType, as_sent: bool) -> T.StructType:
    """Fields of both layouts, under the names as sent or as used here."""
    layout = {name: T.VariantType() for name in _TYPED_BY_JSON}
    layout["status"] = T.StringType()
    layout.update({name: number_type for name in NUMERIC_BOUNDS})
    fields = [T.StructField(name, kind) for name, kind in layout.items()]
    for name, sent in LEGACY_NAMES.items():
        fields.append(T.StructField(sent if as_sent else legacy(name), layout[name]))
    return T.StructType([*fields, T.StructField(MALFORMED, T.StringType())])


def _parse(raw: Column, number_type: T.DataType) -> Column:
    # Turbine_ID and turbine_id are one name to Spark, so legacy fields are renamed by position.
    parsed = F.from_json(raw, _document_schema(number_type, as_sent=True), _STRICT)
    return parsed.cast(_document_schema(number_type, as_sent=False))


def _numbers_read_from_text() -> Column:
    """The document of ``loose`` with its numbers cast; NULL where a cast fails."""
    fields = []
    for field in _document_schema(T.DoubleType(), as_sent=False):
        column = F.col(f"loose.{field.name}")
        fields.append((column.try_cast("double") if field.name in NUMBER_FIELDS else column).alias(field.name))
    return F.struct(*fields)


def _unreadable_numbers() -> Column:
    texts = [F.col(f"loose.{name}") for name in NUMBER_FIELDS]
    failed = [
        F.when(text.isNotNull() & text.try_cast("double").isNull(), F.lit(name))
        for name, text in zip(NUMBER_FIELDS, texts)
    ]
    return F.array_compact(F.array(*failed))


def _is_json(raw: Column) -> Column:
    """Whole text is one JSON value.

    Spark's parsers ignore text after the first value. Wrapping it in an array
    and in an object exposes that: no trailing text can complete both.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    return in_array.isNotNull() & in_object.isNotNull()


def decode(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Add ``doc``, ``mentioned``, ``unreadable`` and ``shape`` to the messages.

    ``doc`` holds the fields of both layouts. Its numbers are read as doubles in
    one pass. Only a message that does not fit (say, numbers sent as text) is
    read again as strings; ``unreadable`` then lists numbers that are none. The
    keys of a message, ``mentioned``, tell an explicit null from an absent field
    and are read only where a NULL in ``doc`` may be either.

    ``shape`` is ``document``, ``broken`` (no JSON) or ``other`` (JSON, no object).

    The payload is used many times: a source that computes it puts ``computed_once`` around its rows.
    """
    raw = F.col(payload)
    misfit = F.col(f"strict.{MALFORMED}").isNotNull()
    keys = F.map_keys(F.from_json(raw, T.MapType(T.StringType(), T.StringType()), {"allowSingleQuotes": "false"}))
    names = F.transform(keys, lambda k: F.coalesce(F.element_at(_shown_names(), k), k))
    parsed = messages.withColumn("strict", _parse(raw, T.DoubleType())).withColumns(
        {
            "loose": F.when(misfit, _parse(raw, T.StringType())),
            "mentioned": F.when(misfit | raw.contains("null"), names),
        }
    )
    # A single closing brace at the very end leaves no room for trailing text.
    may_trail = raw.rlike(r"\}\s*\S")
    opens_object = raw.startswith("{") | raw.rlike(r"^\s*\{")
    broken = raw.isNull() | F.col("strict").isNull() | F.col(f"loose.{MALFORMED}").isNotNull()
    shape = (
        F.when(opens_object & broken, F.lit("broken"))
        .when(opens_object & ~may_trail, F.lit("document"))
        .when(raw.isNull() | ~_is_json(raw), F.lit("broken"))
        .when(opens_object, F.lit("document"))
        .otherwise(F.lit("other"))
    )
    return parsed.withColumns(
        {
            "doc": F.when(misfit, _numbers_read_from_text()).otherwise(F.col("strict")),
            "unreadable": F.when(misfit, _unreadable_numbers()),
            "shape": shape,
        }
    ).drop("strict", "loose")


def _shown_names() -> Column:
    pairs = [F.lit(part) for name, sent in LEGACY_NAMES.items() for part in (sent, legacy(name))]
    return F.create_map(*pairs)
