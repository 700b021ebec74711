"""Number formatting, rounding and stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"


def fixed(value: Column | str, digits: int) -> Column:
    """Text with a fixed number of decimals.

    ``format_number`` rounds the exact binary value half to even, as C and
    Python formatting do. ``round`` and ``format_string`` round the shortest
    decimal text half up, which differs on about every tenth value ending in 5.
    """
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def round_exact(value: Column | str, digits: int) -> Column:
    """Round a double by its exact binary value, half to even."""
    return fixed(value, digits).cast("double")


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def stable_id(*parts: Column) -> Column:
    """Same parts, same id: a redelivered row keeps its key."""
    return F.md5(F.concat_ws("|", *parts))


def message_id(messages: DataFrame, *prefix: Column) -> Column:
    """Id of a message from its position, or from its ``origin`` alone where it has one.

    An origin names one message; the offset beside it is only an order of arrival.
    """
    position = ("topic", "origin") if "origin" in messages.columns else ("topic", "partition", "offset")
    return stable_id(*prefix, *[F.col(c) for c in position])
