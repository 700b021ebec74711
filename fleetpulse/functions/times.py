"""Instants, trailing ranges and time buckets."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted spellings of an instant.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
PLAIN_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
# Numbers above this count milliseconds, smaller ones seconds.
LARGEST_SECONDS = 2e10


def parse_instant(text: Column) -> Column:
    """ISO-8601 or ``yyyy-MM-dd HH:mm:ss`` text; NULL when it is neither.

    Text without a zone is read in the session zone (UTC here). The patterns
    keep out what Spark's cast takes in addition, such as a bare year.
    """
    spelled = text.rlike(ISO_PATTERN) | text.rlike(PLAIN_PATTERN)
    return F.when(spelled, F.try_to_timestamp(F.replace(text, F.lit(","), F.lit("."))))


def epoch_instant(number: Column) -> Column:
    """Seconds, or milliseconds for large values, since 1970."""
    seconds = F.when(F.abs(number) > LARGEST_SECONDS, number / 1000).otherwise(number)
    return F.when(~F.isnan(seconds) & (F.abs(seconds) < 2.5e11), F.timestamp_seconds(seconds))


def instant(value: datetime | str | Column) -> Column:
    """A column for ``as_of``: a datetime, timestamp text or a column as it is."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def seconds_before(as_of: datetime | str | Column, seconds: float) -> Column:
    return instant(as_of) - F.lit(timedelta(seconds=seconds))


def after(ts: Column | str, as_of: datetime | str | Column, seconds: float) -> Column:
    """Strictly later than ``seconds`` before ``as_of``; no upper end."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts > seconds_before(as_of, seconds)


def trailing(ts: Column | str, as_of: datetime | str | Column, seconds: float) -> Column:
    """In the range ending at ``as_of``: start excluded, end included."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return after(ts, as_of, seconds) & (ts <= instant(as_of))


def bucket_floor(ts: Column, seconds: int) -> Column:
    """Start of the bucket holding ``ts``, aligned to 1970 UTC."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def bucket_ceil(ts: Column, seconds: int) -> Column:
    """First bucket border at or after ``ts``."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros + F.pmod(-micros, F.lit(seconds * 1_000_000)))


def time_range(
    df: DataFrame,
    start: datetime | str | Column | None = None,
    end: datetime | str | Column | None = None,
    ts: str = "recorded_at",
    day: str = "event_date",
) -> DataFrame:
    """Rows with ``start <= ts < end``.

    A predicate on the instant alone does not prune day folders, so the same
    range is stated on the day column wherever the frame has one.
    """
    filed_by_day = day in df.columns
    if start is not None:
        df = df.where(F.col(ts) >= instant(start))
        if filed_by_day:
            df = df.where(F.col(day) >= F.to_date(instant(start)))
    if end is not None:
        df = df.where(F.col(ts) < instant(end))
        if filed_by_day:
            df = df.where(F.col(day) <= F.to_date(instant(end)))
    return df
