"""Instants: one canonical form (BIGINT epoch milliseconds) for every layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

STAMP_FORMAT = "yy-MM-dd HH:mm:ss.SSSSSS"


def truncated_ms(value: Column) -> Column:
    """Number or numeric text to whole milliseconds, fraction cut off; NULL when not numeric."""
    return value.cast("string").try_cast("double").try_cast("bigint")


def to_epoch_ms(value: Column) -> Column:
    """Any instant a snapshot may carry: a number, numeric text, or ISO-8601 text."""
    return F.coalesce(truncated_ms(value), F.unix_millis(F.try_to_timestamp(value.cast("string"))))


def epoch_ms_of(name: str, data_type: T.DataType) -> Column:
    """``to_epoch_ms`` of a column whose type is known, without the parse when it is not needed."""
    if isinstance(data_type, (T.LongType, T.IntegerType)):
        return F.col(name).cast("bigint")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_millis(F.col(name).cast("timestamp"))
    return to_epoch_ms(F.col(name))


def stamp(ms: Column) -> Column:
    """Epoch milliseconds as UTC text (the session zone is UTC); fractions keep microseconds."""
    micros = F.round(ms.cast("double") * 1000).cast("bigint")
    return F.date_format(F.timestamp_micros(micros), STAMP_FORMAT)


def stamp_or_null(value: Column) -> Column:
    """``stamp`` of text; NULL where the text is no number."""
    return stamp(value.cast("string").try_cast("double"))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def bucket_ms(ms: Column, width_ms: int) -> Column:
    """Start of the fixed-width bucket an instant falls into."""
    return ms - F.pmod(ms, F.lit(width_ms))


def utc_date(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))
