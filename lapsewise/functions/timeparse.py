"""Turn text columns into timestamps, once, at the edge of an operator."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# The two text formats of the monthly extracts.
LONG_FORMAT = "yyyyMMdd HH:mm:ss"
DAY_FORMAT = "yyyyMMdd"

# Parts of a timestamp that a time profile groups by (weekday: 1 = Sunday).
TIME_PARTS = {
    "hour": F.hour,
    "day_of_week": F.dayofweek,
    "day_of_month": F.dayofmonth,
}


def ensure_timestamps(df: DataFrame, formats: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Parse several text columns in one projection.

    Columns that already hold timestamps (with or without time zone) are left alone. Text
    that does not match its format becomes null; with ``strict`` the query fails on it.
    """
    parse = F.to_timestamp if strict else F.try_to_timestamp
    parsed = {
        name: parse(F.col(name), F.lit(fmt) if not strict else fmt)
        for name, fmt in formats.items()
        if not isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType))
    }
    return df.withColumns(parsed) if parsed else df


def ensure_timestamp(
    df: DataFrame, name: str, fmt: str = LONG_FORMAT, strict: bool = False
) -> DataFrame:
    """Parse one text column; see :func:`ensure_timestamps`."""
    return ensure_timestamps(df, {name: fmt}, strict)


def day_gap(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (not 24-hour spans)."""
    return F.datediff(end, start)
