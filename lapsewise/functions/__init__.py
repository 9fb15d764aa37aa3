"""Column-level helpers: time parsing, day gaps, ages and ratios."""

from lapsewise.functions.numbers import age_in_years, percent_of
from lapsewise.functions.timeparse import (
    DAY_FORMAT,
    LONG_FORMAT,
    TIME_PARTS,
    day_gap,
    ensure_timestamp,
    ensure_timestamps,
)

__all__ = [
    "DAY_FORMAT",
    "LONG_FORMAT",
    "TIME_PARTS",
    "age_in_years",
    "day_gap",
    "ensure_timestamp",
    "ensure_timestamps",
    "percent_of",
]
