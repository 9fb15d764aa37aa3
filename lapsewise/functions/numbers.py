"""Numeric helpers that stay defined under ANSI mode."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def age_in_years(born: Column, as_of: dt.date | str | None = None) -> Column:
    """Age in years on ``as_of``; without it, today's date, so that results move daily."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.datediff(today, born) / F.lit(DAYS_PER_YEAR)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero or null."""
    return F.try_divide(part, whole) * F.lit(100)
