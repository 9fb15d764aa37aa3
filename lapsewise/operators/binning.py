"""Put numbers into labelled intervals that are open on the left and closed on the right."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.timeparse import day_gap

_INF = float("inf")


@dataclass(frozen=True)
class Bins:
    """Interval edges and the label of each interval."""

    edges: tuple[float, ...]
    labels: tuple[str, ...]


# The three presets of edges and labels.
DURATION_BINS = Bins(
    (-_INF, 0, 1, 7, 15, 30, 60, 120, 180, 365, _INF),
    (
        "Same Day",
        "Daily",
        "Weekly",
        "Half-Monthly",
        "Monthly",
        "2 Months",
        "4 Months",
        "6 Months",
        "1 Year",
        "More than 1 Year",
    ),
)
LOAN_AMOUNT_BINS = Bins(
    (-_INF, 5000, 10000, 20000, 50000, 100000, _INF),
    ("VeryLow", "5T-10T", "10T-20T", "20T-50T", "50T-100T", "Extreme"),
)
RECHARGE_BINS = Bins(
    (-_INF, 10000, 20000, 50000, 100000, 200000, 500000, _INF),
    ("1T", "2T", "5T", "10T", "20T", "50T", "More"),
)


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edge, next edge]`` holding ``value``, as one CASE.

    A value in no interval keeps its own text; the cast is explicit because ANSI mode would
    otherwise try to read the labels as numbers.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError(
            f"bins need one edge more than labels: got {len(edges)} edges, {len(labels)} labels"
        )
    if not labels:
        raise ValueError("bins and labels must not be empty")
    branches = F
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
        branches = branches.when(inside, F.lit(label))
    return branches.otherwise(value.cast("string"))


def categorize(
    df: DataFrame,
    col_name: str,
    bins: Sequence[float],
    labels: Sequence[str],
    new_column_name: str = "category",
) -> DataFrame:
    """Add (or replace) a column with the label of each row's interval."""
    return df.withColumn(new_column_name, bin_label(F.col(col_name), bins, labels))


def categorize_time_difference(
    df: DataFrame,
    activation_col: str = "activation_date",
    deactivation_col: str = "deactivation_date",
    new_col_name: str = "time_difference_days",
) -> DataFrame:
    """Add the duration in days and its ``duration_category``; negative counts as same day."""
    days = day_gap(F.col(activation_col), F.col(deactivation_col))
    return df.withColumns(
        {
            new_col_name: days,
            "duration_category": bin_label(days, DURATION_BINS.edges, DURATION_BINS.labels),
        }
    )
