"""Whole computations over stored tables: labels and training tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from lapsewise.operators.activity import (
    CHURN_AFTER_DAYS,
    activity_stream,
    churn_label_all_periods,
    prepare_churn_label,
)
from lapsewise.operators.features import merge_dataframes, prepare_data
from lapsewise.plans.subscriber_store import SubscriberStore
from lapsewise.sources.catalog import Catalog

__all__ = [
    "SubscriberStore",
    "generate_all_churn_labels",
    "generate_all_datasets",
    "generate_churn_label",
    "generate_dataset",
]


def generate_churn_label(
    catalog: Catalog,
    current_month: str,
    next_month: str | None = None,
    threshold_days: int = CHURN_AFTER_DAYS,
) -> DataFrame:
    """``(bib_id, label)`` of a month, judged by the month after it."""
    following = catalog.month_after(current_month) if next_month is None else next_month
    return prepare_churn_label(*catalog.label_inputs(current_month, following), threshold_days)


def generate_all_churn_labels(
    catalog: Catalog, threshold_days: int = CHURN_AFTER_DAYS
) -> DataFrame:
    """``(bib_id, period, label)`` of every month but the last, in one job."""
    activity = activity_stream(
        catalog.read("package"), catalog.read("recharge"), ["bib_id", "period"]
    )
    return churn_label_all_periods(activity, threshold_days, len(catalog.months) - 1)


def generate_dataset(
    catalog: Catalog,
    month: str,
    churn_label_df: DataFrame,
    as_of: dt.date | str | None = None,
    include_loans: bool = False,
    unique_users: bool = False,
    exact: bool = True,
) -> DataFrame:
    """The training table of a month: the label with all of the month's features."""
    inputs = catalog.feature_inputs(month, include_loans)
    features = prepare_data(*inputs, as_of=as_of, exact=exact)
    return merge_dataframes(features, churn_label_df, include_loans, unique_users)


def generate_all_datasets(
    catalog: Catalog,
    as_of: dt.date | str | None = None,
    threshold_days: int = CHURN_AFTER_DAYS,
    include_loans: bool = False,
    exact: bool = True,
) -> DataFrame:
    """The training tables of every month but the last in one job, told apart by ``period``.

    The same rows as month by month: every table is read once, and months are part of the key.
    """
    key = ["bib_id", "period"]
    features = prepare_data(
        catalog.read("loan_assign") if include_loans else None,
        catalog.read("loan_recovery") if include_loans else None,
        catalog.read("package"),
        catalog.read("recharge"),
        catalog.read("user"),
        as_of=as_of,
        key=key,
        exact=exact,
    )
    label = generate_all_churn_labels(catalog, threshold_days)
    return merge_dataframes(features, label, include_loans, key=key)
