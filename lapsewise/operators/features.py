"""Per-subscriber features and the wide table that joins them to a label."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.numbers import age_in_years
from lapsewise.functions.timeparse import DAY_FORMAT, LONG_FORMAT, day_gap, ensure_timestamps
from lapsewise.operators import skew
from lapsewise.operators.quantiles import sketched, summarise
from lapsewise.operators.skew import as_names


def _mean_median(
    df: DataFrame,
    key: str | Sequence[str],
    amounts: Mapping[str, str],
    exact: bool,
    buffered: bool,
    count_as: str | None = None,
) -> DataFrame:
    """Mean and median per key of each column, named ``Average<suffix>``/``Median<suffix>``.

    ``buffered`` is for a caller who knows that no key has very many rows: exact medians then come
    from one buffer for each key.
    """
    keys = as_names(key)
    ways = {True: partial(summarise, buffered=buffered), False: sketched}
    medians = {c: {f"Median{s}": 0.5} for c, s in amounts.items()}
    means = {c: f"Average{s}" for c, s in amounts.items()}
    wide = ways[exact](df.select(*keys, *amounts), keys, medians, means, count_as)
    ordered = [n for s in amounts.values() for n in (f"Average{s}", f"Median{s}")]
    return wide.select(*keys, *ordered, *([count_as] if count_as else []))


def prepare_assign_df(
    assign_df: DataFrame,
    key: str | Sequence[str] = "bib_id",
    exact: bool = True,
    buffered: bool = False,
) -> DataFrame:
    """Mean and median amount of the loans assigned to a subscriber."""
    return _mean_median(assign_df, key, {"loan_amount": "AssignLoanAmount"}, exact, buffered)


def prepare_recovery_df(
    recovery_df: DataFrame,
    key: str | Sequence[str] = "bib_id",
    exact: bool = True,
    buffered: bool = False,
) -> DataFrame:
    """Mean and median *loan* amount over a subscriber's recovery rows."""
    return _mean_median(recovery_df, key, {"loan_amount": "RecoveryLoanAmount"}, exact, buffered)


def prepare_package_df(
    package_df: DataFrame,
    key: str | Sequence[str] = "bib_id",
    exact: bool = True,
    buffered: bool = False,
) -> DataFrame:
    """Mean and median amount and duration in days of a subscriber's packages, and their
    number (rows without amount or date are counted too)."""
    dated = ensure_timestamps(
        package_df, {"activation_date": LONG_FORMAT, "deactivation_date": LONG_FORMAT}
    ).withColumn("duration", day_gap(F.col("activation_date"), F.col("deactivation_date")))
    return _mean_median(
        dated,
        key,
        {"offer_amount": "PackageAmount", "duration": "PackageDuration"},
        exact,
        buffered,
        count_as="CountPackage",
    )


def prepare_recharge_df(
    recharge_df: DataFrame,
    key: str | Sequence[str] = "bib_id",
    exact: bool = True,
    buffered: bool = False,
) -> DataFrame:
    """Mean and median recharge amount of a subscriber and the number of recharges."""
    return _mean_median(
        recharge_df,
        key,
        {"recharge_value_amt": "RechargeAmount"},
        exact,
        buffered,
        count_as="CountRecharge",
    )


def prepare_user_df(
    user_df: DataFrame,
    as_of: dt.date | str | None = None,
    key: str | Sequence[str] = "bib_id",
) -> DataFrame:
    """Age on ``as_of`` (default: today), registration year and the plain attributes."""
    dated = ensure_timestamps(
        user_df, {"registration_date_d": DAY_FORMAT, "date_of_birth_d": DAY_FORMAT}
    )
    return dated.select(
        *as_names(key),
        age_in_years(F.col("date_of_birth_d"), as_of).alias("age"),
        F.year("registration_date_d").alias("registration_year"),
        "contract_type_v",
        "gender_v",
        "ability_status",
        "account_balance",
    )


class Features(NamedTuple):
    """The five prepared inputs of the training table; the loan parts may be absent."""

    assign: DataFrame | None
    recovery: DataFrame | None
    package: DataFrame
    recharge: DataFrame
    user: DataFrame


def prepare_data(
    assign_df: DataFrame | None,
    recovery_df: DataFrame | None,
    package_df: DataFrame,
    recharge_df: DataFrame,
    user_df: DataFrame,
    as_of: dt.date | str | None = None,
    key: str | Sequence[str] = "bib_id",
    exact: bool = True,
    buffered: bool = False,
) -> Features:
    """Prepare all five inputs; nothing runs until the result is used."""
    return Features(
        None if assign_df is None else prepare_assign_df(assign_df, key, exact, buffered),
        None if recovery_df is None else prepare_recovery_df(recovery_df, key, exact, buffered),
        prepare_package_df(package_df, key, exact, buffered),
        prepare_recharge_df(recharge_df, key, exact, buffered),
        prepare_user_df(user_df, as_of, key),
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str] = "bib_id") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    sizes = df.groupBy(*as_names(key)).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.where(F.col("rows") > 1)


def require_unique(df: DataFrame, key: str | Sequence[str] = "bib_id") -> DataFrame:
    """``df`` itself, or ``ValueError`` if a key repeats. Runs one aggregation at once."""
    repeated = duplicate_keys(df.dropna(subset=as_names(key)), key).head(1)
    if repeated:
        raise ValueError(f"key {as_names(key)} is not unique, for example {repeated[0]}")
    return df


def merge_dataframes(
    features: Features,
    churn_label_df: DataFrame,
    include_loans: bool = False,
    unique_users: bool = False,
    key: str | Sequence[str] = "bib_id",
    salts: int = 1,
) -> DataFrame:
    """Left-join the features to the label; absent features are null, counts included.

    Label and aggregates have one row per key, share their partitioning and need no further
    shuffle. The user table may repeat a key, which multiplies rows; where one is repeated very
    often, ``salts`` spreads it over so many tasks. ``unique_users`` checks first that there are
    none (this runs a job) and then joins plainly.
    """
    keys = as_names(key)
    merged = churn_label_df
    loans = [features.assign, features.recovery] if include_loans else []
    if any(part is None for part in loans):
        raise ValueError("include_loans needs the assign and recovery inputs")
    for part in [*loans, features.package, features.recharge]:
        merged = merged.join(part, keys, "left")
    if unique_users:
        return merged.join(require_unique(features.user, keys), keys, "left")
    return skew.left_join_many(merged, features.user, keys, salts)
