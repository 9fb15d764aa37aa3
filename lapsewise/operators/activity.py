"""First and last activity per subscriber, and the churn label drawn from them.

Every operator here is one union and one ``groupBy``: a single shuffle whose input is
already reduced to one row per key and task, so a subscriber with very many events costs no
more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.timeparse import day_gap, ensure_timestamp
from lapsewise.operators.skew import as_names

PACKAGE_TIME = "activation_date"
RECHARGE_TIME = "recharge_dt"
CHURN_AFTER_DAYS = 30

_PICK = {"max": F.max, "min": F.min}


def activity_stream(
    package_df: DataFrame, recharge_df: DataFrame, key: str | Sequence[str] = "bib_id"
) -> DataFrame:
    """Rows ``(key, ts)`` of both sources. Rows without a key are left out; rows whose time
    is null or unreadable stay, for their subscriber did appear."""
    keys = as_names(key)
    sources = [
        ensure_timestamp(df, name).select(*keys, F.col(name).alias("ts"))
        for df, name in ((package_df, PACKAGE_TIME), (recharge_df, RECHARGE_TIME))
    ]
    return sources[0].unionByName(sources[1]).dropna(subset=keys)


def subscriber_activity(
    package_df: DataFrame,
    recharge_df: DataFrame,
    how: str,
    key: str | Sequence[str] = "bib_id",
) -> DataFrame:
    """``(key, max_date)`` or ``(key, min_date)`` over both sources.

    Equal to a full outer join of two aggregates followed by greatest/least, with one
    shuffle instead of two and no join.
    """
    if how not in _PICK:
        raise ValueError(f"unknown aggregate {how!r}: expected 'max' or 'min'")
    keys = as_names(key)
    stream = activity_stream(package_df, recharge_df, keys)
    return stream.groupBy(*keys).agg(_PICK[how]("ts").alias(f"{how}_date"))


def churn_flag(last_seen: Column, next_seen: Column, threshold_days: int) -> Column:
    """1 if nothing follows, or only after more than ``threshold_days`` days; else 0."""
    never_back = next_seen.isNull() & last_seen.isNotNull()
    back_late = day_gap(last_seen, next_seen) > F.lit(threshold_days)
    return F.when(never_back | back_late, F.lit(1)).otherwise(F.lit(0))


def prepare_churn_label(
    current_package_df: DataFrame,
    current_recharge_df: DataFrame,
    next_package_df: DataFrame,
    next_recharge_df: DataFrame,
    threshold_days: int = CHURN_AFTER_DAYS,
    key: str | Sequence[str] = "bib_id",
) -> DataFrame:
    """``(key, label)`` for every subscriber seen in the current period."""
    keys = as_names(key)
    current = activity_stream(current_package_df, current_recharge_df, keys)
    following = activity_stream(next_package_df, next_recharge_df, keys)
    tagged = current.withColumn("is_current", F.lit(True)).unionByName(
        following.withColumn("is_current", F.lit(False))
    )
    return (
        tagged.groupBy(*keys)
        .agg(
            F.max(F.when(F.col("is_current"), F.col("ts"))).alias("last_seen"),
            F.min(F.when(~F.col("is_current"), F.col("ts"))).alias("next_seen"),
            F.max("is_current").alias("seen_now"),
        )
        .where("seen_now")
        .select(
            *keys,
            churn_flag(F.col("last_seen"), F.col("next_seen"), threshold_days).alias("label"),
        )
    )


def churn_label_all_periods(
    activity: DataFrame,
    threshold_days: int = CHURN_AFTER_DAYS,
    last_period: int | None = None,
    key: str | Sequence[str] = "bib_id",
    period: str = "period",
    ts: str = "ts",
) -> DataFrame:
    """``(key, period, label)`` for every period but the last, in one job.

    Each row serves twice: as current activity of its own period and as following activity
    of the period before. So a period's successor is exactly ``period + 1``, also when a
    subscriber skips it. ``last_period`` has no successor and gets no label; when it is not
    given it is taken from the data.
    """
    keys = as_names(key)
    rows = activity.select(
        *keys, F.col(period).cast("int").alias("period"), F.col(ts).alias("ts")
    ).dropna(subset=[*keys, "period"])
    last = rows.agg(F.max("period")).scalar() if last_period is None else F.lit(last_period)
    none = F.lit(None).cast(rows.schema["ts"].dataType)

    def role(of_period: Column, last_seen: Column, next_seen: Column, now: bool) -> Column:
        return F.struct(
            of_period.alias("period"),
            last_seen.alias("last_seen"),
            next_seen.alias("next_seen"),
            F.lit(now).alias("now"),
        )

    own, ts_col = F.col("period"), F.col("ts")
    roles = F.array(role(own, ts_col, none, True), role(own - 1, none, ts_col, False))
    return (
        rows.select(*keys, F.inline(roles))
        .groupBy(*keys, "period")
        .agg(
            F.max("last_seen").alias("last_seen"),
            F.min("next_seen").alias("next_seen"),
            F.max("now").alias("seen_now"),
        )
        .where(F.col("seen_now") & (F.col("period") < last))
        .select(
            *keys,
            "period",
            churn_flag(F.col("last_seen"), F.col("next_seen"), threshold_days).alias("label"),
        )
    )
