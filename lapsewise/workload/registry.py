"""One entry per query: an operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    TimestampNTZType,
    TimestampType,
)

from lapsewise import operators as ops
from lapsewise import plans
from lapsewise.functions import ensure_timestamp
from lapsewise.sources.schemas import SCHEMAS
from lapsewise.workload import stored
from lapsewise.workload.domain import AS_OF, THRESHOLD_DAYS, Domain

Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Make results comparable: sums do not add up in the same order everywhere, and engines
    differ in the width of integers and the text of timestamps."""

    def comparable(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            # A mean of cents may lie exactly between two rounded numbers, where the last bit
            # of the sum would decide: let it go up.
            nudge = 1e-9 if field.name.startswith("Average") else 0.0
            return F.round(column + nudge, digits).alias(field.name)
        if isinstance(field.dataType, IntegerType):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return column

    return df.select(*[comparable(f) for f in df.schema.fields])


# --- features, label, training table ---------------------------------------------------------


def loan_assign_features(d: Domain) -> DataFrame:
    return ops.prepare_assign_df(d.loan_assign())


def loan_recovery_features(d: Domain) -> DataFrame:
    return ops.prepare_recovery_df(d.loan_recovery())


def package_features(d: Domain) -> DataFrame:
    return ops.prepare_package_df(d.package())


def recharge_features(d: Domain) -> DataFrame:
    return ops.prepare_recharge_df(d.recharge())


def user_attributes(d: Domain) -> DataFrame:
    return ops.prepare_user_df(d.user(), as_of=AS_OF)


def last_activity(d: Domain) -> DataFrame:
    return ops.subscriber_activity(d.signups(), d.purchases(), "max")


def first_activity(d: Domain) -> DataFrame:
    return ops.subscriber_activity(d.signups(), d.purchases(), "min")


def churn_label(d: Domain) -> DataFrame:
    return ops.prepare_churn_label(
        d.signups(0), d.purchases(0), d.signups(1), d.purchases(1), THRESHOLD_DAYS
    )


def churn_label_all_periods(d: Domain) -> DataFrame:
    stream = ops.activity_stream(d.signups(), d.purchases(), ["bib_id", "period"])
    return ops.churn_label_all_periods(stream, THRESHOLD_DAYS)


def _training(d: Domain, include_loans: bool) -> DataFrame:
    features = ops.prepare_data(
        d.loan_assign() if include_loans else None,
        d.loan_recovery() if include_loans else None,
        d.package(),
        d.recharge(),
        d.user(),
        as_of=AS_OF,
    )
    return ops.merge_dataframes(features, churn_label(d), include_loans)


def training_table(d: Domain) -> DataFrame:
    return _training(d, include_loans=False)


def training_table_with_loans(d: Domain) -> DataFrame:
    return _training(d, include_loans=True)


# --- binning ---------------------------------------------------------------------------------


def _loans_by_category(d: Domain) -> DataFrame:
    bins = ops.LOAN_AMOUNT_BINS
    return ops.categorize(d.loan_assign(), "loan_amount", bins.edges, bins.labels, "loan_category")


def _recharges_by_category(d: Domain) -> DataFrame:
    # Amounts of the given table stay below 500; in thousandths they spread over all bins.
    bins = ops.RECHARGE_BINS
    amounts = d.recharge().withColumn("recharge_value_amt", F.col("recharge_value_amt") * 1000)
    return ops.categorize(
        amounts, "recharge_value_amt", bins.edges, bins.labels, "recharge_category"
    )


def bin_loan_amount(d: Domain) -> DataFrame:
    return _loans_by_category(d).select("loan_id", "loan_amount", "loan_category")


def bin_recharge(d: Domain) -> DataFrame:
    return _recharges_by_category(d).select("bib_id", "recharge_value_amt", "recharge_category")


def bin_duration(d: Domain) -> DataFrame:
    return ops.categorize_time_difference(d.named_package()).select(
        "bib_id", "offering_name", "time_difference_days", "duration_category"
    )


# --- counts, sums, rankings ------------------------------------------------------------------


def _sums_by_person(d: Domain) -> DataFrame:
    return ops.sum_by(d.loan_assign(), "nid_hash", "loan_amount", "SumAggregated_loan_amount_by_nid")


def sum_by_person(d: Domain) -> DataFrame:
    return _sums_by_person(d)


def time_profile(d: Domain) -> DataFrame:
    return ops.sum_by_time_part(d.recharge(), "recharge_dt", "recharge_value_amt")


def time_profile_loans(d: Domain) -> DataFrame:
    return ops.sum_by_time_part(d.loan_assign(), "date_timestamp", "loan_amount")


def count_by_offering(d: Domain) -> DataFrame:
    return ops.count_by(d.packages_by_offering(), "offering_code", weight="packages")


def top_offerings(d: Domain) -> DataFrame:
    return ops.top_k(d.packages_by_offering(), "offering_name", 25, weight="packages")


def top_duration_categories(d: Domain) -> DataFrame:
    return ops.top_k(ops.categorize_time_difference(d.package()), "duration_category", 10)


def top_loans(d: Domain) -> DataFrame:
    """Loans with most payments, out of as many values as there are loans."""
    return ops.top_k_of_many(d.loan_payments(), "loan_id", 20)


def preview_customers(d: Domain) -> DataFrame:
    return ops.preview_sample(d.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), 25)


def ages_today(d: Domain) -> DataFrame:
    """Ages without a date given against those on the date that the session calls today."""
    today = d.spark.sql("SELECT current_date()").first()[0]
    now = ops.prepare_user_df(d.user()).select("bib_id", F.col("age").alias("age_now"))
    given = ops.prepare_user_df(d.user(), as_of=today).select("bib_id", "age")
    return now.join(given, "bib_id").select("bib_id", (F.col("age_now") == F.col("age")).alias("same"))


def value_counts(d: Domain) -> DataFrame:
    return ops.value_counts(d.user(), "gender_v")


# --- loan recovery ---------------------------------------------------------------------------


def common_loans(d: Domain) -> DataFrame:
    return ops.common_loans(d.loan_assign(), d.loan_payments())


def loan_recovery_by_loan(d: Domain) -> DataFrame:
    return ops.recovery_by_loan(d.loan_assign(), d.loan_payments())


def loan_recovery_prefiltered(d: Domain) -> DataFrame:
    """Payments of the large loans alone, most others dropped before their sums are shuffled."""
    large = d.loan_assign().where("loan_amount > 400000")
    return ops.recovery_by_loan(large, d.loan_payments(), prefilter=True)


def loan_recovery_ratio(d: Domain) -> DataFrame:
    return ops.loan_recovery_ratio(d.loan_assign(), d.loan_payments())


def loan_recovery_ratio_of_assigned(d: Domain) -> DataFrame:
    return ops.loan_recovery_ratio(d.loan_assign(), d.loan_payments(), base="assign")


# --- distributions ---------------------------------------------------------------------------


def dist_count(d: Domain) -> DataFrame:
    return ops.distribution(_loans_by_category(d), "count", "loan_category")


def dist_count_recharge(d: Domain) -> DataFrame:
    return ops.distribution(_recharges_by_category(d), "count", "recharge_category")


def dist_hist(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "hist", "value")


def dist_hist_hue(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "hist", "value", hue="event_type", bins=20)


def dist_hist_time(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "hist", "ts", bins=24)


def dist_hist_category(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "hist", "props", hue="event_type")


def dist_hist_person(d: Domain) -> DataFrame:
    return ops.distribution(_sums_by_person(d), "hist", "SumAggregated_loan_amount_by_nid")


def dist_line(d: Domain) -> DataFrame:
    by_day = d.named_package().withColumn("day", F.dayofmonth("activation_date"))
    means = ops.distribution(by_day, "line", "day", y="offer_amount", hue="offering_name")
    return means.withColumnRenamed("offer_amount", "AverageOfferAmount")


def dist_box(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "box", "event_type", y="value")


def dist_box_overall(d: Domain) -> DataFrame:
    return ops.distribution(d.loan_assign(), "box", "loan_amount")


def dist_kde(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "kde", "value")


def dist_kde_hue(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "kde", "value", hue="event_type")


def dist_violin(d: Domain) -> DataFrame:
    return ops.distribution(d.table("events"), "violin", "event_type", y="value")


# --- stored tables ---------------------------------------------------------------------------


def ingest_roundtrip(d: Domain) -> DataFrame:
    catalog = stored.recharges(d)
    read_back = ensure_timestamp(catalog.read("recharge"), "recharge_dt")
    return read_back.select("bib_id", "month", "fake_id", "recharge_value_amt", "recharge_dt")


def ingest_quarantine(d: Domain) -> DataFrame:
    catalog = stored.recharges(d, spoil=F.col("event_type") == "error")
    good = catalog.read("recharge").groupBy("month").agg(F.count(F.lit(1)).alias("good"))
    bad = catalog.quarantine("recharge").groupBy("month").agg(F.count(F.lit(1)).alias("bad"))
    return good.join(bad, "month", "full_outer")


def stored_churn_label(d: Domain) -> DataFrame:
    catalog = stored.extracts(d, {"package": ["0", "1"], "recharge": ["0", "1"]})
    return plans.generate_churn_label(catalog, "0", "1", THRESHOLD_DAYS)


def stored_churn_label_all_periods(d: Domain) -> DataFrame:
    months = stored.MONTHS
    catalog = stored.extracts(d, {"package": months, "recharge": months})
    return plans.generate_all_churn_labels(catalog, THRESHOLD_DAYS)


def _stored_training(d: Domain, include_loans: bool) -> DataFrame:
    loans = {"loan_assign": ["0"], "loan_recovery": ["0"]} if include_loans else {}
    catalog = stored.extracts(d, {"package": ["0", "1"], "recharge": ["0", "1"], "user": ["0"], **loans})
    label = plans.generate_churn_label(catalog, "0", "1", THRESHOLD_DAYS)
    return plans.generate_dataset(catalog, "0", label, AS_OF, include_loans)


def stored_training_table(d: Domain) -> DataFrame:
    return _stored_training(d, include_loans=False)


def stored_training_table_with_loans(d: Domain) -> DataFrame:
    return _stored_training(d, include_loans=True)


def stored_training_table_all_periods(d: Domain) -> DataFrame:
    months = stored.MONTHS
    catalog = stored.extracts(d, {"package": months, "recharge": months, "user": months})
    return plans.generate_all_datasets(catalog, AS_OF, THRESHOLD_DAYS)


def store_churn_labels(d: Domain) -> DataFrame:
    """Every label from the rows that a subscriber store keeps of each month."""
    store = stored.subscribers(d, {"package": stored.MONTHS, "recharge": stored.MONTHS}, features=False)
    return store.churn_labels(len(stored.MONTHS), THRESHOLD_DAYS)


def sketched_counts(d: Domain) -> DataFrame:
    """Purchases of each subscriber from sketches of each period, merged."""
    each = ops.sketch_by(d.table("events").withColumn("period", F.month("ts")), ["user_id", "period"], ["value"])
    merged = ops.merge_sketches(each, "user_id", ["value"])
    n = F.expr("kll_sketch_get_n_double(sketch_value)")
    return merged.select("user_id", F.col("rows").alias("n_rows"), n.cast("bigint").alias("n_values"), F.col("sum_value").alias("total"))


def store_training_table(d: Domain) -> DataFrame:
    """The training table of the first month from bucketed tables."""
    both = ["0", "1"]
    store = stored.subscribers(d, {"package": both, "recharge": both, "user": both}, features=True)
    return store.training_table(0, AS_OF, THRESHOLD_DAYS)


def ingest_all_tables(d: Domain) -> DataFrame:
    """Good rows of every stored table and month, and the sum of their first amount."""
    catalog = stored.extracts(d, {key: stored.MONTHS for key in SCHEMAS})
    parts = []
    for key, layout in SCHEMAS.items():
        amount = next(f.name for f in layout.fields if isinstance(f.dataType, DoubleType))
        sums = catalog.read(key, stored.MONTHS).groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("amount"))
        parts.append(sums.select(F.lit(key).alias("table_key"), "month", "rows", "amount"))
    return reduce(DataFrame.unionAll, parts)


# Digits kept where four are too few, or too many for the size of the sums.
_DIGITS = {
    "time_profile_loans": 2,
    "loan_recovery_ratio": 2,
    "loan_recovery_ratio_of_assigned": 2,
    "loan_assign_features": 6,
    "loan_recovery_features": 6,
    "package_features": 6,
    "recharge_features": 6,
    "user_attributes": 6,
    "training_table": 6,
    "training_table_with_loans": 6,
    "stored_training_table": 6,
    "stored_training_table_with_loans": 6,
    "stored_training_table_all_periods": 6,
    "store_training_table": 6,
    "ingest_all_tables": 2,
    "dist_line": 6,
    "dist_kde": 8,
    "dist_kde_hue": 8,
    "dist_violin": 8,
}

_BUILDERS = [
    loan_assign_features,
    loan_recovery_features,
    package_features,
    recharge_features,
    user_attributes,
    last_activity,
    first_activity,
    churn_label,
    churn_label_all_periods,
    training_table,
    training_table_with_loans,
    bin_loan_amount,
    bin_recharge,
    bin_duration,
    sum_by_person,
    time_profile,
    time_profile_loans,
    count_by_offering,
    top_offerings,
    top_duration_categories,
    top_loans,
    preview_customers,
    ages_today,
    value_counts,
    common_loans,
    loan_recovery_by_loan,
    loan_recovery_prefiltered,
    loan_recovery_ratio,
    loan_recovery_ratio_of_assigned,
    dist_count,
    dist_count_recharge,
    dist_hist,
    dist_hist_hue,
    dist_hist_time,
    dist_hist_category,
    dist_hist_person,
    dist_line,
    dist_box,
    dist_box_overall,
    dist_kde,
    dist_kde_hue,
    dist_violin,
    ingest_roundtrip,
    ingest_quarantine,
    stored_churn_label,
    stored_churn_label_all_periods,
    stored_training_table,
    stored_training_table_with_loans,
    stored_training_table_all_periods,
    sketched_counts,
    store_churn_labels,
    store_training_table,
    ingest_all_tables,
]


def _as_query(builder: Callable[[Domain], DataFrame]) -> Query:
    digits = _DIGITS.get(builder.__name__, 4)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(builder(Domain(spark, sf_dir)), digits)

    run.__name__ = builder.__name__
    return run


QUERIES: dict[str, Query] = {b.__name__: _as_query(b) for b in _BUILDERS}
