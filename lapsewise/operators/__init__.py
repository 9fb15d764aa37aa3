"""DataFrame operators: binning, activity and labels, features, recovery, profiles."""

from lapsewise.operators.activity import (
    activity_stream,
    churn_flag,
    churn_label_all_periods,
    prepare_churn_label,
    subscriber_activity,
)
from lapsewise.operators.binning import (
    DURATION_BINS,
    LOAN_AMOUNT_BINS,
    RECHARGE_BINS,
    Bins,
    bin_label,
    categorize,
    categorize_time_difference,
)
from lapsewise.operators.distribution import (
    box,
    count_distribution,
    distribution,
    histogram,
    kde,
    line_distribution,
    violin,
)
from lapsewise.operators.features import (
    Features,
    duplicate_keys,
    merge_dataframes,
    prepare_assign_df,
    prepare_data,
    prepare_package_df,
    prepare_recharge_df,
    prepare_recovery_df,
    prepare_user_df,
    require_unique,
)
from lapsewise.operators.profile import (
    count_by,
    preview,
    preview_sample,
    sum_by,
    sum_by_time_part,
    top_k,
    top_k_of_many,
    value_counts,
)
from lapsewise.operators.quantiles import overall_percentiles, summarise
from lapsewise.operators.recovery import common_loans, loan_recovery_ratio, recovery_by_loan
from lapsewise.operators.skew import left_join_many
from lapsewise.operators.sketches import merge_sketches, sketch_by, summarise_sketches

__all__ = [
    "Bins",
    "DURATION_BINS",
    "Features",
    "LOAN_AMOUNT_BINS",
    "RECHARGE_BINS",
    "activity_stream",
    "bin_label",
    "box",
    "categorize",
    "categorize_time_difference",
    "churn_flag",
    "churn_label_all_periods",
    "common_loans",
    "count_by",
    "count_distribution",
    "distribution",
    "duplicate_keys",
    "histogram",
    "kde",
    "left_join_many",
    "line_distribution",
    "loan_recovery_ratio",
    "merge_dataframes",
    "overall_percentiles",
    "prepare_assign_df",
    "prepare_churn_label",
    "prepare_data",
    "prepare_package_df",
    "prepare_recharge_df",
    "prepare_recovery_df",
    "prepare_user_df",
    "preview",
    "preview_sample",
    "recovery_by_loan",
    "require_unique",
    "subscriber_activity",
    "sum_by",
    "sum_by_time_part",
    "sketch_by",
    "merge_sketches",
    "summarise",
    "summarise_sketches",
    "top_k",
    "top_k_of_many",
    "value_counts",
    "violin",
]
