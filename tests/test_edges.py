"""Hand-made rows at the borders of each rule."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lapsewise import operators as ops
from lapsewise.functions import ensure_timestamp, percent_of
from lapsewise.operators import DURATION_BINS, LOAN_AMOUNT_BINS


def _stream(spark, rows, name):
    return spark.createDataFrame(rows, f"bib_id string, {name} string")


def _packages(spark, rows):
    return _stream(spark, rows, "activation_date")


def _recharges(spark, rows):
    return _stream(spark, rows, "recharge_dt")


# --- time --------------------------------------------------------------------------------------


def test_text_becomes_timestamp_or_null(spark):
    df = spark.createDataFrame([("20240229 23:59:59",), ("junk",), ("20240101",), (None,)], "t string")
    parsed = ensure_timestamp(df, "t")
    assert [r[0] for r in parsed.collect()] == [dt.datetime(2024, 2, 29, 23, 59, 59), None, None, None]
    with pytest.raises(PySparkException):
        ensure_timestamp(df, "t", strict=True).collect()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamps_are_left_alone(spark, kind):
    df = spark.sql(f"SELECT cast('2024-01-01 00:00:00' AS {kind}) AS t")
    assert ensure_timestamp(df, "t") is df


def test_ratio_without_base_is_null(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    got = df.select(percent_of(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [25.0, None, None]


# --- binning -----------------------------------------------------------------------------------


def test_intervals_are_closed_on_the_right(spark):
    values = [5000.0, 5000.01, 100000.0, 1e9, math.inf, None, math.nan, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "loan_amount double")
    got = ops.categorize(df, "loan_amount", LOAN_AMOUNT_BINS.edges, LOAN_AMOUNT_BINS.labels)
    assert [r["category"] for r in got.collect()] == [
        "VeryLow", "5T-10T", "50T-100T", "Extreme", "Extreme", None, "NaN", "-Infinity",
    ]


def test_value_outside_all_bins_keeps_its_text(spark):
    df = spark.createDataFrame([(0,), (1,), (7,)], "v int")
    got = ops.categorize(df, "v", [0, 5], ["small"], "v")
    assert [r["v"] for r in got.collect()] == ["0", "small", "7"]


def test_durations(spark):
    start = dt.date(2024, 1, 1)
    days = [-5, 0, 1, 7, 8, 15, 16, 30, 60, 120, 180, 365, 366]
    rows = [(start, start + dt.timedelta(d)) for d in days]
    df = spark.createDataFrame(rows, "activation_date date, deactivation_date date")
    got = ops.categorize_time_difference(df).collect()
    assert [r["time_difference_days"] for r in got] == days
    assert [r["duration_category"] for r in got] == [
        "Same Day", "Same Day", "Daily", "Weekly", "Half-Monthly", "Half-Monthly", "Monthly",
        "Monthly", "2 Months", "4 Months", "6 Months", "1 Year", "More than 1 Year",
    ]


def test_bins_and_labels_must_fit(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    for edges, labels in ([[0, 1], ["a", "b"]], [[], []]):
        with pytest.raises(ValueError, match="one edge more"):
            ops.categorize(df, "v", edges, labels)
    with pytest.raises(ValueError, match="empty"):
        ops.categorize(df, "v", [1], [])


def test_preset_sizes():
    for preset in (DURATION_BINS, LOAN_AMOUNT_BINS, ops.RECHARGE_BINS):
        assert len(preset.edges) == len(preset.labels) + 1
        assert list(preset.edges) == sorted(preset.edges)


# --- activity and label ------------------------------------------------------------------------


def test_activity_over_two_sources(spark):
    packages = _packages(
        spark, [("a", "20240101 10:00:00"), ("a", "20240105 10:00:00"), ("b", "junk"), (None, "20240101 00:00:00")]
    )
    recharges = _recharges(spark, [("a", "20240103 10:00:00"), ("c", "20240110 00:00:00"), ("b", None)])
    last = {r[0]: r[1] for r in ops.subscriber_activity(packages, recharges, "max").collect()}
    first = {r[0]: r[1] for r in ops.subscriber_activity(packages, recharges, "min").collect()}
    assert last == {"a": dt.datetime(2024, 1, 5, 10), "b": None, "c": dt.datetime(2024, 1, 10)}
    assert first["a"] == dt.datetime(2024, 1, 1, 10)
    with pytest.raises(ValueError):
        ops.subscriber_activity(packages, recharges, "avg")


def test_label_borders(spark):
    current = [(k, "20240101 12:00:00") for k in ("d29", "d30", "d31", "gone")]
    current.append(("unread", "junk"))
    following = [
        ("d29", "20240130 00:00:00"),
        ("d30", "20240131 23:59:59"),
        ("d31", "20240201 00:00:00"),
        ("unread", "junk"),
        ("new", "20240201 00:00:00"),
    ]
    none = _recharges(spark, [])
    label = ops.prepare_churn_label(
        _packages(spark, current), none, _packages(spark, following), none
    )
    assert {r[0]: r[1] for r in label.collect()} == {
        "d29": 0, "d30": 0, "d31": 1, "gone": 1, "unread": 0,
    }


def test_label_takes_the_first_following_date_of_either_source(spark):
    label = ops.prepare_churn_label(
        _packages(spark, [("a", "20240101 00:00:00")]),
        _recharges(spark, [("a", "20240110 00:00:00")]),
        _packages(spark, [("a", "20240301 00:00:00")]),
        _recharges(spark, [("a", "20240209 00:00:00")]),
    )
    assert label.collect()[0]["label"] == 0  # 10 January to 9 February: 30 days


def test_all_periods_leave_out_the_last_and_do_not_skip(spark):
    day = "2024-0{}-01".format
    rows = [("a", 0, day(1)), ("a", 2, day(1)), ("b", 0, day(1)), ("b", 1, day(1)), ("b", 2, day(5))]
    df = spark.createDataFrame(rows, "bib_id string, period int, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    got = {(r[0], r[1]): r[2] for r in ops.churn_label_all_periods(df).collect()}
    assert got == {("a", 0): 1, ("b", 0): 0, ("b", 1): 1}
    later = {(r[0], r[1]) for r in ops.churn_label_all_periods(df, last_period=3).collect()}
    assert later == {*got, ("a", 2), ("b", 2)}


# --- features ----------------------------------------------------------------------------------


def test_nulls_count_as_rows_but_not_as_amounts(spark):
    df = spark.createDataFrame(
        [("a", 10.0), ("a", None), ("b", None), ("c", 1.0), ("c", 2.0), ("c", 10.0), ("c", 11.0)],
        "bib_id string, recharge_value_amt double",
    )
    got = {r[0]: tuple(r)[1:] for r in ops.prepare_recharge_df(df).collect()}
    assert got == {"a": (10.0, 10.0, 2), "b": (None, None, 1), "c": (6.0, 6.0, 4)}


def test_approximate_medians_are_near(spark):
    df = spark.range(1, 10_002).select(F.lit("a").alias("bib_id"), F.col("id").alias("loan_amount"))
    got = ops.prepare_assign_df(df, exact=False).first()
    assert got["AverageAssignLoanAmount"] == 5001.0
    assert abs(got["MedianAssignLoanAmount"] - 5001) <= 2


def test_key_may_be_several_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 3.0), ("a", 2, 5.0)], "bib_id string, period int, loan_amount double"
    )
    got = {tuple(r)[:2]: tuple(r)[2:] for r in ops.prepare_assign_df(df, ["bib_id", "period"]).collect()}
    assert got == {("a", 1): (1.0, 1.0), ("a", 2): (4.0, 4.0)}


_USER = (
    "bib_id string, contract_type_v string, gender_v string, registration_date_d string, "
    "date_of_birth_d string, ability_status string, account_balance double"
)


def _users(spark, keys):
    return spark.createDataFrame([(k, "x", "f", "20200315", "19900101", "s", 1.5) for k in keys], _USER)


def test_user_attributes(spark):
    got = ops.prepare_user_df(_users(spark, ["a"]), as_of="1991-01-01").first()
    assert got["age"] == 365 / 365.25 and got["registration_year"] == 2020
    assert list(got.asDict()) == [
        "bib_id", "age", "registration_year", "contract_type_v", "gender_v", "ability_status",
        "account_balance",
    ]
    today = ops.prepare_user_df(_users(spark, ["a"])).first()["age"]
    assert today > 30


def _training_inputs(spark, users):
    packages = spark.createDataFrame(
        [("a", 5.0, "20240101 00:00:00", "20240103 00:00:00")],
        "bib_id string, offer_amount double, activation_date string, deactivation_date string",
    )
    recharges = spark.createDataFrame([("b", 7.0)], "bib_id string, recharge_value_amt double")
    loans = spark.createDataFrame([("a", 100.0)], "bib_id string, loan_amount double")
    return ops.prepare_data(loans, loans, packages, recharges, users, as_of="2024-01-01")


def test_training_table(spark):
    label = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "bib_id string, label int")
    features = _training_inputs(spark, _users(spark, ["a", "b", "b"]))
    wide = ops.merge_dataframes(features, label)
    assert wide.columns == [
        "bib_id", "label", "AveragePackageAmount", "MedianPackageAmount", "AveragePackageDuration",
        "MedianPackageDuration", "CountPackage", "AverageRechargeAmount", "MedianRechargeAmount",
        "CountRecharge", "age", "registration_year", "contract_type_v", "gender_v",
        "ability_status", "account_balance",
    ]
    rows = wide.collect()
    assert sorted(r["bib_id"] for r in rows) == ["a", "b", "b", "c"]  # a repeated user repeats
    by_key = {r["bib_id"]: r for r in rows}
    assert by_key["a"]["CountRecharge"] is None and by_key["a"]["MedianPackageDuration"] == 2.0
    assert by_key["c"]["age"] is None and by_key["c"]["CountPackage"] is None
    with_loans = ops.merge_dataframes(features, label, include_loans=True)
    assert with_loans.columns[2:6] == [
        "AverageAssignLoanAmount", "MedianAssignLoanAmount", "AverageRecoveryLoanAmount",
        "MedianRecoveryLoanAmount",
    ]
    with pytest.raises(ValueError, match="not unique"):
        ops.merge_dataframes(features, label, unique_users=True)
    unique = _training_inputs(spark, _users(spark, ["a", "b"]))
    assert ops.merge_dataframes(unique, label, unique_users=True).count() == 3
    with pytest.raises(ValueError, match="include_loans"):
        ops.merge_dataframes(features._replace(assign=None), label, include_loans=True)


# --- recovery ----------------------------------------------------------------------------------


def _loans(spark, rows):
    return spark.createDataFrame(rows, "loan_id string, loan_amount double")


def _payments(spark, rows):
    return spark.createDataFrame(rows, "loan_id string, loan_amount double, hsdp_recovery double")


def test_recovery_counts_a_loan_once_per_payment_by_default(spark):
    assign = _loans(spark, [("1", 100.0), ("1", 100.0), ("2", 50.0), (None, 9.0)])
    recovery = _payments(spark, [("1", 100.0, 30.0), ("1", 100.0, 50.0), ("3", 7.0, 7.0), (None, 9.0, 9.0)])
    assert tuple(ops.loan_recovery_ratio(assign, recovery).first()) == (80.0, 200.0, 40.0)
    other = _loans(spark, [("1", 160.0), ("2", 50.0)])
    assert tuple(ops.loan_recovery_ratio(other, recovery, base="assign").first()) == (80.0, 160.0, 50.0)
    with pytest.raises(ValueError):
        ops.loan_recovery_ratio(assign, recovery, base="fee")
    assert sorted(r[0] or "" for r in ops.common_loans(assign, recovery).collect()) == ["", "1"]


def test_recovery_of_nothing_is_null(spark):
    got = ops.loan_recovery_ratio(_loans(spark, [("1", 1.0)]), _payments(spark, [("2", 1.0, 1.0)]))
    assert [tuple(r) for r in got.collect()] == [(None, None, None)]


# --- profiles ----------------------------------------------------------------------------------


def test_ties_go_to_the_smaller_value(spark):
    df = spark.createDataFrame([(v,) for v in "ccbbaad"] + [(None,)] * 2, "v string")
    assert [tuple(r) for r in ops.top_k(df, "v", 3).collect()] == [(None, 2), ("a", 2), ("b", 2)]
    assert [tuple(r) for r in ops.value_counts(df, "v").collect()] == [
        ("a", 2), ("b", 2), ("c", 2), ("d", 1),
    ]


def test_null_timestamps_have_their_own_row_per_part(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 7, 5), 1.0), (dt.datetime(2024, 1, 14, 5), 2.0), (None, 4.0)],
        "t timestamp, v double",
    )
    got = {(r["part"], r["value"]): r["sum_v"] for r in ops.sum_by_time_part(df, "t", "v").collect()}
    assert got == {
        ("hour", 5): 3.0, ("hour", None): 4.0,
        ("day_of_week", 1): 3.0, ("day_of_week", None): 4.0,
        ("day_of_month", 7): 1.0, ("day_of_month", 14): 2.0, ("day_of_month", None): 4.0,
    }


def test_preview(spark):
    assert ops.preview(spark.range(100)).count() == 20
    assert ops.preview(spark.range(100), 3).count() == 3


# --- distributions -----------------------------------------------------------------------------


def test_kinds_are_checked(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    with pytest.raises(ValueError, match="unknown kind"):
        ops.distribution(df, "pie", "v")
    with pytest.raises(TypeError):
        ops.distribution([1.0], "hist", "v")
    with pytest.raises(ValueError, match="needs y"):
        ops.distribution(df, "line", "v")
    for bad in ("fd", 0, [1.0], [2.0, 1.0]):
        with pytest.raises(ValueError):
            ops.histogram(df, "v", bins=bad)


def test_pandas_frames_are_taken(spark):
    got = ops.distribution(pd.DataFrame({"v": ["a", "b", "a"]}), "count", "v").collect()
    assert sorted(map(tuple, got)) == [("a", 2), ("b", 1)]


def test_degenerate_histograms(spark):
    same = spark.createDataFrame([(3.0,), (3.0,), (math.nan,), (math.inf,), (None,)], "v double")
    assert [tuple(r) for r in ops.histogram(same, "v").collect()] == [(0, 2.5, 3.5, 2)]
    assert ops.histogram(same.limit(0), "v").collect() == []
    edges = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0, 2.0, 4.0, 5.0)], "v double")
    got = ops.histogram(edges, "v", bins=[0, 1, 4]).orderBy("bin").collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 1.0, 1), (1, 1.0, 4.0, 3)]


def test_no_density_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("c", 1.0), ("c", 3.0)], "g string, v double")
    assert {r["g"] for r in ops.kde(df, "v", hue="g").collect()} == {"c"}
    assert ops.kde(df.where("g = 'a'"), "v").collect() == []
    assert ops.kde(df.limit(0), "v").collect() == []


def test_group_names_do_not_collide_with_internal_ones(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("b", 7.0)], "step string, lo double")
    assert ops.kde(df, "lo", hue="step").columns == ["step", "grid", "x", "density"]
    assert ops.box(df, "step", "lo").columns[0] == "step"
    assert ops.histogram(df, "lo", hue="step").columns[0] == "step"
