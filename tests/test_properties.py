"""Different ways to the same result, on random rows and on the given tables."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise import operators as ops
from lapsewise.workload.domain import Domain

SF_DIR = "/root/testdata/sf0.001"
ORIGIN = dt.datetime(2024, 1, 1)


def _random_activity(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [
        (
            f"k{rng.randint(0, 30)}",
            rng.choice([0, 1, 3]),
            rng.choice([None, ORIGIN + dt.timedelta(hours=rng.randint(0, 2400))]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "bib_id string, period int, at timestamp")


@pytest.mark.parametrize("how", ["max", "min"])
def test_one_union_equals_the_outer_join_of_two_aggregates(spark, how):
    pick, across = (F.max, F.greatest) if how == "max" else (F.min, F.least)
    packages = _random_activity(spark, 1, 60).withColumnRenamed("at", "activation_date")
    recharges = _random_activity(spark, 2, 60).withColumnRenamed("at", "recharge_dt")
    joined = (
        packages.groupBy("bib_id").agg(pick("activation_date").alias("p"))
        .join(recharges.groupBy("bib_id").agg(pick("recharge_dt").alias("r")), "bib_id", "full_outer")
        .select("bib_id", across("p", "r").alias(f"{how}_date"))
    )
    union = ops.subscriber_activity(packages, recharges, how)
    assert sorted(map(str, union.collect())) == sorted(map(str, joined.collect()))


def test_all_periods_equal_period_by_period(spark):
    rows = _random_activity(spark, 3)
    every = ops.churn_label_all_periods(rows, 20, ts="at")
    got = sorted(tuple(r) for r in every.collect())
    want = []
    none = rows.limit(0).select("bib_id", F.col("at").alias("recharge_dt"))
    for period in (0, 1, 2):
        now, then = (
            rows.where(F.col("period") == p).select("bib_id", F.col("at").alias("activation_date"))
            for p in (period, period + 1)
        )
        pair = ops.prepare_churn_label(now, none, then, none, 20)
        want += [(r["bib_id"], period, r["label"]) for r in pair.collect()]
    assert got == sorted(want)


def test_parts_of_a_time_profile_sum_to_the_total(spark):
    loans = Domain(spark, SF_DIR).loan_assign()
    total = loans.agg(F.sum("loan_amount")).first()[0]
    profile = ops.sum_by_time_part(loans, "date_timestamp", "loan_amount")
    for row in profile.groupBy("part").agg(F.sum("sum_loan_amount").alias("s")).collect():
        assert math.isclose(row["s"], total, rel_tol=1e-9)
    ordered = [(r["part"], r["value"]) for r in profile.collect()]
    assert ordered == sorted(ordered)


def test_time_profile_equals_grouping_sets(spark):
    loans = Domain(spark, SF_DIR).loan_assign()
    loans.createOrReplaceTempView("profiled_loans")
    sets = spark.sql(
        """SELECT CASE grouping_id() WHEN 3 THEN 'hour' WHEN 5 THEN 'day_of_week'
                       ELSE 'day_of_month' END AS part,
                  coalesce(h, w, d) AS value, sum(loan_amount) AS s
           FROM (SELECT hour(date_timestamp) h, dayofweek(date_timestamp) w,
                        day(date_timestamp) d, loan_amount FROM profiled_loans)
           GROUP BY GROUPING SETS ((h), (w), (d))"""
    )
    want = {(r["part"], r["value"]): r["s"] for r in sets.collect()}
    got = {
        (r["part"], r["value"]): r["sum_loan_amount"]
        for r in ops.sum_by_time_part(loans, "date_timestamp", "loan_amount").collect()
    }
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_recovery_by_loan_equals_sql(spark):
    domain = Domain(spark, SF_DIR)
    assign, recovery = domain.loan_assign().where("loan_id % 3 = 0"), domain.loan_recovery()
    assign.createOrReplaceTempView("some_assigned")
    recovery.createOrReplaceTempView("all_paid")
    joined = spark.sql(
        """SELECT loan_id, sum(loan_amount) AS a, sum(hsdp_recovery) AS b FROM all_paid p
           WHERE EXISTS (SELECT 1 FROM some_assigned s WHERE s.loan_id = p.loan_id)
           GROUP BY loan_id"""
    )
    want = {r["loan_id"]: (r["a"], r["b"]) for r in joined.collect()}
    got = {r[0]: (r[1], r[2]) for r in ops.recovery_by_loan(assign, recovery).collect()}
    assert got.keys() == want.keys() and len(got) > 100
    for loan, sums in want.items():
        assert np.allclose(got[loan], sums, rtol=1e-12)


def test_histogram_equals_numpy(spark):
    events = Domain(spark, SF_DIR).table("events")
    values = [r[0] for r in events.select("value").collect()]
    for bins in ("auto", 7, [0, 10, 50, 300]):
        counts, edges = np.histogram(values, bins=bins)
        rows = {r["bin"]: r for r in ops.histogram(events, "value", bins=bins).collect()}
        assert {b: r["count"] for b, r in rows.items()} == dict(enumerate(counts))
        for i, row in rows.items():
            assert np.allclose([row["bin_start"], row["bin_end"]], edges[i : i + 2], rtol=1e-12)


def test_histogram_of_times_and_categories(spark):
    df = spark.sql(
        "SELECT g, timestamp_seconds(v) AS t, CAST(timestamp_seconds(v) AS timestamp_ntz) AS w, date_from_unix_date(v) AS d "
        "FROM VALUES ('a', 0), ('a', 5), ('b', 10) AS x(g, v)"
    )
    want = [(0, 0.0, 5.0, 1), (1, 5.0, 10.0, 2)]
    for name in ("t", "w"):
        assert [tuple(r) for r in ops.histogram(df, name, bins=2).orderBy("bin").collect()] == want
    days = [tuple(r) for r in ops.histogram(df, "d", bins=2).orderBy("bin").collect()]
    assert days == [(b, 86400 * lo, 86400 * hi, n) for b, lo, hi, n in want]
    assert sorted(map(tuple, ops.histogram(df, "g").collect())) == [("a", 2), ("b", 1)]
    by = ops.histogram(df.withColumn("h", (F.col("g") == "a").cast("string")), "g", hue="h")
    assert sorted(map(tuple, by.collect())) == [("false", "a", 0), ("false", "b", 1), ("true", "a", 2), ("true", "b", 0)]


def _gauss(values, grid):
    bw = len(values) ** -0.2 * np.std(values, ddof=1)
    z = (grid[:, None] - values[None, :]) / bw
    return np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * bw * math.sqrt(2 * math.pi)), bw


def test_density_is_complete(spark):
    events = Domain(spark, SF_DIR).table("events")
    values = np.array([r[0] for r in events.select("value").collect()])
    rows = ops.kde(events, "value").orderBy("grid").collect()
    x, density = (np.array([r[c] for r in rows]) for c in ("x", "density"))
    want, bw = _gauss(values, x)
    assert len(rows) == 200
    assert np.allclose(density, want, rtol=1e-9, atol=0)
    assert np.allclose(x[[0, -1]], [values.min() - 3 * bw, values.max() + 3 * bw])
    assert abs(np.trapezoid(density, x) - 1) < 1e-3


def test_far_outliers_leave_an_empty_middle(spark):
    rng = random.Random(2)
    data = [rng.gauss(0, 1) for _ in range(3000)] + [10_000.0]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    rows = ops.kde(df, "v").orderBy("grid").collect()
    want, _ = _gauss(np.array(data), np.array([r["x"] for r in rows]))
    assert len(rows) == 200
    assert np.allclose([r["density"] for r in rows], want, rtol=1e-9, atol=0)


def test_densities_of_all_hues_have_area_one_together(spark):
    events = Domain(spark, SF_DIR).table("events")

    def areas(common_norm):
        pdf = ops.kde(events, "value", hue="event_type", common_norm=common_norm).toPandas()
        return [
            np.trapezoid(g.sort_values("x").density, g.sort_values("x").x)
            for _, g in pdf.groupby("event_type")
        ]

    assert abs(sum(areas(True)) - 1) < 1e-2
    assert all(abs(a - 1) < 1e-2 for a in areas(False))


def test_box_counts_every_row_once(spark):
    events = Domain(spark, SF_DIR).table("events")
    values = {}
    for kind, value in events.select("event_type", "value").collect():
        values.setdefault(kind, []).append(value)
    for row in ops.box(events, "event_type", "value").collect():
        v = np.array(values[row["event_type"]])
        q1, q3 = np.quantile(v, [0.25, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert row["n"] == len(v) and row["n_outliers"] == len(v) - len(inside)
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())


def test_line_is_the_identity_on_one_value_per_point(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 0.5)], "x int, y double")
    assert [tuple(r) for r in ops.distribution(df, "line", "x", y="y").collect()] == [
        (1, 2.0), (2, 0.5), (3, 1.0),
    ]
