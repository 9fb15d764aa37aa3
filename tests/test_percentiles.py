"""Exact percentiles of groups that are too large for the values their parts keep."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise import operators as ops
from lapsewise.operators import quantiles

POINTS = {"v": {"q0": 0.0, "q1": 0.25, "m": 0.5, "p99": 0.99, "q4": 1.0}}


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _exchanges(plan):
    """Different exchanges that ran; one that is used again is listed again with the same number."""
    return len(set(re.findall(r"- (?:Broadcast)?Exchange .*plan_id=(\d+)\]", plan)))


@pytest.fixture
def many_tasks(spark):
    """As many tasks as parts, which adaptive execution does not put together again."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _largest_read(spark, action):
    """The most records that any task read from shuffles while ``action`` ran."""
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    none = sc._gateway.new_array(sc._jvm.double, 0)
    seen = {s.stageId() for s in _scala(sc, store.stageList(None, False, False, none, sc._jvm.java.util.ArrayList()))}
    result = action()
    most = 0
    for stage in _scala(sc, store.stageList(None, False, False, none, sc._jvm.java.util.ArrayList())):
        if stage.stageId() not in seen:
            for task in _scala(sc, store.taskList(stage.stageId(), stage.attemptId(), 10_000)):
                if task.taskMetrics().isDefined():
                    most = max(most, task.taskMetrics().get().shuffleReadMetrics().recordsRead())
    return result, most


def _scala(sc, seq):
    return [seq.apply(i) for i in range(seq.size())]


@pytest.mark.parametrize("seed, shards, points", [(0, 3, 4), (1, 1, 2), (2, 7, 1), (3, 2, 30)])
def test_groups_larger_than_what_is_kept(spark, monkeypatch, seed, shards, points):
    """The bounds leave several candidates, and what lies between them decides."""
    monkeypatch.setattr(quantiles, "SHARDS", shards)
    monkeypatch.setattr(quantiles, "POINTS", points)
    draw = random.Random(seed)
    rows = [("hot", draw.gauss(0, 1), None) for _ in range(900)] + [("same", 7.5, draw.random()) for _ in range(400)]
    rows += [("few", draw.choice([1.0, 2.0, math.inf, -math.inf, None]), 3.0) for _ in range(300)]
    rows += [(None, draw.uniform(0, 1e-9) + 1e9, draw.random()) for _ in range(300)] + [("one", 1.0, None), ("none", None, None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double, u double").repartition(5)
    both = {**POINTS, "u": {"um": 0.5, "u9": 0.9}}
    got, want = (
        {r["k"]: r for r in ops.summarise(df, "k", both, {"v": "mean"}, "n", "values", buffered=b).collect()} for b in (False, True)
    )
    assert got.keys() == want.keys() and len(got) == 6
    for key, row in want.items():
        for name, value in row.asDict().items():
            mine = got[key][name]
            same = mine == value or mine is not None and value is not None and (
                math.isnan(mine) and math.isnan(value) or name == "mean" and math.isclose(mine, value, rel_tol=1e-9, abs_tol=1e-9)
            )
            assert same, (key, name, mine, value)


def test_narrow_values_of_one_hot_group(spark, many_tasks, monkeypatch):
    """A million different values within a thousandth of an octave, nearly all under one key: no task of
    any stage reads a tenth of them."""
    monkeypatch.setattr(quantiles, "POINTS", 128)
    n = 1_000_000
    key = F.when(F.col("id") % 1000 == 0, F.col("id")).otherwise(-1)
    rows = spark.range(n, numPartitions=32).select(key.alias("k"), (F.lit(1.7e9) + F.pmod(F.col("id") * 7919, F.lit(n)) * 1e-3).alias("v"))
    got, most = _largest_read(spark, lambda: ops.summarise(rows, "k", POINTS, None, "n").collect())
    ids = np.arange(n)
    values = 1.7e9 + ids * 7919 % n * 1e-3
    hot = np.quantile(values[ids % 1000 != 0], list(POINTS["v"].values()))
    assert len(got) == 1001
    for row in got:
        want = hot if row["k"] < 0 else [values[row["k"]]] * 5
        assert [row[c] for c in POINTS["v"]] == pytest.approx(want, rel=1e-15)
    assert most < n / 10


def test_shuffles_of_one_column(spark, monkeypatch):
    """Rows, kept values, a row for each group; for larger groups also its bounds to the parts and what lies between
    them. The work before a shuffle that is used twice is done once."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
        small = ops.summarise(events, "user_id", {"value": {"m": 0.5}})
        small.collect()
        assert _exchanges(_final_plan(small)) == 3
        monkeypatch.setattr(quantiles, "POINTS", 64)
        large = ops.summarise(spark.range(400_000, numPartitions=4).selectExpr("id % 2 AS k", "rand(1) AS value"), "k", {"value": {"m": 0.5}})
        large.collect()
        monkeypatch.undo()
        plan = _final_plan(large)
        assert _exchanges(plan) == 5 and plan.count("ReusedExchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buffered_is_passed_on(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "bib_id string, loan_amount double")
    plans = [
        ops.prepare_assign_df(df, buffered=True),
        ops.prepare_recovery_df(df, buffered=True),
        ops.histogram(df, "loan_amount", buffered=True),
        ops.box(df, "bib_id", y="loan_amount", buffered=True),
        ops.distribution(df, "violin", "bib_id", y="loan_amount", buffered=True),
    ]
    for plan in plans:
        assert "percentile(" in plan._jdf.queryExecution().toString()
    for way in (ops.prepare_assign_df, lambda d, **k: ops.box(d, "bib_id", y="loan_amount", **k)):
        assert sorted(map(str, way(df).collect())) == sorted(map(str, way(df, buffered=True).collect()))
