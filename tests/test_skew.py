"""Percentiles and joins of hot groups give what Spark's own buffers and joins give."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise import operators as ops
from lapsewise.workload.domain import Domain

def _values(rng, n):
    kinds = [
        lambda: rng.gauss(0, 1),
        lambda: rng.uniform(-1e9, 1e9),
        lambda: float(rng.randint(-3, 3)),
        lambda: 10 ** rng.uniform(-300, 300) * rng.choice([-1, 1]),
        lambda: 0.0,
        lambda: 99.5,
        lambda: -1.7e9 - rng.random() * 1e-3,  # all in one slice
    ]
    kind = rng.choice(kinds)
    return [kind() for _ in range(n)]


def _grouped(rng, keys=8):
    rows = []
    for i in range(keys):
        key = None if i == 0 else f"k{i}"
        values = _values(rng, rng.choice([1, 2, 3, 10, 60, 301]))
        rows += [(key, v) for v in values]
        rows += [(key, None)] * rng.choice([0, 1, 5])
    rows += [("only nulls", None)] * 50
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_percentiles_equal_one_buffer(spark, seed):
    df = spark.createDataFrame(_grouped(random.Random(seed)), "k string, v double").cache()
    points = {"v": {"q0": 0.0, "q1": 0.25, "m": 0.5, "p90": 0.9, "q4": 1.0}}
    short, long = (
        ops.summarise(df, "k", points, {"v": "mean"}, "n", buffered=b) for b in (True, False)
    )
    assert short.columns == long.columns
    got = {r["k"]: r for r in long.collect()}
    want = {r["k"]: r for r in short.collect()}
    assert got.keys() == want.keys() and len(want) == 9
    for key, row in want.items():
        for name in ("n", "q0", "q1", "m", "p90", "q4"):
            assert got[key][name] == row[name], (key, name)
        if row["mean"] is None:
            assert got[key]["mean"] is None
        else:
            assert math.isclose(got[key]["mean"], row["mean"], rel_tol=1e-9, abs_tol=1e-9)


def test_one_key_with_half_of_the_rows(spark):
    """No task gets the hot key: what is shuffled is keyed on the value too."""
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    half = F.when(F.col("event_id") % 2 == 0, 0).otherwise(F.col("user_id")).alias("k")
    df = events.select(half, "value")
    points = {"value": {"q1": 0.25, "m": 0.5}}
    got, want = (
        {r["k"]: (r["n"], r["q1"], r["m"]) for r in ops.summarise(df, "k", points, None, "n", buffered=b).collect()}
        for b in (False, True)
    )
    assert got == want and got[0][0] >= 50_000


@pytest.mark.parametrize("seed", range(2))
def test_percentiles_of_a_whole_column(spark, seed):
    rng = random.Random(seed)
    values = [rng.lognormvariate(0, 2) * rng.choice([-1, 1, 1]) for _ in range(997)]
    values += [0.0] * 11 + [7.25] * 40
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.75, "f": 1.0}
    row = ops.overall_percentiles(df, "v", probs, "n").first()
    short = ops.overall_percentiles(df, "v", probs, "n", buffered=True).first()
    assert row == short
    assert row["n"] == len(values)
    for name, p in probs.items():
        assert math.isclose(row[name], np.quantile(values, p), rel_tol=1e-12, abs_tol=1e-12)


def test_special_values_keep_their_order(spark):
    inf, nan = math.inf, math.nan
    values = [nan, inf, -inf, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    # An even number of values: the interpolated places are avoided, ranks read exactly.
    points = {"v": {f"r{i}": i / 9 for i in (0, 1, 2, 7, 8, 9)}}
    row = ops.summarise(df, "k", points).first()
    assert row["r0"] == -inf and row["r1"] == -1.7e308 and row["r2"] == -5e-324
    assert row["r7"] == 1.7e308 and row["r8"] == inf and math.isnan(row["r9"])


def test_no_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert ops.overall_percentiles(empty, "v", {"m": 0.5}).collect() == []
    assert ops.overall_percentiles(empty, "v", {"m": 0.5}, buffered=True).collect() == []


def test_left_join_many_equals_a_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, x int")
    many = spark.createDataFrame(
        [("a", i) for i in range(50)] + [("b", 0), ("z", 1)] + [(None, i) for i in range(90)],
        "k string, y int",
    )
    plain = left.join(many, "k", "left")
    joined = ops.left_join_many(left, many, "k", salts=4)
    assert sorted(map(str, plain.collect())) == sorted(map(str, joined.collect()))
    assert joined.columns == plain.columns


def test_rows_of_a_hot_user_do_not_depend_on_their_order(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    many = spark.createDataFrame([("a", i % 7) for i in range(300)], "k string, y int")
    one, other = (ops.left_join_many(left, m, "k", salts=3) for m in (many, many.repartition(5, "y")))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, other.collect()), key=str)
    assert one.count() == 301


def test_distributions_without_groups_or_values(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None)], "g string, v double")
    assert ops.box(df, "g", y="v").collect() == []
    assert ops.kde(df, "v", hue="g").collect() == []
    assert ops.violin(df, "g", y="v").collect() == []


def test_training_table_with_repeated_users(spark):
    d = Domain(spark, "/root/testdata/sf0.001")
    label = ops.prepare_churn_label(d.signups(0), d.purchases(0), d.signups(1), d.purchases(1), 2)
    users = d.user().unionByName(d.user().where("bib_id < 5"))
    features = ops.prepare_data(None, None, d.package(), d.recharge(), users, as_of="2024-02-01")
    wide, salted = (ops.merge_dataframes(features, label, salts=n).collect() for n in (1, 3))
    assert len(wide) == 20  # 15 subscribers, five of them twice
    assert sorted(map(str, wide)) == sorted(map(str, salted))
