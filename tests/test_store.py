"""Subscriber stores, filters and candidates: what is read and shuffled, and edge cases."""

import bisect
import re
import shutil
from functools import partial

import pytest
from pyspark.sql import functions as F

from lapsewise import operators as ops
from lapsewise import plans
from lapsewise.operators.bloom import bloom_filter, possible_members
from lapsewise.plans import SubscriberStore
from lapsewise.sources import SCHEMAS, Catalog, ingest, schema_for

GOOD = "{},20240101,f,n,12.5,{} 10:00:00,host,1.0,13.5"
PACKAGE = "{},d,f,n,code,10,name,{},20240301 00:00:00"
USER = "{},f,n,pre,m,20200101,20000101,ok,5.5,base,site"


@pytest.fixture
def catalog(spark, tmp_path):
    catalog = Catalog(
        spark,
        ["package", "recharge", "user"],
        ["38", "39", "40"],
        {k: f"csv/{k}_{{month}}.csv" for k in SCHEMAS},
        {k: f"parquet/{k}/month={{month}}" for k in SCHEMAS},
        str(tmp_path),
    )
    (tmp_path / "csv").mkdir()
    for i, month in enumerate(catalog.months):
        days = f"2024010{i + 1}"
        rows = {
            "package": [PACKAGE.format(f"s{k}", f"{days} 00:00:00") for k in range(i, 9)] + [PACKAGE.format("", "junk")],
            "recharge": [GOOD.format(f"s{k}", days) for k in range(0, 12, i + 1)] * 3,
            "user": [USER.format(f"s{k}") for k in (0, 1, 1, 5)],
        }
        for key, lines in rows.items():
            with open(catalog.csv_path(key, month), "w") as file:
                file.write("\n".join([",".join(schema_for(key).names), *lines]) + "\n")
    ingest(catalog)
    return catalog


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_store_gives_what_the_months_give(spark, catalog, tmp_path):
    store = SubscriberStore(spark, str(tmp_path / "store"), buckets=4)
    for month in catalog.months:
        store.fold(catalog, month)
    assert _rows(store.churn_labels(3, 1)) == _rows(plans.generate_all_churn_labels(catalog, 1))
    label = plans.generate_churn_label(catalog, "38", threshold_days=1)
    want = plans.generate_dataset(catalog, "38", label, as_of="2024-02-01")
    assert _rows(store.training_table(0, "2024-02-01", 1)) == _rows(want)
    with pytest.raises(ValueError, match="period 3 has not been folded in"):
        store.churn_label(2)


def test_nothing_is_shuffled_by_the_subscriber(spark, catalog, tmp_path):
    store = SubscriberStore(spark, str(tmp_path / "store"), buckets=4)
    for month in catalog.months[:2]:
        store.fold(catalog, month)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (store.churn_label(0), store.training_table(0, "2024-02-01")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_older_months_are_not_read(spark, catalog, tmp_path):
    """A month is folded in, and judged, with all older extracts gone."""
    store = SubscriberStore(spark, str(tmp_path / "store"), buckets=4)
    want = _rows(plans.generate_churn_label(catalog, "39", threshold_days=1))
    for month in catalog.months:
        store.fold(catalog, month)
        for key in catalog.keys:
            shutil.rmtree(tmp_path / f"parquet/{key}/month={month}")
    assert _rows(store.churn_label(1, 1)) == want


def test_a_month_folded_anew_and_a_store_found_again(spark, catalog, tmp_path):
    folder = str(tmp_path / "it's a store")
    store = SubscriberStore(spark, folder, buckets=4)
    for month in ("38", "39", "39"):
        store.fold(catalog, month, features=False)
    want = _rows(store.churn_label(0))
    for name in [t.name for t in spark.catalog.listTables() if t.name == store._name("activity", 0)]:
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, as at the end of a session
    assert _rows(SubscriberStore(spark, folder, buckets=4).churn_label(0)) == want


def test_bloom_filter_loses_nothing(spark):
    keys = spark.range(0, 100_000, 7).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("k"))
    rows = spark.range(100_000).select(F.col("id").alias("k"), F.lit(1).alias("__word2"))
    passed = {r.k for r in possible_members(rows, "k", bloom_filter(keys, "k")).collect()}
    wanted = {i for i in range(0, 100_000, 7) if i % 5}
    assert wanted <= passed and len(passed) < 1.02 * len(wanted) + 100
    assert possible_members(rows, "k", bloom_filter(keys.where("false"), "k")).count() == 0


def test_payments_of_other_loans_are_not_shuffled(spark):
    assign = spark.range(0, 200_000, 100).select(F.col("id").alias("loan_id"))
    paid = spark.range(400_000, numPartitions=4).selectExpr("id DIV 2 AS loan_id", "1D AS loan_amount", "2D AS hsdp_recovery")
    sizes = []
    # As if the assigned loans were too many to be sent to every task.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for prefilter in (False, True):
            spark.sparkContext.setJobGroup(f"sum {prefilter}", "")
            assert len(ops.recovery_by_loan(assign, paid, prefilter=prefilter).collect()) == 2000
            sizes.append(_written(spark, f"sum {prefilter}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sizes[1] < sizes[0] / 10  # one loan in a hundred is assigned


def _written(spark, group):
    """Bytes that a job group's stages wrote to shuffles."""
    sc = spark.sparkContext
    stages = {s for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds}
    store, total = sc._jsc.sc().statusStore(), 0
    none = sc._gateway.new_array(sc._jvm.double, 0)
    found = store.stageList(None, False, False, none, sc._jvm.java.util.ArrayList())
    for i in range(found.size()):
        if found.apply(i).stageId() in stages:
            total += found.apply(i).shuffleWriteBytes()
    return total


def test_top_k_of_many_equals_top_k(spark):
    """With ties at the edge, nulls, few slots and fewer values than asked for."""
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 70 WHEN id % 97 = 1 THEN NULL ELSE id END AS v")
    for k, slots in ((5, 1 << 16), (8, 1 << 10), (30, 16), (3, 1)):
        many = ops.top_k_of_many(rows, "v", k, slots).collect()
        assert many == ops.top_k(rows, "v", k).collect()
    few = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert ops.top_k_of_many(few, "v", 10).collect() == ops.top_k(few, "v", 10).collect()
    assert ops.top_k_of_many(few.where("false"), "v", 3).collect() == []


def test_only_candidates_are_shuffled_by_value(spark):
    rows = spark.range(300_000, numPartitions=4).selectExpr("CASE WHEN id % 4 = 0 THEN id % 40 ELSE id END AS v")
    sizes = []
    for name, way in (("all", ops.top_k), ("some", partial(ops.top_k_of_many, slots=1 << 10))):
        spark.sparkContext.setJobGroup(f"top {name}", "")
        way(rows, "v", 5).collect()
        sizes.append(_written(spark, f"top {name}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sizes[1] < sizes[0] / 5


def test_previews_repeat(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS g", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS t")
    first = ops.preview_sample(df, 12).collect()
    assert len(first) == 12 and first == ops.preview_sample(df.repartition(9, "g"), 12).collect()
    assert first != ops.preview_sample(df, 12, seed=1).collect()
    assert not re.search("[0-9a-f]{32}", str(first))


def test_merged_sketches_keep_to_their_bound(spark):
    """Ranks of percentiles over twelve months of one hot key and many others, within 1.33 % of its rows."""
    n = 200_000
    rows = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN id % 400 ELSE -1 END AS k", "id % 12 AS month", "pow(10, 6 * rand(3)) AS v", "NULL AS w"
    ).cache()
    probs = {f"p{i}": i / 20 for i in range(1, 20)}
    merged = ops.merge_sketches(ops.sketch_by(rows, ["k", "month"], ["v", "w"]), "k", ["v", "w"])
    got = {r["k"]: r for r in ops.summarise_sketches(merged, "k", {"v": probs, "w": {"none": 0.5}}, {"v": "mean", "w": "nil"}, "n").collect()}
    values = {}
    for r in rows.select("k", "v").toArrow().to_pylist():
        values.setdefault(r["k"], []).append(r["v"])
    rows.unpersist()
    assert got.keys() == values.keys() and len(values[-1]) > n // 2
    for k, found in values.items():
        assert got[k]["n"] == len(found) and got[k]["mean"] == pytest.approx(sum(found) / len(found))
        assert got[k]["none"] is None and got[k]["nil"] is None
    hot = sorted(values[-1])
    for name, p in probs.items():
        assert abs(bisect.bisect(hot, got[-1][name]) / len(hot) - p) < 0.0133


def test_features_over_months_from_the_store(spark, catalog, tmp_path):
    store = SubscriberStore(spark, str(tmp_path / "store"), buckets=4)
    for month in catalog.months:
        store.fold(catalog, month)
    for kind, table, way in (("recharge_sketch", "recharge", ops.prepare_recharge_df), ("package_sketch", "package", ops.prepare_package_df)):
        got = store.features_over(kind, [0, 1, 2])
        # Amounts are all equal, and so few that sketches hold them all.
        assert _rows(got) == _rows(way(catalog.read(table)).select(*got.columns))
