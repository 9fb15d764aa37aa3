"""The shape of the plans: what is shuffled, joined and read."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as contract
from lapsewise.workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NAMES = [n for n in QUERIES if not n.startswith(("ingest", "store"))]


@pytest.fixture(scope="module")
def plan(spark):
    """Formatted plan of a query when no table is small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def text(name):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            contract.queries()[name](spark, SF_DIR).explain("formatted")
        return out.getvalue()

    yield text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _count(text, node):
    return len(re.findall(rf"[-:] {node} \(|^{node} \(", text.split("\n\n")[0], re.M))


@pytest.mark.parametrize("name", NAMES)
def test_no_query_pairs_all_rows_or_leaves_the_jvm(plan, name):
    text = plan(name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert node not in text


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("last_activity", 1),
        ("churn_label", 1),
        ("churn_label_all_periods", 1),
        # rows dealt and kept values (thrice, run once), a row a group (twice, run once), bounds to the
        # parts, what lies between them: five that run, three without large groups
        ("loan_assign_features", 9),
        ("recharge_features", 9),
        # line items are counted before they meet the part table
        ("count_by_offering", 3),
        ("package_features", 15),
        ("sum_by_person", 1),
        ("dist_count", 1),
        ("bin_loan_amount", 0),
        ("loan_recovery_by_loan", 2),
    ],
)
def test_shuffles(plan, name, shuffles):
    assert _count(plan(name), "Exchange") == shuffles


def test_features_read_only_their_columns(plan):
    reads = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan("loan_assign_features")))
    assert reads == {"o_custkey:bigint,o_totalprice:double"}


@pytest.mark.parametrize(
    "name", ["package_features", "training_table", "top_duration_categories"]
)
def test_part_is_not_read_for_what_it_does_not_give(plan, name):
    assert "part.parquet" not in plan(name)


def test_raw_line_items_are_not_shuffled_to_count_offerings(plan):
    assert "orders.parquet" not in plan("count_by_offering")


def test_filters_reach_the_scan(plan):
    assert "event_type" in plan("recharge_features").split("PushedFilters")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["dist_kde", "dist_kde_hue"])
def test_no_value_is_shuffled_for_a_density(plan, name):
    assert not re.search(r"hashpartitioning\([^)]*\b__v#", plan(name))


@pytest.mark.parametrize(
    "name",
    "loan_assign_features loan_recovery_features package_features recharge_features training_table "
    "training_table_with_loans dist_hist dist_hist_person dist_box dist_box_overall dist_kde_hue "
    "dist_violin".split(),
)
def test_building_a_query_runs_only_footer_reads(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build {name}", name)
    try:
        contract.queries()[name](spark, SF_DIR)
        jobs = len(tracker.getJobIdsForGroup(f"build {name}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 5  # one for each table that is opened


def test_top_k_is_not_a_full_sort(plan):
    assert "TakeOrderedAndProject" in plan("top_offerings")
