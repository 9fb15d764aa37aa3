"""CSV extracts in temporary folders: headers, bad rows, re-ingest, reading back."""

import contextlib
import dataclasses
import datetime as dt
import io
import os
import re

import pytest

from lapsewise import plans
from lapsewise.sources import SCHEMAS, Catalog, check_header, ingest, read_csv, schema_for, validate_schema
from lapsewise.sources.ingest import ingest_table
from lapsewise.sources.manifest import read_manifest, update_manifest

RECHARGE = schema_for("recharge").names
GOOD = "a,20240101,f,n,12.5,20240105 10:00:00,host,1.0,13.5"


@pytest.fixture
def catalog(spark, tmp_path):
    config = {
        "keys": ["recharge"],
        "months": ["01", "02", "03"],
        "paths.csv": "ignored",
        "section": {
            "paths": {
                "csv": {k: f"csv/{k}_{{month}}.csv" for k in SCHEMAS},
                "parquet": {k: f"parquet/{k}_{{month}}.parquet" for k in SCHEMAS},
            }
        },
    }
    (tmp_path / "csv").mkdir()
    return Catalog.from_config(spark, config, str(tmp_path))


def _put(catalog, key, month, lines, header=None):
    header = header or schema_for(key).names
    with open(catalog.csv_path(key, month), "w") as file:
        file.write("\n".join([",".join(header), *lines]) + "\n")


def test_layouts():
    widths = {k: len(s) for k, s in SCHEMAS.items()}
    assert widths == {
        "loan_assign": 7, "loan_fee": 8, "loan_recovery": 8, "package": 9, "recharge": 9, "user": 11,
    }
    assert {f.name for f in SCHEMAS["recharge"] if f.dataType.simpleString() == "double"} == {
        "recharge_value_amt", "account_balance_before_amt", "account_balance_after_amt",
    }
    with pytest.raises(KeyError):
        schema_for("fees")


def test_months_stay_text_and_bad_rows_are_set_aside(catalog):
    _put(catalog, "recharge", "01", [GOOD, GOOD.replace("12.5", "oops"), "z,1", GOOD + ",more"])
    _put(catalog, "recharge", "02", [GOOD])
    _put(catalog, "recharge", "03", [])
    counts = ingest(catalog)
    assert [tuple(c) for c in counts] == [
        ("recharge", "01", 1, 3), ("recharge", "02", 1, 0), ("recharge", "03", 0, 0),
    ]
    rows = catalog.read("recharge").orderBy("month").collect()
    assert [(r["month"], r["period"], r["recharge_value_amt"]) for r in rows] == [
        ("01", 0, 12.5), ("02", 1, 12.5),
    ]
    assert catalog.read("recharge", "01").columns == RECHARGE
    bad = {tuple(r) for r in catalog.quarantine("recharge").collect()}
    assert bad == {("01", GOOD.replace("12.5", "oops")), ("01", "z,1"), ("01", GOOD + ",more")}


def test_swapped_header_is_refused(catalog):
    swapped = [RECHARGE[1], RECHARGE[0], *RECHARGE[2:]]
    _put(catalog, "recharge", "01", [GOOD], swapped)
    with pytest.raises(ValueError, match="header mismatch"):
        ingest(catalog)


def test_every_file_of_a_folder_is_checked(catalog, tmp_path):
    folder = tmp_path / "csv" / "recharge_01.csv"
    folder.mkdir()
    swapped = [RECHARGE[1], RECHARGE[0], *RECHARGE[2:]]
    (folder / "a.csv").write_text(",".join(RECHARGE) + "\n" + GOOD + "\n")
    (folder / "b.csv").write_text(",".join(swapped) + "\n" + GOOD + "\n")
    with pytest.raises(Exception, match="header"):
        ingest(catalog, months=["01"])


def test_headers_may_have_other_names_that_are_known(catalog):
    header = [*RECHARGE[:-1], "account_balance_after_am"]
    _put(catalog, "recharge", "01", [GOOD], header)
    known = {"account_balance_after_am": "account_balance_after_amt"}
    assert read_csv(catalog, "recharge", "01", known).columns == [*RECHARGE, "_corrupt_record"]
    with pytest.raises(ValueError):
        check_header(header, schema_for("recharge"))
    assert ingest(catalog, months=["01"], aliases={"recharge": known})[0].rows == 1


def test_reingest_replaces_one_month_only(catalog):
    for month in catalog.months:
        _put(catalog, "recharge", month, [GOOD, "short"])
    ingest(catalog)
    _put(catalog, "recharge", "02", [GOOD, GOOD, GOOD])
    ingest(catalog, months=["02"])
    by_month = {r["month"]: r["count"] for r in catalog.read("recharge").groupBy("month").count().collect()}
    assert by_month == {"01": 1, "02": 3, "03": 1}
    left = catalog.quarantine("recharge").groupBy("month").count().collect()
    assert {r["month"] for r in left} == {"01", "03"}  # no stale bad rows of month 02


def test_failure_keeps_what_was_stored(catalog):
    _put(catalog, "recharge", "01", [GOOD])
    with pytest.raises(Exception):
        ingest(catalog)  # month 02 has no file
    assert catalog.read("recharge", "01").count() == 1


def test_parquet_of_other_writers_is_read(spark, catalog):
    rows = spark.createDataFrame([("a", *[None] * 8)], schema_for("recharge"))
    rows.write.parquet(catalog.parquet_path("recharge", "01"))
    assert catalog.read("recharge", ["01"]).first()["bib_id"] == "a"


def test_lookups(catalog):
    assert catalog.csv_path("user", "02").endswith("csv/user_02.csv")
    assert catalog.month_after("01") == "02"
    for call in (lambda: catalog.month_after("03"), lambda: catalog.read("user", "04")):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(KeyError):
        catalog.parquet_path("fees", "01")
    with pytest.raises(KeyError):
        Catalog.from_config(catalog.spark, {"keys": [], "months": []})


def test_schema_check_ignores_order(spark):
    expected = schema_for("loan_assign")
    df = spark.createDataFrame([], expected)
    validate_schema(df.select(*reversed(df.columns)), expected)
    with pytest.raises(ValueError, match="expected .* actual"):
        validate_schema(df.withColumn("loan_amount", df.loan_amount.cast("string")), expected)
    with pytest.raises(ValueError):
        validate_schema(df.drop("fake_id"), expected)


def test_label_and_training_table_from_storage(catalog):
    package = "{},d,f,n,code,{},name,{},{}"
    _put(catalog, "package", "01", [package.format("a", 10, "20240101 00:00:00", "20240108 00:00:00")])
    _put(catalog, "package", "02", [package.format("a", 10, "20240205 00:00:00", "junk")])
    _put(catalog, "package", "03", [])
    _put(catalog, "recharge", "01", [GOOD.replace("a,", "b,", 1)])
    _put(catalog, "recharge", "02", [])
    _put(catalog, "recharge", "03", [GOOD.replace("20240105", "20240301")])
    for month in catalog.months:
        _put(catalog, "user", month, ["a,f,n,pre,m,20200101,20000101,ok,5.5,base,site"])
    for key in ("loan_assign", "loan_recovery"):
        _put(catalog, key, "01", [",".join(["a", "d", "f", "n", "l1", "100", *(["40"] if key == "loan_recovery" else []), "20240101 00:00:00"])])
    ingest(catalog, ["package", "recharge", "user"])
    ingest(catalog, ["loan_assign", "loan_recovery"], ["01"])
    label = plans.generate_churn_label(catalog, "01")
    assert {tuple(r) for r in label.collect()} == {("a", 1), ("b", 1)}  # a: 35 days, b: never
    every = plans.generate_all_churn_labels(catalog)
    assert {tuple(r) for r in every.collect()} == {("a", 0, 1), ("b", 0, 1), ("a", 1, 0)}
    wide = plans.generate_dataset(catalog, "01", label, as_of=dt.date(2024, 2, 1), include_loans=True)
    rows = {r["bib_id"]: r for r in wide.collect()}
    assert rows["a"]["MedianPackageDuration"] == 7.0 and rows["a"]["MedianRecoveryLoanAmount"] == 100.0
    assert rows["b"]["CountRecharge"] == 1 and rows["b"]["gender_v"] is None
    # The loan tables are not even looked for when they are not wanted.
    assert len(plans.generate_dataset(catalog, "02", label).columns) == 16


# --- partitioned tables ----------------------------------------------------------------------


def _partitioned(spark, base, months=("01", "02", "03")):
    return Catalog(
        spark,
        ["recharge"],
        list(months),
        csv_paths={k: f"csv/{k}_{{month}}.csv" for k in SCHEMAS},
        parquet_paths={k: f"parquet/{k}/month={{month}}" for k in SCHEMAS},
        base=str(base),
    )


@pytest.fixture
def table(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    return _partitioned(spark, tmp_path)


def _months(catalog):
    return {r["month"]: r["count"] for r in catalog.read("recharge").groupBy("month").count().collect()}


def test_partitioned_months_stay_text(table):
    _put(table, "recharge", "01", [GOOD, "z,1"])
    _put(table, "recharge", "02", [GOOD, GOOD])
    _put(table, "recharge", "03", [])
    counts = ingest(table)
    assert [tuple(c) for c in counts] == [("recharge", "01", 1, 1), ("recharge", "02", 2, 0), ("recharge", "03", 0, 0)]
    assert {(r["month"], r["period"]) for r in table.read("recharge").collect()} == {("01", 0), ("02", 1)}
    assert table.read("recharge", "01").columns == RECHARGE and table.read("recharge", "03").count() == 0
    assert [tuple(r) for r in table.quarantine("recharge").collect()] == [("01", "z,1")]


def test_a_month_that_became_empty_is_cleared(table, tmp_path):
    for month in table.months:
        _put(table, "recharge", month, [GOOD] * 3)
    ingest(table)
    _put(table, "recharge", "02", [])
    _put(table, "recharge", "03", [GOOD])
    ingest(table, months=["02", "03"])
    assert _months(table) == {"01": 3, "03": 1}
    assert not (tmp_path / "parquet/recharge/month=02").exists()


def test_an_empty_month_does_not_come_back_from_its_folder(spark, table, tmp_path):
    """What the manifest notes counts, should the folder have stayed after a crash."""
    for month in table.months:
        _put(table, "recharge", month, [GOOD])
    ingest(table)
    update_manifest(spark, str(tmp_path / "parquet/recharge"), {"02": {"rows": 0, "quarantined": 0}})
    assert (tmp_path / "parquet/recharge/month=02").exists()
    assert _months(table) == {"01": 1, "03": 1}
    assert read_manifest(spark, str(tmp_path / "parquet/recharge"))["01"] == {"rows": 1, "quarantined": 0}


def test_one_write_for_all_months(spark, table):
    for month in table.months:
        _put(table, "recharge", month, [GOOD])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sweep", "sweep")
    try:
        ingest_table(table, "recharge", table.months)
        jobs = tracker.getJobIdsForGroup("sweep")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 4  # a header for each month, and the write


def test_nothing_is_stored_if_one_extract_is_missing(table, tmp_path):
    _put(table, "recharge", "01", [GOOD])
    with pytest.raises(Exception, match="recharge_02"):
        ingest(table)
    assert not (tmp_path / "parquet/recharge/month=01").exists()


@pytest.mark.parametrize("name", ["with space", "a=b", "per%cent", "[x]"])
def test_months_and_folders_with_odd_names(spark, tmp_path, name):
    base = tmp_path / "some folder"
    (base / "csv").mkdir(parents=True)
    catalog = _partitioned(spark, base, [name, "02"])
    written = catalog
    for i, month in enumerate(catalog.months):
        _put(written, "recharge", month, [GOOD] * (i + 1))
    # Spark reads brackets in an extract's path as a pattern; the stored table has no such trouble.
    if name == "[x]":
        catalog = dataclasses.replace(catalog, csv_paths={"recharge": "csv/recharge_?x?.csv"}, months=[name])
    ingest(catalog)
    assert _months(catalog)[name] == 1
    assert catalog.read("recharge", name).count() == 1
    _put(written, "recharge", name, [])
    ingest(catalog, months=[name])
    assert name not in _months(catalog)


@pytest.mark.parametrize("parquet", ["parquet/{}/month={{month}}", "parquet/{}_{{month}}.parquet"])
@pytest.mark.parametrize("base", [".", "./w", "../{}/w", "w/../w"])
def test_relative_folders(spark, tmp_path, monkeypatch, parquet, base):
    """As the reference is used: from a folder beside the data."""
    # Spark resolves such a path against the folder that its JVM was started in.
    here = os.path.relpath(tmp_path, spark._jvm.java.lang.System.getProperty("user.dir"))
    folder = os.path.join(here, base.format(tmp_path.name))
    catalog = Catalog(
        spark, ["recharge"], ["01", "02"], {"recharge": "csv/{month}.csv"}, {"recharge": parquet.format("recharge")}, folder
    )
    rows = spark.createDataFrame([("a", *[None] * 8)], schema_for("recharge"))
    for i, month in enumerate(catalog.months):
        rows.unionAll(rows.limit(i)).write.parquet(catalog.parquet_path("recharge", month))
    found = {(r["month"], r["period"], r["count"]) for r in catalog.read("recharge").groupBy("month", "period").count().collect()}
    assert found == {("01", 0, 1), ("02", 1, 2)}


def test_months_are_pruned_by_the_partition(table):
    for month in table.months:
        _put(table, "recharge", month, [GOOD])
    ingest(table)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        table.read("recharge", ["02"]).explain("formatted")
    filters = re.search(r"PartitionFilters: \[(.*)\]", out.getvalue())[1]
    assert "month" in filters and "02" in filters and "CASE" not in out.getvalue()
