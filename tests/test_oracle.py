"""Every registered query against its SQL on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from lapsewise.workload.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: [(v is None, type(v).__name__, v if v is not None else 0) for v in r],
    )


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9) or a != a and b != b
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(got.columns) == sorted(columns)
    rows = got.collect()
    assert len(rows) == len(want)
    assert rows, "a query without rows proves nothing"
    for mine, theirs in zip(_sorted(rows, got.columns), _sorted(want, columns)):
        assert all(_same(a, b) for a, b in zip(mine, theirs)), (mine, theirs)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 15
