"""The mix against its SQL, its targets against filling by hand, and its curriculum against the schedules."""

import math
import random

import duckdb
import pytest

from lapsewise.llm import mixing, queries
from lapsewise.llm.sql import ORACLE_SQL

SCHEMA = "doc_id bigint, text string, source string, size string, place int, document string"


def texts(rows):
    return [(i, None if n is None else " \t".join(["w"] * n), s, "x", 1, "y") for i, n, s in rows]


def draw_rows(seed, n, sources):
    draw = random.Random(seed)
    sizes = [0, 1, 1, 2, 5, 30, 200, 900]
    return [(i, draw.choice(sizes), draw.choice(sources)) for i in range(n)]


def filled(sizes, weights, share=1.5, repeats=2):
    """Targets by raising the level a source at a time."""
    whole, open_, out = share * sum(sizes), set(range(len(sizes))), {}
    while open_:
        level = (whole - sum(out.values())) / sum(weights[i] for i in open_)
        over = {i for i in open_ if repeats * sizes[i] <= level * weights[i]}
        if not over:
            return [out.get(i, level * weights[i]) for i in range(len(sizes))]
        out |= {i: repeats * sizes[i] for i in over}
        open_ -= over
    return [out[i] for i in range(len(sizes))]


def _sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    cursor = con.execute(ORACLE_SQL["op12_mixing"])
    return [c[0] for c in cursor.description], cursor.fetchall()


@pytest.mark.parametrize(
    "seed, n, sources",
    [
        (1, 400, ["a", "b", "c", "d", "Z", "é", "\U0001f600", "￿", None]),
        (2, 300, ["hot"] * 8 + ["a", "b"]),
        (3, 40, [f"s{i}" for i in range(30)] + [None]),
        (4, 3, ["one"]),
    ],
)
def test_query_equals_its_sql(spark, tmp_path, seed, n, sources):
    rows = texts(draw_rows(seed, n, sources)) + [(None, "w w", "a", "x", 1, "y")] * 3 + [(5, None, None, "x", 1, "y")]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_mixing(spark, str(tmp_path))
    names, want = _sql(tmp_path)
    assert sorted(got.columns) == sorted(names)
    mine = [tuple(r[c] for c in names) for r in got.collect()]
    assert len(mine) == len(want)
    by = lambda r: tuple((v is None, v or 0) for v in r)
    for a, b in zip(sorted(mine, key=by), sorted(want, key=by)):
        assert a[:3] == b[:3] and a[4] == b[4] and math.isclose(a[3], b[3], rel_tol=1e-12), (a, b)


def test_given_documents_equal_sql(spark):
    path = "/root/testdata/sf0.001"
    got = queries.op12_mixing(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op12_mixing"]).fetchall()
    names = [c[0] for c in con.description]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = [draw.choice([0, 1, 10, 50, 1000, 10**9]) for _ in range(17)]
    names = sorted({f"{draw.choice('aZé')}{i}" for i in range(17)})
    rows = [(None if k == 16 else names[k], s) for k, s in enumerate(sizes)]
    draw.shuffle(rows)
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint").repartition(6), queries.SCHEDULES)
    found = sorted(got.collect(), key=lambda r: r.source_no)
    assert [r.source_no for r in found] == list(range(17))
    assert [r.source for r in found] == [*names[:16], None]
    weights = [[5.0, 2.0, 1.0][k % 3] for k in range(17)]
    want = filled([r.source_size for r in found], weights)
    assert [r.target for r in found] == pytest.approx(want, rel=1e-12)
    assert sum(want) == pytest.approx(1.5 * sum(sizes))


def test_mix_takes_whole_documents_near_the_targets(spark):
    rows = draw_rows(7, 3000, ["a", "a", "a", "b", "c", "d"])
    mix = mixing.mix(spark.createDataFrame(texts(rows), SCHEMA), queries.SCHEDULES)
    order = mix.order.collect()
    size = {i: n or 0 for i, n, _ in rows}
    source = {i: s for i, _, s in rows}
    times, words = {}, {}
    for r in order:
        assert r.size == size[r.doc_id] > 0
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        words[source[r.doc_id]] = words.get(source[r.doc_id], 0) + r.size
    assert max(times.values()) <= 2
    goals = {r.source: r.target for r in mix.plan.collect()}
    assert all(goals[s] - 30 < words[s] <= goals[s] for s in goals)  # short documents fill the gaps
    assert {r.doc_id: r.taken for r in mix.plan.collect() if r.taken} == times
    assert len({(r.source_no, r.place) for r in mix.plan.collect()}) == 3000


def test_order_follows_the_schedules(spark):
    rows = [(i, 10, "abc"[i % 3]) for i in range(6000)]
    order = mixing.mix(spark.createDataFrame(texts(rows), SCHEMA), queries.SCHEDULES).order.collect()
    positions = [r.position for r in order]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    for number, schedule in enumerate(queries.SCHEDULES):
        mine = [r.position for r in order if r.source_no == number]
        for t in (0.1, 0.25, 0.5, 0.6, 0.9):
            share = sum(p <= t for p in mine) / len(mine)
            assert share == pytest.approx(schedule.demand(t) / schedule.integral, abs=0.002)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(texts(draw_rows(5, 500, ["a", "b", None])), SCHEMA)
    key = lambda mix: [(r.doc_id, r.copy, r.position) for r in mix.order.collect()]
    first = key(mixing.mix(docs.repartition(2), queries.SCHEDULES))
    assert first == key(mixing.mix(docs.repartition(9, "size", "doc_id"), queries.SCHEDULES))


def test_whole_documents_travel(spark):
    docs = spark.createDataFrame(texts([(1, 3, "a"), (2, None, None), (1, 3, "a")]), SCHEMA)
    mix = mixing.mix(docs, queries.SCHEDULES, whole=True)
    rows = mix.order.collect()
    assert {tuple(r.document) for r in rows} == {(1, "w \tw \tw", "a", "x", 1, "y")}
    assert mix.plan.count() == 3


def test_schedules():
    steps = mixing.Schedule(((0.0, 0.0), (0.5, 0.0), (1.0, 4.0)))
    assert steps.integral == 1.0 and steps.demand(0.5) == 0.0 and steps.demand(0.75) == 0.25
    for bad in (((0.0, 1.0),), ((0.0, 1.0), (0.5, 1.0)), ((0.0, 1.0), (1.0, -1.0)), ((0.0, 1.0), (0.0, 2.0), (1.0, 1.0))):
        with pytest.raises(ValueError):
            mixing.Schedule(bad)


def test_empty_table(spark):
    mix = mixing.mix(spark.createDataFrame([], SCHEMA), queries.SCHEDULES)
    assert mix.plan.collect() == [] and mix.order.collect() == []
    blank = mixing.mix(spark.createDataFrame(texts([(1, 0, "a"), (2, None, "a")]), SCHEMA), queries.SCHEDULES)
    assert [(r.size, r.taken, r.target) for r in blank.plan.collect()] == [(0, 0, 0.0)] * 2 and blank.order.collect() == []
