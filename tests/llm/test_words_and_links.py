import random

import numpy as np
from pyspark.sql import functions as F

from lapsewise.llm import words
from lapsewise.llm.components import components, link


def test_words_are_told_apart_as_by_splitting():
    texts = ["A b\tc\x0bD  é", None, "", " \n", "a B C d É", "a b c d É"]
    hashes, first = words.word_hashes(texts)
    assert np.diff(first).tolist() == [5, 0, 0, 0, 5, 5]
    assert hashes[:4].tolist() == hashes[5:9].tolist()
    assert hashes[4] != hashes[9] and hashes[9] == hashes[14]  # only A-Z are lowered


def test_shingles_equal_sets_of_tuples():
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randrange(40))) for _ in range(60)]
    for text, got in zip(texts, words.shingle_lists(texts), strict=True):
        w = text.split()
        want = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        assert len(np.unique(got)) == len(want)


def test_batches_take_every_text_once():
    texts = ["x" * n for n in (0, 5, 100, 3, 0, 50)]
    assert [t for s in words.batches(texts, 20) for t in texts[s]] == texts


def _brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_components_equal_union_find(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(5, 5), (2000, 2001), (2001, 2000), (2000, 2001)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    want = {k: v for k, v in _brute([e for e in edges if e[0] != e[1]]).items()}
    assert {r.id: r.component for r in got.collect()} == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_link_loses_no_link_between_members(spark):
    """Ids share keys at random; those whose difference is at most 3 are linked."""
    draw = random.Random(2)
    rows = [(key, i, float(draw.randrange(3))) for i in range(200) for key in draw.sample(range(6), 2)]
    shared = {}
    for key, i, _ in rows:
        shared.setdefault(key, set()).add(i)
    edges = [(a, b) for ids in shared.values() for a in ids for b in ids if a < b <= a + 3]
    members = spark.createDataFrame(rows, "key bigint, id bigint, rank double")
    tried = []

    def confirm(pairs):
        tried.append(pairs)
        return pairs.where(F.col("b") - F.col("a") <= 3)

    got = {r.id: r.component for r in link(members, confirm).collect()}
    assert got == _brute(edges)


def test_ids_that_hang_together_cost_a_pair_each(spark):
    """Every two neighbours share a key of their own with others in between; one leader is enough for each id."""
    rows = [(key, i, 0.0) for key in range(0, 100, 2) for i in range(key, min(key + 40, 100))]
    members = spark.createDataFrame(rows, "key bigint, id bigint, rank double")
    counts = []

    def confirm(pairs):
        counts.append(pairs.count())
        return pairs.where("true")

    got = {r.id: r.component for r in link(members, confirm).collect()}
    assert got == dict.fromkeys(range(100), 0)
    assert sum(counts) < 2 * 100
