"""Periodic runs against trying every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lapsewise.llm import periodic, queries


def brute_runs(words, least=6, folds=4):
    """Every stretch that keeps a period, its period shown to be the smallest by trying all."""
    n, found = len(words), set()
    for q in range(1, n):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            stretch = words[start : start + length]
            if length >= max(least, folds * q) and not any(
                all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)
            ):
                found.add((start, length, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    """What the query returns, step by step over lists."""
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def draw_words(draw):
    n, kinds = draw.randrange(90), draw.choice([1, 2, 2, 3, 5, 20])
    words = [f"w{draw.randrange(kinds)}" for _ in range(n)]
    if n and draw.random() < 0.5:
        a = draw.randrange(n)
        p = 1 + draw.randrange(max(1, (n - a) // 3))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    if n > 30 and draw.random() < 0.3:
        at = draw.randrange(n - 20)
        words[at + 10 : at + 20] = words[at : at + 10]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    hits = 0
    for _ in range(400):
        words = draw_words(draw)
        want = brute_runs(words)
        hits += len(want)
        assert periodic.periodic_runs(periodic.numbered([w.encode() for w in words])) == want
    assert hits > 50


def test_other_bounds_equal_brute_force():
    draw = random.Random(9)
    for least, folds in ((2, 3), (6, 3), (12, 5), (3, 7)):
        for _ in range(150):
            words = draw_words(draw)
            ids = periodic.numbered([w.encode() for w in words])
            assert periodic.periodic_runs(ids, least, folds) == brute_runs(words, least, folds)
    with pytest.raises(ValueError, match="three folds"):
        periodic.periodic_runs(np.zeros(9, np.int64), 6, 2)


def test_suffix_order_and_common_prefixes():
    draw = random.Random(3)
    for _ in range(200):
        ids = np.array([draw.randrange(3) for _ in range(draw.randrange(1, 60))])
        order = periodic.suffix_order(ids)
        want = sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
        assert order.tolist() == want
        heights = [0]
        for a, b in zip(want, want[1:]):
            pairs = zip(ids[a:].tolist(), ids[b:].tolist())
            heights.append(next((k for k, (x, y) in enumerate(pairs) if x != y), len(ids) - max(a, b)))
        assert periodic.common_prefixes(ids, order).tolist() == heights


def test_long_texts_of_one_word_and_of_one_period():
    assert periodic.periodic_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    rest = np.random.default_rng(0).integers(0, 9, 3000)
    ids = rest[np.arange(100_000) % 3000]
    assert (0, 100_000, 3000) in periodic.periodic_runs(ids)


def test_query_equals_brute_force(spark, make, odd, tmp_path):
    draw = random.Random(5)
    rows = [(i, " \t".join(draw_words(draw))) for i in range(100, 260)]
    rows += [r for r in odd if r[0] != 5 and r[0] != 6] + [(None, "a b " * 9), (None, None), (-1, "c " * 7), (-1, "c " * 7)]
    rows += [(7777, "A a A a A a A a A a"), (7778, "x\x0by\x1cz\xa0 " * 8)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    key = [f"{r!r}" for r in sorted(map(tuple, got.collect()), key=repr)]
    assert key == sorted(f"{brute_row(i, t)!r}" for i, t in rows)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2


def test_operator_returns_runs_and_text(make):
    docs = make([(1, "go go go go go go stop"), (2, None), (3, "")])
    rows = {r.doc_id: r for r in periodic.mark_runs(docs).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 6, 1)]
    assert (rows[1].collapsed, rows[1].n_words) == ("go stop", 7)
    assert [(r.runs, r.n_words, r.collapsed) for i, r in rows.items() if i > 1] == [([], 0, "")] * 2


def test_empty_table_and_clashing_names(spark, make):
    docs = make([(1, "a b c")]).selectExpr("doc_id", "text", "'x' AS runs", "1 AS collapsed", "2 AS n_words")
    assert [r.collapsed for r in periodic.mark_runs(docs).collect()] == ["a b c"]
    assert periodic.mark_runs(docs.where("false")).collect() == []
