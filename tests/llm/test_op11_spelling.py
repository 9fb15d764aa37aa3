"""Spelling variants against comparing all words with all others."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lapsewise.llm import queries, spelling
from lapsewise.llm.sql import ORACLE_SQL

CAPITALS = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    """Edit distance one by trying every edit."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CAPITALS)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_groups(words, ratio=5):
    form, out = {}, []
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = (len(others), best if best is not None and words[best] >= ratio * n else None)
    for w, n in words.items():
        root = w
        while form[root][1]:
            root = form[root][1]
        n_near, best = form[w]
        out.append((w, best, root, n, n_near, words.get(best)))
    return sorted(out, key=lambda r: r[0])


def draw_vocabulary(seed, size, letters="abcdeéñÿ"):
    """Words with many neighbours, anagrams and chains of ever more frequent forms."""
    draw = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(draw.choice(letters) for _ in range(draw.randrange(6, 10)))
        for _ in range(draw.randrange(1, 5)):
            words[w] = draw.choice([5, 5, 5, 6, 25, 26, 130, 700])
            k, c = draw.randrange(len(w)), draw.choice(letters)
            w = draw.choice([w[:k] + c + w[k + 1 :], w[:k] + w[k + 1 :], w[:k] + c + w[k:]])
            w = w.ljust(6, "a")
    return words


def as_rows(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("leaf, letters", [(1 << 12, "abcdeéñÿ"), (50, "abcdeéñÿ"), (40, "ab"), (60, "абвг字漢ab")])
def test_groups_equal_brute_force(spark, monkeypatch, leaf, letters):
    """Also where the upper trees are cut into many leaves, in several rounds and by hash."""
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 300)
    words = draw_vocabulary(len(letters) + leaf, 700 if len(letters) > 2 else 300, letters)
    got = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    want = brute_groups(words)
    assert as_rows(got) == want
    assert sum(r[1] is not None for r in want) > 20
    assert sum(r[2] != (r[1] or r[0]) for r in want) > 3  # chains of two forms or more


def test_leaves_hold_no_more_than_they_may(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF_WORDS", 50)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 200)
    anagrams = {"".join(p) for p in _orders("aabbccd", 400)}
    rare = {"x" * k + c for k in range(20, 60) for c in "abc"}  # lengths that need no tree, more words in all than a leaf holds
    words = spark.createDataFrame([(w, 5) for w in anagrams | rare | set(draw_vocabulary(3, 900))], "word string, n bigint")
    trees = spelling._plant(words)
    sizes = spelling._homes(words, trees).groupBy("leaf").count().where("leaf >= 0").collect()
    assert max(n for _, n in sizes) <= 50
    assert trees.by_hash


def _orders(letters, n):
    draw = random.Random(1)
    for _ in range(n):
        yield draw.sample(letters, len(letters))


def test_one_letter_apart():
    letters = spelling._letters
    pairs = [("grey", "gray"), ("abc", "abc"), ("abc", "acb"), ("aaaa", "aaab"), ("字ab", "漢ab")]
    assert [bool(spelling._replaced(letters([a]), letters([b]))[0]) for a, b in pairs] == [near(a, b) for a, b in pairs]
    pairs = [("color", "colour"), ("aaa", "aaaa"), ("abc", "xabc"), ("abc", "abcx"), ("abc", "acbb"), ("abcd", "abxyd")]
    assert [bool(spelling._inserted(letters([a]), letters([b]))[0]) for a, b in pairs] == [near(a, b) for a, b in pairs]


def test_letter_counts_move_by_two_at_most():
    counts = spelling.letter_counts(["colour", "color", "colöur", "", "字x"])
    assert np.abs(counts[0] - counts[1]).sum() == 1
    assert np.abs(counts[0] - counts[2]).sum() == 2
    assert counts[3].sum() == 0 and counts[4].sum() == 2


def test_query_equals_brute_force(spark, make, odd, tmp_path):
    draw = random.Random(2)
    vocabulary = list(draw_vocabulary(8, 150)) + ["Straße", "ÀÉÎÕÜØ", "àéîõüø"]
    weights = [1.0 / (1 + i % 40) for i in range(len(vocabulary))]
    rows = []
    for i in range(120):
        picked = draw.choices(vocabulary, weights, k=150)
        rows.append((i, draw.choice([" ", "-", "\n", "1", "字"]).join(w.upper() if draw.random() < 0.1 else w for w in picked)))
    rows += odd + [(None, "without anybody " * 30), (None, None), (-7, "withouth anybody " * 3)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_spelling_variants(spark, str(tmp_path))
    want = brute_groups(brute_words(rows))
    assert as_rows(got) == want
    assert any(r[1] for r in want) and len(want) > 100
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_given_documents_equal_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({ORACLE_SQL['op11_spelling_variants']})")
    assert as_rows(queries.op11_spelling_variants(spark, path)) == sorted(con.fetchall())


def test_no_words(spark, make):
    assert spelling.group_variants(spelling.count_words(make([(1, None), (2, ""), (3, "rare")]))).collect() == []
    assert spelling.group_variants(spelling.count_words(make([]))).collect() == []


def test_clashing_names(make):
    docs = make([(1, "letter letter letter letter letter")]).selectExpr("doc_id", "text", "'x' AS run", "1 AS word", "2 AS n")
    assert [tuple(r) for r in spelling.count_words(docs).collect()] == [("letter", 5)]
