import math
import random

import pytest
from pyspark.sql import functions as F

from lapsewise.llm.topk import top_k
from lapsewise.llm.urls import bloom_filter, filter_urls, possible_hits

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in rules:
        cut = rule.find("/") if "/" in rule else len(rule)
        h, p = rule[:cut], rule[cut:]
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), rule, verdict))
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://net/",
    "http://net",
    "http://NET?x=/",
    "https://a.b.Example.NET/en/x?y#z",
    "https://a.b.example.net/EN/x",
    "http://example.com/de/",
    "http://xexample.com/de/",
    "http://example.com/de",
    "http://.com/de/",
    "ftp://www.x.org/fr/1://2",
    "http://Ünet/ü/é",
    "http://a.net/\nb",
    "http://" + "a." * 3000 + "net/" + "x/" * 3000,
]


def test_urls_equal_brute_force(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate([*URLS, *URLS[5:9]])] + [(3, URLS[7], "x", "y")] * 3 + [(None, URLS[7], None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, key string")
    got = filter_urls(pages, spark.createDataFrame(RULES, "entry string, verdict string")).collect()
    want = [(i, *judge(u, RULES)) for i, u, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("blocks", [1, 4096])
def test_a_crowded_filter_changes_no_verdict(spark, blocks):
    draw = random.Random(5)
    rules = [(f"h{draw.randrange(40)}.net/p{draw.randrange(9)}/", draw.choice(["allow", "block"])) for _ in range(60)]
    rules = list({r: v for r, v in rules}.items())
    rows = [(i, f"http://{draw.choice(['', 'www.'])}h{draw.randrange(50)}.net/p{draw.randrange(12)}/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = filter_urls(pages, spark.createDataFrame(rules, "entry string, verdict string"), blocks=blocks)
    assert {tuple(r) for r in got.collect()} == {(i, *judge(u, rules)) for i, u in rows}


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "entry string, verdict string")
    assert filter_urls(none, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert [tuple(r) for r in filter_urls(one, rules.limit(0)).collect()] == [(1, "a.net", "/", None, "allow")]


def test_the_bloom_filter_loses_nothing(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    found = {r.key for r in possible_hits(rows, bloom_filter(keys, blocks=64), "key", 64).collect()}
    assert {f"k{i}" for i in range(500)} <= found and len(found) < 1500


def brute_top_k(rows, k, every):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, asked = [], set()
    for q, v in usable:
        if q % every or (q, tuple(v)) in asked:
            continue
        asked.add((q, tuple(v)))
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 3])
def test_top_k_equals_brute_force(spark, block):
    draw = random.Random(6)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 8) for i in range(30)]  # ties by the dozen
    rows += [(300, None), (301, [1.0, None] * 4), (302, [math.nan] * 8), (303, [math.inf] * 8), (304, []), (305, [1.0])]
    rows += [(None, [0.1] * 8), (310, [0.0] * 8), (310, [0.0] * 8), (-20, [-0.5] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, id string, score int")
    exact = [(i, None if v is None else [None if x is None else float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    for k in (1, 5, 40):
        got = top_k(df.repartition(5), F.col("vec_id") % 10 == 0, k, query_block=block)
        assert sorted(map(tuple, got.collect())) == brute_top_k(exact, k, 10)


def test_fewer_candidates_than_places(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 131072)]
    assert top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert top_k(df, F.col("vec_id") == 7).count() == 0
    assert top_k(df.limit(1), F.col("vec_id") == 0).count() == 0
