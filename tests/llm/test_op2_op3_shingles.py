import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import decontamination, jaccard, words


def shingles(text, width=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def _edited(draw, text, changes):
    w = text.split()
    for _ in range(changes):
        w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
    return " ".join(w)


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {(i, len(x), find(i)) for i, x in sets}


def test_components_equal_brute_force(make, prose, odd):
    """Chains of near copies, a large group of them, exact copies and shared passages."""
    draw = random.Random(3)
    rows, passage = list(odd), prose(99, 60)
    for i in range(40):
        text = prose(i, draw.randrange(20, 120), 3000)
        rows.append((100 + 10 * i, text))
        for k in range(1, draw.randrange(4)):
            rows.append((100 + 10 * i + k, _edited(draw, text, k)))
        if i % 3 == 0:
            rows.append((100 + 10 * i + 9, f"{prose(500 + i, 30)} {passage} {prose(600 + i, 30)}"))
    base = prose(7, 80, 4000)
    rows += [(2000 + k, _edited(draw, base, draw.randrange(1, 3))) for k in range(60)]
    rows += [(3000 + k, base) for k in range(20)]
    got = jaccard.jaccard_components(make(rows))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)
    assert got.count() == len(rows)


def test_the_threshold_itself_links(make):
    a = [f"a{i}" for i in range(22)]  # 18 shingles
    b = a[:20] + ["x", "y"]  # 16 shared of 20
    c = a[:19] + ["u", "v", "w"]  # 15 shared of 21
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(make(rows)).collect()}
    assert {(i, got[i]) for i in got} == {(i, c) for i, _, c in brute_components(rows)}
    assert got[2] == 1


def test_one_document_of_each_group_stays(make, prose):
    text = prose(1, 50)
    rows = [(9, text), (3, text), (5, text + " more"), (4, prose(2, 50)), (None, text), (6, None), (7, "")]
    kept = jaccard.keep_one(make(rows))
    assert kept.columns == make(rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "6", "7", "None"]


@pytest.mark.parametrize("shingles_each", [10**6, 17, 3])
def test_the_number_of_fragments_changes_nothing(make, prose, shingles_each, monkeypatch):
    rows = [(i, prose(i % 7, 40 + i % 3)) for i in range(30)]
    monkeypatch.setattr(jaccard, "FRAGMENT_SHINGLES", shingles_each)
    got = jaccard.jaccard_components(make(rows)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_no_documents_no_components(make):
    assert jaccard.jaccard_components(make([])).count() == 0


def _contained(docs, items, width=5):
    out = set()
    for i, t in docs:
        for j, x in items:
            n = min(width, len((x or "").split()))
            want = shingles(x) if n else set()
            have = shingles(t, n) if n and len((t or "").split()) >= n else set()
            if want and 10 * len(want & have) >= 8 * len(want):
                out.add((i, j, len(want), len(want & have)))
    return out


def test_matches_equal_brute_force(spark, make, prose, odd):
    draw = random.Random(8)
    items = [(k, prose(k, draw.choice([1, 3, 5, 6, 20, 60, 300]), 4000)) for k in range(40)]
    items += [(77, None), (78, ""), (79, " \n"), (3, items[3][1]), (80, items[10][1])]
    docs = list(odd)
    for i in range(60):
        inside = draw.choice(items[:40])[1]
        if len(inside.split()) > 10:
            inside = _edited(draw, inside, draw.randrange(3)).upper()
        docs.append((100 + i, f"{prose(900 + i, 200, 4000)} {inside}\n{prose(990 + i, draw.randrange(300), 4000)}"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.find_contamination(make(docs), bench).collect()
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got} == _contained(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    kept = decontamination.drop_contaminated(make(docs), bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {r.doc_id for r in got}


def test_items_in_several_blocks(spark, make, prose, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_SHINGLES", 8)
    items = [(k, prose(k, 12, 4000)) for k in range(12)]
    docs = [(k, f"{prose(50 + k, 20)} {t}") for k, t in items]
    got = decontamination.find_contamination(make(docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k, k) for k in range(12)}


def test_nothing_on_either_side(spark, make):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.find_contamination(make([(1, "a b c")]), none).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontamination.find_contamination(make([]), one).where(F.col("containment") > 0).count() == 0
    assert decontamination.drop_contaminated(make([]), one).count() == 0


def test_rows_do_not_grow_with_the_number_of_fragments(make, prose):
    """A document comes back as one row, and its shared shingles as another, from any number of fragments."""
    docs = make([(i, prose(i // 3, 200)) for i in range(90)] + [(90 + i, f"{prose(i, 190)} end{i}") for i in range(30)])
    parts = {}
    for fragments in (2, 150):
        rows = jaccard.shared_parts(jaccard.split_sets(docs, fragments), 80).collect()
        assert len(rows) == 120 + 60  # classes: 30 texts, each with one near copy
        parts[fragments] = {(r["class"], r.n, len(r.hashes) // 5) for r in rows if r.fragments is not None}
    assert parts[2] == parts[150]


def test_a_family_is_not_compared_in_full(make, prose, monkeypatch):
    """Copies of one text, most with too many edits to link with each other, share keys; marks tell nearly all pairs apart."""
    draw = random.Random(5)
    base = prose(11, 150, 4000)
    rows = [(i, _edited(draw, base, draw.choice((1, 3, 5, 6)))) for i in range(200)]
    rows += [(500 + i, _edited(draw, t, 1)) for i, t in rows[:40]]
    compared, real = [], jaccard._overlaps

    def spy(pairs, *rest):
        compared.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(jaccard, "_overlaps", spy)
    got = jaccard.jaccard_components(make(rows))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)
    assert sum(compared) < 6 * len(rows)


def test_few_texts_are_strings_at_a_time(monkeypatch):
    """Sets travel together by size of text, and come to the same ids and sets as one document after the other."""
    texts = [None, "", *(f"w{i} " * (i % 5) + "of one document" for i in range(1500))]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    asked = []
    lists = words.shingle_lists
    monkeypatch.setattr(words, "shingle_lists", lambda t, width: asked.append(len(t)) or lists(t, width))
    monkeypatch.setattr(jaccard, "_SPLIT_BYTES", 5000)
    got = list(jaccard._sets(batch, 5))
    assert max(asked) <= jaccard._TEXTS and len(got) > 2
    assert [i for ids, _ in got for i in ids] == list(range(len(texts)))
    want = [np.unique(s) for s in lists(texts, 5)]
    assert all(np.array_equal(a, b) for a, b in zip((s for _, sets in got for s in sets), want, strict=True))


def test_repeats_are_counted_in_place():
    for n, kinds in ((0, 1), (1, 1), (1000, 50), (1000, 10**6)):
        hashes = np.random.default_rng(n).integers(0, kinds, n, dtype=np.uint64)
        _, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        assert np.array_equal(jaccard._repeats(hashes), counts[which])
