import random
import re
import unicodedata

import pytest

from lapsewise.llm import line_dedup


def normal(line):
    kept = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in line.lower())
    return " ".join("".join("0" if unicodedata.category(c) == "Nd" else c for c in kept).split())


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similar(a, b):
    return levenshtein(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)


def brute(docs):
    """Numbers of the repeated lines of each document, by edit similarity of all lines with all others alone."""
    lines = [(d, i, normal(x)) for d, t in sorted(docs) if t is not None for i, x in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[2]]
    norms = sorted({n for *_, n in lines})
    root = list(range(len(norms)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(norms):
        for j, b in enumerate(norms[:i]):
            if abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) + 1e-9 and find(i) != find(j) and similar(a, b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    seen, gone = set(), {}
    for d, i, n in lines:
        group = find(norms.index(n))
        if group in seen:
            gone.setdefault(d, []).append(i)
        seen.add(group)
    return gone


def _line(draw, n):
    return " ".join(f"w{draw.randrange(300)}{draw.choice('abcdef')}" for _ in range(n))


def test_repeated_lines_are_those_of_brute_force(make):
    draw = random.Random(4)
    pool = [_line(draw, draw.randrange(2, 20)) for _ in range(25)]
    docs = []
    for d in range(28):
        lines = []
        for _ in range(draw.randrange(1, 6)):
            line = draw.choice(pool) if draw.random() < 0.7 else _line(draw, 12)
            words = line.split()
            if draw.random() < 0.6:
                words[draw.randrange(len(words))] = f"w{draw.randrange(9)}z"
            lines.append(draw.choice([" ", "", "- "]) + " ".join(words).upper() + draw.choice(["", "!", " ..."]))
        docs.append((d, "\n".join(lines)))
    near = brute(docs)
    exact = {(d, i) for d, lines in near.items() for i in lines}
    assert len(exact) > 30
    got = {(r.doc_id, r.line) for r in line_dedup.repeated_lines(make(docs)).collect()}
    # The search may miss a pair (the README names its recall), but nothing else goes.
    assert got <= exact and len(got) >= 0.9 * len(exact)


def test_odd_rows(make, odd):
    docs = make([*odd, (20, "a line of more than five words\n\nshort one\na line of more than five words!")])
    marked = {r.doc_id: r for r in line_dedup.mark_repeats(docs).collect()}
    assert marked[20].removed == [3] and marked[20].left == "a line of more than five words\n\nshort one"
    assert marked[5].removed is None and marked[6].removed == [0]
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 7, 8, 20}  # 6 is a copy of 5
    assert rows[1].text is None and rows[2].text == "" and rows[20].n_chars == len(rows[20].text)
    assert kept.where("doc_id = 4").count() == 2  # rows of one document


def test_no_documents(make):
    assert line_dedup.dedup_lines(make([])).count() == 0


@pytest.mark.parametrize("n_words", [12, 25, 60])
def test_near_pairs_come_together(make, n_words):
    """Of lines with one word changed that leaves them similar, nine in ten at least are found, and no other line goes."""
    draw = random.Random(n_words)
    docs, want = [], set()
    for k in range(60):
        one = ["".join(draw.choices("abcdefghiklmnoprst", k=draw.randrange(2, 9))) for _ in range(n_words)]
        other = list(one)
        other[draw.randrange(n_words)] = "".join(draw.choices("abcdefghiklmnoprst", k=5))
        docs += [(2 * k, " ".join(one)), (2 * k + 1, " ".join(other))]
        if similar(normal(docs[-2][1]), normal(docs[-1][1])):
            want.add((2 * k + 1, 0))
    got = {(r.doc_id, r.line) for r in line_dedup.repeated_lines(make(docs)).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 50


def test_normal_form_equals_brute_force(spark, make):
    lines = ["Ab-1²٣ ß İ  _x", "", "!!", "a\tb", "É́ 12.5%"]
    df = spark.createDataFrame([(x,) for x in lines], "raw string")
    got = [r[0] for r in df.select(line_dedup.normal_form(df.raw)).collect()]
    assert [re.sub("̇", "", g) for g in got] == [re.sub(" ̇?", " ", normal(x)).replace("̇", "") for x in lines]


def test_a_fragment_of_keys_stays_small():
    """What one task sorts has some 20 MB, whatever the number of lines."""
    for lines in (0, 1000, 1_800_000, 100_000_000):
        n = line_dedup._fragments(lines)
        assert n >= 8
        assert lines * 20 / n * line_dedup._ENTRY.itemsize < 20e6


def test_a_fragment_of_keyed_lines_stays_small():
    """Nor has a task more of them where each key travels with all keys of its line."""
    for members in (0, 1000, 2_500_000, 150_000_000):
        n = line_dedup._keyed_fragments(members)
        assert n >= 8
        assert members / n * (line_dedup._ENTRY.itemsize + 8 * line_dedup._BANDS) < 4e6
