"""Edit distances of many pairs against the plain recurrence."""

import random

import numpy as np
from test_op7_line_dedup import levenshtein

from lapsewise.llm import edits


def test_pairs_within_so_many_edits_are_those_of_the_recurrence():
    draw = random.Random(3)
    lines = []
    for _ in range(60):
        one = "".join(draw.choices("abc漢é ", k=draw.choice([1, 2, 30, 63, 64, 65, 130])))
        other = list(one)
        for _ in range(draw.randrange(len(one) // 4 + 2)):
            at = draw.randrange(len(other))
            other[at] = draw.choice(["", "z", "ab", other[at]]) or ("q" if len(other) == 1 else "")
        lines += [one, "".join(other)]
    a = np.array([*range(0, 120, 2), *(draw.randrange(120) for _ in range(200))])
    b = np.array([*range(1, 120, 2), *(draw.randrange(120) for _ in range(200))])
    want = np.array([levenshtein(lines[i], lines[j]) for i, j in zip(a, b, strict=True)])
    made = edits.Lines(lines)
    for most in (want, np.maximum(want - 1, 0), np.full(len(a), 12)):
        assert (edits.within(made, a, b, most) == (want <= most)).all()


def test_long_copies_with_few_edits_need_no_bit_vectors():
    """The work for copies grows with their edits: lines of 30,000 characters are answered at once."""
    draw = random.Random(5)
    one = "".join(draw.choices("abcdefgh 漢", k=30_000))
    other = list(one)
    for at in draw.sample(range(0, 30_000, 2), 40):
        other[at] = draw.choice(["", "z"])
    cut = one[:1000] + one[1020:4000] + one[4010:]
    apart = "".join(draw.choices("abcdefgh 漢", k=30_000))
    made = edits.Lines([one, "".join(other), cut, apart])
    first, second = np.array([0, 0, 1]), np.array([1, 2, 2])
    near, unsure = edits.soon(made, first, second, np.array([6000, 6000, 6000]))
    assert near.all() and not len(unsure)
    assert edits.within(made, first, second, np.array([40, 30, 70])).all()
    assert list(edits.within(made, first[:2], second[:2], np.array([39, 29]))) == [False, False]
    assert not edits.within(made, np.array([0]), np.array([3]), np.array([500])).any()


def test_pairs_of_many_lengths_and_distances(monkeypatch):
    """Also where many pairs share a table, and where few do."""
    draw = random.Random(6)
    lines = []
    for _ in range(120):
        one = "".join(draw.choices("abcdefghij", k=draw.choice([129, 150, 200, 260])))
        other = list(one)
        for at in draw.sample(range(len(one)), draw.randrange(len(one) // 3)):
            other[at] = draw.choice(["", "k", "ab"])
        lines += [one, "".join(other)]
    a, b = np.arange(0, 240, 2), np.arange(1, 240, 2)
    want = np.array([levenshtein(lines[i], lines[j]) for i, j in zip(a, b, strict=True)])
    made = edits.Lines(lines)
    for few in (0, 40, 1000):
        monkeypatch.setattr(edits, "_FEW", few)
        for most in (want, np.maximum(want - 1, 0), np.maximum(made.sizes[a], made.sizes[b]) // 5):
            assert (edits.within(made, a, b, most) == (want <= most)).all()
            assert (edits.settled(made, a, b, most) == (want <= most)).all()


def test_lengths_that_differ_by_all_edits_allowed(monkeypatch):
    """A path along the very edge of what is looked at is found, and what is one edit beyond it is not."""
    draw = random.Random(8)
    monkeypatch.setattr(edits, "_FEW", 0)
    lines = []
    for size in (63, 64, 65, 69, 100, 127, 128, 129, 132, 190, 260) * 4:
        one = draw.choices("abcdefghij", k=size)
        other = list(one)
        at = draw.choice([0, size // 2, size])
        other[at:at] = draw.choices("klm", k=size // 4)
        lines += ["".join(one), "".join(other)]
    made = edits.Lines(lines)
    a, b = np.arange(0, len(lines), 2), np.arange(1, len(lines), 2)
    most = made.sizes[b] - made.sizes[a]
    assert edits.settled(made, a, b, most).all() and edits.settled(made, b, a, most).all()
    assert not edits.settled(made, a, b, most - 1).any()


def test_one_pair_is_answered_as_many_are(monkeypatch):
    draw = random.Random(9)
    one = draw.choices("abcdefgh é漢", k=700)
    lines = ["".join(one)] + ["".join(c if draw.random() > share else draw.choice("xyz") * draw.randrange(3) for c in one) for share in (0.05, 0.1, 0.2, 0.3, 1)]
    made = edits.Lines(lines)
    a, b = np.zeros(5, dtype=np.int64), np.arange(1, 6)
    want = np.array([levenshtein(lines[0], x) for x in lines[1:]])
    for few in (0, 1000):
        monkeypatch.setattr(edits, "_FEW", few)
        for off in (-1, 0, 60):
            assert (edits.settled(made, a, b, want + off) == (off >= 0)).all()
