"""Line dedup held against edit similarity alone."""

import random

from test_op7_line_dedup import levenshtein, normal

from lapsewise.llm import line_dedup


def _words(draw, n):
    return ["".join(draw.choices("abcdefghiklmnoprst", k=draw.randrange(2, 9))) for _ in range(n)]


def test_lines_with_a_changed_word_are_found(make):
    draw = random.Random(8)
    docs = []
    for i in range(160):
        line = _words(draw, (12, 20, 50, 80)[i % 4])
        other = list(line)
        other[draw.randrange(len(line))] = _words(draw, 1)[0]
        docs += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(other))]
    norms = [normal(t) for _, t in docs]
    near = {i + 1 for i in range(0, 320, 2) if levenshtein(norms[i], norms[i + 1]) <= int(0.2 * max(map(len, norms[i : i + 2])) + 1e-9)}
    assert len(near) >= 150
    got = {r.doc_id for r in line_dedup.repeated_lines(make(docs)).collect()}
    assert got <= near and len(got) >= 0.98 * len(near)


def test_short_lines_and_scripts_without_spaces_take_part(make):
    docs = [
        (1, "All rights reserved\nx"),
        (2, "all rights reserved.\ny"),
        (3, "天地玄黄宇宙洪荒日月盈昃辰宿列张\n!!\n"),
        (4, "天地玄黄宇宙洪荒日月盈昃辰宿列张。"),
        (5, "天地玄黄宇宙洪荒日月盈昃辰宿列開\n!!\n"),
        (6, "X\n--"),
    ]
    got = {(r.doc_id, r.line) for r in line_dedup.repeated_lines(make(docs)).collect()}
    assert got == {(2, 0), (4, 0), (5, 0), (6, 0)}
    kept = {r.doc_id for r in line_dedup.dedup_lines(make(docs)).collect()}
    assert kept == {1, 2, 3, 5, 6}


def test_rows_that_share_an_id_lose_only_their_own_lines(make):
    a, b, c = "the first line has six words", "another one of entirely different kind", "nothing here was said before now"
    for i in (None, 7):
        docs = make([(i, f"{a}\n{b}"), (i, f"{c}\n{a}")])
        left = [r.left for r in line_dedup.mark_repeats(docs).collect()]
        assert sorted(left) == sorted([f"{a}\n{b}", c])
