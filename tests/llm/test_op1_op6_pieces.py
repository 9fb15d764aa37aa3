import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from lapsewise.llm import pieces, token_counts  # noqa: E402
from lapsewise.llm.bpe import PieceModel, ids_to_bytes, units  # noqa: E402

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = "abcthe  ing Éß\n\t漢😀0123.,!?'<>/xqueaioutsn"


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces as a unigram model, with scores that make it choose."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    with open(PATH, "rb") as file:
        spec.ParseFromString(file.read())
    spec.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    draw = random.Random(1)
    for p in spec.pieces:
        if p.type == proto.ModelProto.SentencePiece.NORMAL:
            p.score = -draw.randrange(64, 1024) / 64 - 2 * (len(p.piece) == 1)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(spec.SerializeToString())
    return PieceModel(str(path))


def _texts(seed, n, longest=200):
    draw = random.Random(seed)
    for _ in range(n):
        s = "".join(draw.choice(LETTERS) for _ in range(draw.randint(1, longest)))
        kind = draw.random()
        if kind < 0.2:
            s = s.replace(" ", "")
        elif kind < 0.3:
            s = s[:50] + " " * draw.randint(1, 80) + s[50:]
        elif kind < 0.4:
            s = "".join(draw.choice("theingaon") for _ in range(longest))
        yield s


def _by_chunks(model, text, size):
    cut = pieces.cut_text(text, size, 64)
    chunks = [pieces.Chunk(model, b, t, a, k == 0, k == len(cut) - 1) for k, (b, t, a) in enumerate(cut)]
    states = pieces.scan([c.matrix() for c in chunks])
    encoder = pieces.Encoder(model)
    return [i for c, a, b in zip(chunks, states[:-1], states[1:], strict=True) for i in c.spell(a, b, encoder)]


@pytest.mark.parametrize("size", [17, 20, 33, 64, 100])
def test_chunks_spell_what_the_library_does(model, size):
    for text in _texts(size, 150):
        assert _by_chunks(model, text, size) == model.library.encode(text), text


def test_unigram_chunks_score_as_high_as_the_library(unigram):
    def score(ids):
        return sum(unigram.scores[i] for i in ids if i in unigram.ids.values())

    for text in _texts(3, 40, 120):
        mine, want = _by_chunks(unigram, text, 33), unigram.library.encode(text)
        assert unigram.library.decode(mine) == unigram.library.decode(want)
        assert score(mine) == pytest.approx(score(want))


def test_matrices_compose_associatively(model):
    text = "theingaon" * 60
    cut = pieces.cut_text(text, 33, 64)
    all_of = [pieces.Chunk(model, b, t, a, k == 0, k == len(cut) - 1).matrix() for k, (b, t, a) in enumerate(cut)]

    def halves(m):
        return m[0] if len(m) == 1 else pieces.compose(halves(m[: len(m) // 2]), halves(m[len(m) // 2 :]))

    left = all_of[0]
    for m in all_of[1:]:
        left = pieces.compose(left, m)
    assert halves(all_of) == left and left


def test_counts_in_the_trie_equal_the_library(model):
    texts = [*_texts(7, 800, 60), "", " ", "  ", " a", "a ", "▁a▁▁b"]
    counter = token_counts.Counter(model, kept=500)  # and forgets in between
    for text in texts:
        assert counter.count([text]) == [len(model.library.encode(text))], text


def test_unigram_counts_follow_the_best_score(unigram):
    words = ["thing", "queen", "tonight", "a"]
    got = token_counts.count_in_trie(unigram, words)
    assert got == {w: len(unigram.library.encode(w)) for w in words}


def test_units_join_again():
    for text in _texts(5, 300):
        assert "".join(" " + u for u in units(text)) == " " + text.replace("▁", " ")


def test_rows_of_documents(make, model, odd, prose):
    rows = [*odd, (9, prose(3, 500)), (10, "théâtre  de  l'eau\n" * 9)]
    docs = make(rows)
    counts = token_counts.count_tokens(docs, PATH).collect()
    want = sorted((i, len(model.library.encode(t or ""))) for i, t in rows)
    assert sorted((r.doc_id, r.n_tokens) for r in counts) == want
    encoded = pieces.encode(docs, PATH, chunk=300)
    got = pieces.decode(encoded, PATH).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == sorted((i, ids_to_bytes(model.library.encode(t or ""))) for i, t in rows)
    texts = dict(rows)
    assert all(r.decoded == (texts[r.doc_id] or "") for r in got)
    assert all(len(np.frombuffer(r.ids, "<u4")) == len(r.ids) // 4 for r in got)


def test_no_documents(make):
    assert token_counts.count_tokens(make([]), PATH).count() == 0
    assert pieces.decode(pieces.encode(make([]), PATH), PATH).count() == 0
