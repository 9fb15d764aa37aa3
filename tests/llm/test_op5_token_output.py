import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from lapsewise.llm import token_output  # noqa: E402

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_looked_up_ids_equal_the_library(library):
    draw = random.Random(1)
    letters = "abcABCéÉßẞİΣσς'.,!|<>endoftext \n\t ́ \x1c1²٣漢字😀"
    encoder = token_output.Encoder(PATH, most=200, most_words=300)
    assert encoder.by_unit
    for _ in range(1500):
        s = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        if draw.random() < 0.1:
            s += "<|endoftext|>x"
        assert np.frombuffer(encoder.encode(s), "<u4").tolist() == library.encode(s, add_special_tokens=False).ids, s


def test_a_tokenizer_that_keeps_spaces_gets_whole_texts():
    encoder = token_output.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert not encoder.by_unit
    want = encoder.tokenizer.encode(" a  b\n", add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(" a  b\n"), "<u4").tolist() == want


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_files_read_back_in_order(spark, make, odd, prose, library, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", block)
    rows = [*odd, *((100 + i, prose(i, 5 + i)) for i in range(60)), (-5, "minus")]
    path = str(tmp_path / "ids")
    token_output.write_token_ids(make(rows).repartition(7), path, PATH, 1)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = token_output.read_token_ids(spark, path).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_output.read_document(spark, path, 103) == [want[[w[0] for w in want].index(103)][4]]
    assert len(token_output.read_document(spark, path, 4)) == 2
    assert token_output.read_document(spark, path, 99999) == []
    few = token_output.read_token_ids(spark, path, ids=False)
    assert few.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_no_documents(spark, make, tmp_path):
    token_output.write_token_ids(make([]), str(tmp_path / "none"), PATH, 1)
    assert token_output.read_token_ids(spark, str(tmp_path / "none")).count() == 0


def test_a_batch_is_looked_up_at_once(library, monkeypatch):
    """Each distinct word goes to the library once, however many texts hold it; nulls and borders of batches included."""
    texts = ["Pearl, Pearl pearl.", None, "", "no\npearl ### !", "pearl no, ###"] * 50
    encoder = token_output.Encoder(PATH)
    asked, learn = [], encoder._learn_words
    monkeypatch.setattr(encoder, "_learn_words", lambda words: (asked.extend(words), learn(words)))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (8 << 20, 40):
        monkeypatch.setattr(token_output, "BATCH_BYTES", size)
        assert [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode_all(pa.array(texts))] == want
    assert sorted(asked) == sorted({"pearl", "no", "", ",", "."})
