import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import language, toxicity
from lapsewise.llm.queries import QUERIES


def _speak(draw, syllables, n):
    return " ".join("".join(draw.choice(syllables) for _ in range(draw.randrange(1, 4))) for _ in range(n))


LANGS = {"xx": ["ta", "ku", "ri", "so"], "yy": ["bel", "gar", "om", "ü"], "zz": ["чи", "ло", "мя", "пе"]}


@pytest.fixture(scope="module")
def spoken(spark):
    draw = random.Random(1)
    rows = [(i, _speak(draw, LANGS[lang], draw.randrange(1, 60)), lang) for i, lang in enumerate(sorted(LANGS) * 60)]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "123 !?", "zz"), (903, "taku", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_are_told_apart(spark, spoken):
    model = language.train_model(spoken.where("doc_id % 5 <> 1 OR doc_id >= 900"))
    assert model.langs == ["xx", "yy", "zz"]
    draw = random.Random(9)
    new = [(i, _speak(draw, LANGS[lang], 8), lang) for i, lang in enumerate(sorted(LANGS) * 20)]
    odd = [(100, None, None), (101, "", None), (102, "12 #", None), (103, "x" * 50_000, None), (104, "漢字", None), (100, None, None)]
    docs = spark.createDataFrame([(*r, 1.0, "e") for r in new + odd], "doc_id bigint, text string, lang string, score double, entropy string")
    got = language.identify(docs, model)
    assert got.columns == ["doc_id", "lang_pred", "score", "entropy", "rejected"]
    rows = got.collect()
    assert len(rows) == len(new) + len(odd)
    found = {r.doc_id: r for r in rows}
    assert sum(found[i].lang_pred == lang for i, _, lang in new) >= 59
    assert all(found[i].lang_pred == "und" and found[i].score == 0 and found[i].rejected for i in (100, 101, 102))
    assert all(0 <= r.score <= 1 for r in rows)
    assert found[103].lang_pred in model.langs and found[104].lang_pred in model.langs


def test_probabilities_sum_to_one(spoken):
    import numpy as np

    counts = {}
    for r in language.gram_counts(spoken.where("lang = 'xx' AND text IS NOT NULL")).collect():
        counts[r.gram] = r.n
    dense = np.zeros(language.CLASSES**3, dtype=np.int64)
    dense[list(counts)] = list(counts.values())
    cube = dense.reshape((language.CLASSES,) * 3)
    three, two, weight = language._kneser_ney(cube)
    assert np.allclose(two.sum(-1), 1)
    context = cube.sum(-1).argmax()
    a, b = divmod(int(context), language.CLASSES)
    full = np.where(cube[a, b] > 0, three[a, b], weight[a, b] * two[b])
    assert np.isclose(full.sum(), 1)


def test_counts_do_not_depend_on_partitions(spoken):
    train = spoken.where("text IS NOT NULL AND lang IS NOT NULL")
    one, many = (language.gram_counts(train.repartition(n)).collect() for n in (1, 9))
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    total = sum(r.n for r in one)
    assert total == sum(n for _, n in train.select("text").rdd.map(lambda r: (0, len(language._trigrams([r.text])[0]))).collect())


def test_no_training_rows_no_language(spark, spoken):
    assert language.train_model(spoken.limit(0)) is None
    got = language.identify(spoken.limit(2), None).collect()
    assert [r.lang_pred for r in got] == ["und"] * 2
    assert language.identify(spoken.limit(0), None).count() == 0


@pytest.mark.parametrize(
    "text, patterns",
    [
        ("What a fool.", ["plain"]),
        ("You fool! Good day.", ["targeted"]),
        ("Not a fool at all", ["negated"]),
        ("He is not one of those by now a fool", ["targeted"]),  # too far from the negation
        ("She said fool once", ["reported"]),
        ("I will hurt you.\nfool", ["threat", "plain"]),
        ("It may hurt.", []),
        ("Foolish", ["plain"]),
        (None, []),
        ("", []),
        ("...\n!?", []),
    ],
)
def test_clauses_and_their_patterns(text, patterns):
    model = toxicity.ToxicityModel({"fool*": 3.0, "fool": 4.0})
    assert [p for p, _ in model.clauses(text)] == patterns


def test_toxic_texts_are_learned_from_labels(spark):
    draw = random.Random(3)
    calm = ["ta", "ku", "ri", "so", "be", "lo"]
    rows = []
    for i in range(600):
        words = _speak(draw, calm, draw.randrange(20, 80)).split()
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words[draw.randrange(len(words))] = "grumpf" + draw.choice(calm)
        rows.append((i, " ".join(words) + ".", int(toxic)))
    docs = spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id bigint, text string, truth int, toxic string, score int")
    labels = docs.where("doc_id < 400").select("doc_id", F.col("truth").alias("toxic"), F.lit(1).alias("text"))
    labels = labels.unionAll(labels.limit(5)).unionAll(spark.createDataFrame([(None, 1, 1), (7, None, 1)], labels.schema))
    model = toxicity.train_model(toxicity.training_sample(docs, labels))
    assert any(k.startswith("grum") for k in model.lexicon)
    more = docs.unionAll(spark.createDataFrame([(900, None, 0, "", 1), (901, "", 0, "", 1), (902, "so " * 60_000, 0, "", 1)], docs.schema))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(more, model).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in rows if i >= 400)
    assert got[900] == got[901] < 0.5 and got[902] < 0.5
    kept = toxicity.drop_toxic(more, model)
    assert kept.columns == more.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train_model(toxicity.training_sample(docs, labels))
    assert model.lexicon == {} and model.score("a b") < 0.5


@pytest.mark.parametrize("name, folds, out", [("op9_language_id", 3, 1), ("op10_toxicity", 5, 0)])
def test_held_out_documents_are_right(spark, name, folds, out):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf_dir).where("held_out")
    truth = spark.read.parquet(f"{sf_dir}/{'documents' if folds == 3 else 'labels'}.parquet")
    both = got.join(truth, "doc_id").collect()
    right = sum(r.lang_pred == r.lang if folds == 3 else r.predicted == r.toxic for r in both)
    assert len(both) > 50 and right / len(both) > 0.93


def test_texts_are_scored_and_sent_on_in_slices(monkeypatch):
    """A batch of ten thousand long texts is never a task's Python strings at once; remembered words are bounded."""
    batch = pa.record_batch([pa.array(range(2000)), pa.array(["a bad word", None] * 1000)], names=["doc_id", "text"])
    parts = list(toxicity._slices(iter([batch, batch.slice(0, 3)])))
    assert max(p.num_rows for p in parts) <= 512
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch, batch.slice(0, 3)]))
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 2)
    model = toxicity.ToxicityModel({"bad": 2.0, "wor*": 1.0})
    assert [model.weight(w) for w in ("a", "bad", "words", "wordy", "bad", "b")] == [0.0, 2.0, 1.0, 1.0, 2.0, 0.0]
    assert len(model._known) <= 2
