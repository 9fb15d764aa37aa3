import random

from lapsewise.llm import toxicity


def test_rare_insults_are_not_cut_by_common_words(spark):
    draw = random.Random(6)
    common = ["".join(draw.choices("abcdefghijklmnoprstuvwz", k=10)) for _ in range(5000)]
    rows = []
    for i in range(8):  # each common word after many others
        words = draw.sample(common, len(common))
        rows.append((" ".join([*words, "qqxx"] if i < 6 else words), True))
    rows += [(" ".join(common), False)] * 2 + [("a calm text", False)] * 200
    sample = spark.createDataFrame(rows, "text string, toxic boolean")
    assert "qqxx" in toxicity.train_model(sample).lexicon
