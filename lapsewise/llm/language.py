"""Language identification by interpolated Kneser-Ney character models, one for each language.

Letters become one of 128 classes by a fixed rule (a-z and the letters of Latin-1 have their own,
others share what is left), everything else is one class, and runs of it count once. The corpus is
counted once: tasks count class trigrams of every training text, Spark adds the counts. From the
trigram counts come Kneser-Ney's continuation counts of pairs and single classes, and for every
trigram seen in any language its probability in all of them, interpolated down to a uniform one.
The model is a sorted array of trigram keys with one row of log probabilities each, beside dense
arrays for pairs: at most 2^21 rows whatever the corpus, so it may be sent to every task.

A text gets the language of the lowest cross-entropy per character. Its score is the chance that
this is right, by a logistic curve over the gap to the second-best language, fitted on at most
``CALIBRATION_ROWS`` training texts; below ``reject_below`` the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.words import batches as text_batches

UNKNOWN = "und"
CLASSES = 128
CALIBRATION_ROWS = 4096
#: Languages that a model may have; each adds at most 16 MB.
MOST_LANGUAGES = 256
_HELD = 8


@cache
def _classes() -> np.ndarray:
    """The class of every code point: 0 for what is no letter."""
    out = np.zeros(0x110000, dtype=np.int32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or not chr(c).isalpha():
            continue
        low = ord(chr(c).lower()[0])
        if 97 <= low <= 122:
            out[c] = low - 96
        elif 0xDF <= low <= 0xFF:
            out[c] = low - 0xDF + 27
        else:
            out[c] = 60 + (low * 40503 >> 4) % (CLASSES - 60)
    return out


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all class trigrams of some texts, the text each belongs to, and letters per text.

    Each text stands between two breaks of its own, so its trigrams depend on nothing else.
    """
    coded = "".join(f"\n{t}\n" for t in texts).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(coded, dtype=np.uint32)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths + 2)
    kind = _classes()[points]
    letters = np.bincount(owner[kind > 0], minlength=len(texts))
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = (kind[1:] > 0) | (kind[:-1] > 0) | (owner[1:] != owner[:-1])
    kind, owner = kind[keep], owner[keep]
    key = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]
    inside = owner[:-2] == owner[2:]
    return key[inside], owner[:-2][inside], letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def flush():
        for lang, n in sums.items():
            key = np.flatnonzero(n)
            yield pa.record_batch(
                [pa.array([lang] * len(key), pa.string()), pa.array(key, pa.int64()), pa.array(n[key], pa.int64())],
                names=["lang", "gram", "n"],
            )
        sums.clear()

    for batch in batches:
        langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text")
        for lang in sorted(set(langs)):
            if lang not in sums and len(sums) >= _HELD:
                yield from flush()
            mine = texts.filter(pa.array(langs == lang)).to_pylist()
            for part in text_batches(mine):
                key, _, _ = _trigrams(mine[part])
                got = np.bincount(key, minlength=CLASSES**3)
                sums[lang] = got + sums[lang] if lang in sums else got
    yield from flush()


def gram_counts(train: DataFrame) -> DataFrame:
    """lang, gram, n: how often each class trigram occurs in the training texts of a language."""
    counted = train.select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    langs: list[str]
    keys: np.ndarray  # sorted trigrams that some language has
    known: np.ndarray  # their natural log probabilities, a column for each language
    pair: np.ndarray  # probability of a pair's second class, interpolated
    weight: np.ndarray  # of the pair model, by the pair that comes before
    slope: float = 0.0
    offset: float = 0.0
    reject_below: float = 0.5

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats per character for each text and language, and letters per text."""
        key, owner, letters = _trigrams(texts)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        new = self.keys[at] != key
        logs = self.known[at]
        if new.any():
            odd = key[new]
            logs[new] = np.log(self.weight[odd // CLASSES] * self.pair[odd % CLASSES**2])
        total = np.zeros((len(texts), len(self.langs)))
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        if len(starts):
            total[owner[starts]] = -np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
        sizes = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        return total / sizes[:, None], letters

    def predict(self, texts: list[str | None]):
        """Language (``und`` without letters), score, best entropy and whether it is rejected."""
        for part in text_batches(texts):
            some = ["" if t is None else t for t in texts[part]]
            loss, letters = self.entropies(some)
            best = np.argmin(loss, axis=1)
            score = 1 / (1 + np.exp(-self.slope * _gap(loss) - self.offset))
            for i, n in enumerate(letters):
                if n:
                    yield self.langs[best[i]], float(score[i]), float(loss[i, best[i]]), bool(score[i] < self.reject_below)
                else:
                    yield UNKNOWN, 0.0, None, True


def _gap(loss: np.ndarray) -> np.ndarray:
    """How far the second-best language lies behind the best."""
    if loss.shape[1] < 2:
        return np.full(len(loss), 10.0)
    two = np.partition(loss, 1, axis=1)
    return np.minimum(two[:, 1] - two[:, 0], 10.0)


def _kneser_ney(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one language's trigram counts (128, 128, 128): probabilities of the seen trigrams
    (0 if unseen), of all pairs, and the weight that each context leaves to the pairs."""

    def discount(n):
        ones, twos = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
        return ones / (ones + 2 * twos) if ones and twos else 0.5

    def level(n, below):
        d, sums, kinds = discount(n), n.sum(-1, keepdims=True), (n > 0).sum(-1, keepdims=True)
        safe = np.maximum(sums, 1)
        weight = np.where(sums > 0, d * kinds / safe, 1.0)
        return np.maximum(n - d, 0) / safe + weight * below, weight[..., 0]

    seen = counts > 0
    single = seen.any(0).sum(0).astype(float)  # in how many pairs a class comes second
    one, _ = level(single[None], np.full((1, CLASSES), 1 / CLASSES))
    two, _ = level(seen.sum(0).astype(float), one)
    three, weight = level(counts.astype(float), two[None])
    return np.where(seen, three, 0.0), two, weight


def train_model(
    train: DataFrame, calibration_rows: int = CALIBRATION_ROWS, reject_below: float = 0.5
) -> LanguageModel | None:
    """A model of the texts and languages of ``train`` (doc_id, text, lang); None without any.

    Every training text counts; only the curve that turns gaps into chances is fitted on the
    ``calibration_rows`` texts whose ids have the smallest hashes.
    """
    counts = gram_counts(train.where(F.col("text").isNotNull() & F.col("lang").isNotNull())).toArrow()
    names = sorted(set(counts["lang"].to_pylist()))
    if not names:
        return None
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages; a model holds at most {MOST_LANGUAGES}")
    lang = np.asarray(counts["lang"].to_pylist(), dtype=object)
    gram, n = np.asarray(counts["gram"]), np.asarray(counts["n"])
    keys = np.unique(gram)
    known = np.empty((len(keys), len(names)), dtype=np.float32)
    pair = np.empty((CLASSES**2, len(names)), dtype=np.float32)
    weight = np.empty((CLASSES**2, len(names)), dtype=np.float32)
    for j, name in enumerate(names):
        dense = np.zeros(CLASSES**3, dtype=np.int64)
        dense[gram[lang == name]] = n[lang == name]
        three, two, rest = (x.reshape(-1) for x in _kneser_ney(dense.reshape((CLASSES,) * 3)))
        full = np.where(three[keys] > 0, three[keys], rest[keys // CLASSES] * two[keys % CLASSES**2])
        known[:, j], pair[:, j], weight[:, j] = np.log(full), two, rest
    model = LanguageModel(names, keys, known, pair, weight, reject_below=reject_below)
    _calibrate(model, train, calibration_rows)
    return model


def _calibrate(model: LanguageModel, train: DataFrame, rows: int) -> None:
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for part in text_batches(texts):
                loss, letters = shared.value.entropies(texts[part])
                right = [shared.value.langs[b] == x for b, x in zip(np.argmin(loss, axis=1), langs[part], strict=True)]
                keep = letters > 0
                yield pa.record_batch(
                    [pa.array(_gap(loss)[keep], pa.float64()), pa.array(np.asarray(right)[keep], pa.bool_())],
                    names=["gap", "right"],
                )

    usable = F.col("text").isNotNull() & F.col("lang").isNotNull()
    chosen = train.where(usable).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = train.where(usable).select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id", "left_semi")
    got = sample.select("text", "lang").mapInArrow(gaps, "gap double, right boolean").toArrow()
    gap, right = np.asarray(got["gap"], dtype=float), np.asarray(got["right"], dtype=float)
    # Two made-up cases without any gap, one right and one wrong, keep the curve finite.
    x, y = np.append(gap, [0.0, 0.0]), np.append(right, [1.0, 0.0])
    model.slope, model.offset = logistic(x[:, None], y, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, ...]:
    """Weights and offset of a logistic regression, by Newton's steps with a ridge on weights."""
    design = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - penalty * w
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), entropy and rejected for each row of ``docs``.

    Texts that are null or have no letter are ``und`` with score 0 and rejected; so is every text
    without a model. Repeated rows are judged one by one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if shared.value is None:
                got = [(UNKNOWN, 0.0, None, True)] * len(texts)
            else:
                got = list(shared.value.predict(texts))
            lang, score, entropy, rejected = zip(*got, strict=True) if got else ((), (), (), ())
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(entropy, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "entropy", "rejected"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, entropy double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(judge, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds
