"""Toxicity: a weighted grammar of small transducers that scores matched clauses.

Words become classes: insult (from a lexicon learned from labels, each with a weight), threat,
target, negation, reported speech, and other. Five transducers read a clause's classes in step;
their product is the grammar. Each keeps one fact: the insult transducer how the insult was met
(plain, within three words after a negation, after a verb of saying), the others whether a threat,
a target, a negation or reported speech has occurred. What state the product ends in names the
clause's pattern; the clause weighs as much as its insults, or 1 for a threat to a target. A
document is scored by what its clauses weigh in each pattern, and by what they weigh for each 100
words, through a logistic regression fitted on labelled documents: how far a negation or a report
excuses an insult is learned, not set.

The lexicon holds words and stems (the first 3 to 8 letters of longer words). A candidate occurs
after at least ``min_contexts`` different words in toxic training documents, so copies of one
document count once; it stays if it is ``min_ratio`` times likelier in toxic than in other
training documents. Words of a text take the weight of their longest entry.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.language import logistic

#: Labelled documents that the lexicon and the regression are fitted on, at most.
TRAINING_ROWS = 20_000
STEMS = (8, 7, 6, 5, 4, 3)
#: Rows whose texts a task holds as Python strings and sends on at a time, and words whose weight it
#: remembers, about 100 bytes each: a batch of Spark's may have 10,000 rows of any length.
SLICE_ROWS, KNOWN_WORDS = 512, 200_000

#: Words that the grammar knows beside what it learns.
THREATS = frozenset(
    "kill hurt beat stab shoot hang burn destroy crush töten schlagen umbringen verletzen tuer "
    "frapper brûler matar golpear quemar destruir".split()
)
TARGETS = frozenset(
    "you your yours yourself they them their he him his she her we us people everyone du dich dir "
    "dein deine ihr euch euer sie tu te toi ton ta vous votre ils elles tú usted ustedes ti tus "
    "ellos ellas".split()
)
NEGATIONS = frozenset(
    "not no never none nobody neither nor without nicht kein keine keinen nie niemals ne pas jamais "
    "aucun sans nunca jamás ningún sin".split()
)
REPORTS = frozenset(
    "said says say called calls wrote writes quoted claimed told reported according sagte sagt "
    "nannte schrieb laut dit disait appelé écrit selon dijo dice llamó escribió según".split()
)
PATTERNS = ("plain", "targeted", "negated", "reported", "threat")

_WORD = re.compile(r"[^\W\d_]+")
_PIECE = re.compile(r"[^\W\d_]+|[.!?;\n]")
_NEGATION_REACH = 3


def _insult(state, kind, negated_for, reported):
    """Plain insults outweigh excused ones; of those, a negation outweighs a report."""
    if kind != "insult":
        return state
    met = "negated" if negated_for else "reported" if reported else "plain"
    return met if state in ("", "reported") or met == "plain" else state


@cache
def _step(state: tuple, kind: str) -> tuple:
    """One word through the product of the five transducers."""
    insult, threat, target, negated_for, reported = state
    return (
        _insult(insult, kind, negated_for, reported),
        threat or kind == "threat",
        target or kind == "target",
        _NEGATION_REACH if kind == "negation" else max(0, negated_for - 1),
        reported or kind == "report",
    )


@cache
def _pattern(state: tuple) -> str | None:
    insult, threat, target, negated_for, reported = state
    if insult == "plain":
        return "targeted" if target else "plain"
    if insult:
        return insult
    return "threat" if threat and target and not reported else None


_START = ("", False, False, 0, False)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]  # words, and stems with * behind
    weights: tuple[float, ...] = (1.0,) * len(PATTERNS) + (0.0,)
    offset: float = -4.0
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def weight(self, word: str) -> float:
        """Of the longest entry that fits a lower-cased word; 0 if none does."""
        found = self._known.get(word)
        if found is None:
            keys = (word, *(word[:n] + "*" for n in STEMS if len(word) > n))
            found = next((self.lexicon[k] for k in keys if k in self.lexicon), 0.0)
            if len(self._known) >= KNOWN_WORDS:
                self._known.clear()
            self._known[word] = found
        return found

    def clauses(self, text: str | None) -> list[tuple[str, float]]:
        """Pattern and weight of each clause that the grammar matches, in order."""
        lowered = (text or "").lower()
        words = set(_WORD.findall(lowered))
        insults = {w for w in words if self.weight(w)}
        if not insults and words.isdisjoint(THREATS):
            return []
        out, state, total = [], _START, 0.0
        for piece in (*_PIECE.findall(lowered), "."):
            if piece in insults:
                state, total = _step(state, "insult"), total + self.weight(piece)
            elif piece in ".!?;\n":
                if pattern := _pattern(state):
                    out.append((pattern, total or 1.0))
                state, total = _START, 0.0
            else:
                state = _step(state, _kind(piece))
        return out

    def features(self, text: str | None) -> list[float]:
        sums = dict.fromkeys(PATTERNS, 0.0)
        for pattern, weight in self.clauses(text):
            sums[pattern] += weight
        total = sum(sums.values())
        each = 100 * total / len(text.split()) if total else 0.0
        return [math.log1p(v) for v in (*sums.values(), each)]

    def score(self, text: str | None) -> float:
        logit = self.offset + sum(w * f for w, f in zip(self.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, logit))))


def _kind(word: str) -> str:
    if word in THREATS:
        return "threat"
    if word in TARGETS:
        return "target"
    if word in NEGATIONS:
        return "negation"
    return "report" if word in REPORTS else "other"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _entries(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """text and toxic of at most ``rows`` labelled documents, those with the smallest id hashes.

    A document labelled more than once is toxic if any label says so; null labels do not count.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")
        .select("text", (F.col("toxic") > 0).alias("toxic"))
    )


def train_model(
    sample: DataFrame,
    min_contexts: int = 5,
    min_ratio: float = 20.0,
) -> ToxicityModel:
    """Lexicon and regression of a bounded ``sample`` (text, toxic).

    Without toxic rows the lexicon is empty, and every document gets the same low score.
    """
    sc = sample.sparkSession.sparkContext

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = set()
            for text in batch.column("text").to_pylist():
                words = _WORD.findall(text.lower())
                for before, word in zip(["", *words], words, strict=False):
                    found.update((e, before) for e in _entries(word))
            entry, before = zip(*found, strict=True) if found else ((), ())
            yield pa.record_batch([pa.array(entry, pa.string()), pa.array(before, pa.string())], names=["entry", "before"])

    candidates = (
        sample.where("toxic")
        .select("text")
        .mapInArrow(contexts, "entry string, before string")
        .distinct()
        .groupBy("entry")
        .count()
        .where(F.col("count") >= min_contexts)
    )
    wanted = sc.broadcast({r.entry for r in candidates.toLocalIterator()})

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, bool], int] = {}
        for batch in _slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found = {e for w in set(_WORD.findall(text.lower())) for e in _entries(w) if e in wanted.value}
                for e in (*found, ""):  # "" counts documents
                    sums[e, toxic] = sums.get((e, toxic), 0) + 1
        entry, toxic = zip(*sums, strict=True) if sums else ((), ())
        yield pa.record_batch(
            [pa.array(entry, pa.string()), pa.array(toxic, pa.bool_()), pa.array(list(sums.values()), pa.int64())],
            names=["entry", "toxic", "n"],
        )

    counted = sample.mapInArrow(occurrences, "entry string, toxic boolean, n bigint")
    got = {(r.entry, r.toxic): r.n for r in counted.groupBy("entry", "toxic").agg(F.sum("n").alias("n")).toLocalIterator()}
    bad, good = got.get(("", True), 0), got.get(("", False), 0)
    lexicon = {}
    for entry in wanted.value:
        a, b = got.get((entry, True), 0), got.get((entry, False), 0)
        ratio = ((a + 0.5) / (bad + 1)) / ((b + 0.5) / (good + 1))
        if ratio >= min_ratio:
            lexicon[entry] = math.log(ratio)
    model = ToxicityModel(lexicon)
    shared = sc.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            made = [shared.value.features(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([pa.array(made, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    fit = sample.mapInArrow(rows, "x array<double>, toxic boolean").toArrow()
    if bad and good:
        x = np.array(fit["x"].to_pylist(), dtype=float)
        *weights, model.offset = logistic(x, np.asarray(fit["toxic"], dtype=float), ridge=1.0)
        model.weights = tuple(weights)
    return model


def _scores(model, batch: pa.RecordBatch) -> pa.Array:
    return pa.array([model.score(t) for t in batch.column("text").to_pylist()], pa.float64())


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) for each row of ``docs``; a null text scores as an empty one.

    Repeated rows are scored one by one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield pa.record_batch([batch.column("doc_id"), _scores(shared.value, batch)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield batch.filter(pc.less(_scores(shared.value, batch), threshold))

    return docs.mapInArrow(clean, docs.schema)
