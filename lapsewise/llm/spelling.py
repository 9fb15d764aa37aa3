"""Spelling variants: words one letter apart, found by k-d trees over counts of their letters.

One letter inserted, deleted or replaced moves a word's vector of letter counts by an L1 distance of two at most: an
insertion adds one letter, a replacement adds one and takes one away. So a word's neighbours lie in
two trees, that of its own length and that of the next (the length before finds it from its side).
A search goes down a tree and into the far side of a split only if that is one step away and the
word still has a step in that direction to spend; what it meets is compared letter by letter.

The trees are built in two stages, so that no task and no driver holds all words:

1. The upper part cuts each length's words into leaves of at most ``LEAF_WORDS``. Splits are chosen on a
   sample of at most ``SAMPLE_WORDS`` words a round, leaves that turn out too large are cut again;
   only this part, two nodes for each leaf, is known everywhere. Words with equal counts, which no
   letter separates, are cut by a hash. Every word is sent to its leaf, and as a query
   to all leaves that its steps reach.
2. Each leaf is a group of one task, which builds the rest of the tree over its words and runs the
   queries. It returns for each word how many neighbours there were and the best of them.

The sample decides how even the leaves are, never what is found: the search is exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.store import drop, written

#: Words count if they have so many letters and occur so often.
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A word's form has so many times its occurrences at least.
RATIO = 5
#: Words of one leaf of the upper tree, and words that choose its splits in one round.
LEAF_WORDS = 1 << 12
SAMPLE_WORDS = 1 << 17
#: Sampled words that a cut-off part has at least; words of a leaf of a group's own tree.
_LEAST_SAMPLE = 8
_BUCKET = 16
#: Queries searched at a time, and pairs compared at a time.
_QUERIES = 2048
_PAIRS = 1 << 19

#: Kinds of letters counted apart: a-z, U+00C0 to U+00FF, and all others dealt over the rest.
_KINDS = 128
_OTHERS = _KINDS - 26 - 64
_LEAF, _BY_HASH = -1, -2

#: Of a document's id: what the document makes of a word.
Change = Callable[[object], Callable[[str], str]]


def letter_counts(words: list[str]) -> np.ndarray:
    """One row for each word: how often it has each kind of letter."""
    text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    kind = 90 + text % _OTHERS
    kind = np.where((text >= 97) & (text <= 122), text - 97, kind)
    kind = np.where((text >= 0xC0) & (text <= 0xFF), text - 0xC0 + 26, kind)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * _KINDS + kind, minlength=len(words) * _KINDS)
    return counts.reshape(len(words), _KINDS).astype(np.int32)


def _hashes(words: list[str]) -> np.ndarray:
    """Bits that part words of equal counts: FNV-1a of their letters."""
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = 0xCBF29CE484222325
        for c in w:
            h = (h ^ ord(c)) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
        out[i] = h ^ h >> 29
    return out


class Trees:
    """k-d trees in one set of arrays: left holds counts up to the threshold, right those above."""

    def __init__(self) -> None:
        self.roots: dict[int, int] = {}
        self.kind, self.threshold, self.left, self.right = ([] for _ in range(4))
        #: Of a leaf, how many cuts by hash lie above it.
        self.by_hash: dict[int, int] = {}

    def leaf(self) -> int:
        for column, value in ((self.kind, _LEAF), (self.threshold, 0), (self.left, -1), (self.right, -1)):
            column.append(value)
        return len(self.kind) - 1

    def split(self, node: int, kind: int, threshold: int) -> tuple[int, int]:
        self.kind[node], self.threshold[node] = kind, threshold
        self.left[node], self.right[node] = self.leaf(), self.leaf()
        if node in self.by_hash:
            self.by_hash[self.left[node]] = self.by_hash[self.right[node]] = self.by_hash.pop(node)
        return self.left[node], self.right[node]

    def split_by_hash(self, node: int) -> tuple[int, int]:
        bit = self.by_hash.get(node, 0)
        low, high = self.split(node, _BY_HASH, bit % 64)
        self.by_hash[low] = self.by_hash[high] = bit + 1
        return low, high

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.asarray(c, np.int32) for c in (self.kind, self.threshold, self.left, self.right))

    def home(self, counts: np.ndarray, hashes: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The leaf below each ``node`` that holds a word."""
        kind, threshold, left, right = self.arrays()
        node = node.copy()
        open_ = np.flatnonzero(kind[node] != _LEAF) if len(node) else node
        while len(open_):
            at = node[open_]
            bit = (hashes[open_] >> threshold[at].astype(np.uint64)) & np.uint64(1)
            high = np.where(kind[at] == _BY_HASH, bit > 0, counts[open_, np.maximum(kind[at], 0)] > threshold[at])
            node[open_] = np.where(high, right[at], left[at])
            open_ = open_[kind[node[open_]] != _LEAF]
        return node

    def reach(self, counts: np.ndarray, query: np.ndarray, node: np.ndarray, up: np.ndarray, down: np.ndarray):
        """Leaves below ``node`` that a query's steps reach, with the steps it has left there.

        ``up``: may a word there have one letter more than the query; ``down``: one less.
        """
        kind, threshold, left, right = self.arrays()
        found = []
        while len(query):
            at_leaf = kind[node] == _LEAF
            found.append((query[at_leaf], node[at_leaf], up[at_leaf], down[at_leaf]))
            query, node, up, down = (x[~at_leaf] for x in (query, node, up, down))
            by_hash = kind[node] == _BY_HASH
            have, most = counts[query, np.maximum(kind[node], 0)], threshold[node]
            high = have > most
            near, far = np.where(high, right[node], left[node]), np.where(high, left[node], right[node])
            step = np.where(high, have - most, most + 1 - have) == 1
            crosses = by_hash | step & np.where(high, down, up)
            up2, down2 = up & (high | by_hash), down & (~high | by_hash)
            query = np.r_[query, query[crosses]]
            node = np.r_[near, far[crosses]]
            up, down = np.r_[up, up2[crosses]], np.r_[down, down2[crosses]]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (query, node, up, down)


def _best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """Kind of letter and threshold that part these words most evenly; None if all counts are equal."""
    some = counts[:: max(1, len(counts) // 1024)]
    best = (0.0, 0, 0)
    for threshold in range(3):
        low = (some <= threshold).mean(axis=0)
        even = np.minimum(low, 1 - low)
        kind = int(even.argmax())
        best = max(best, (float(even[kind]), kind, threshold))
    if best[0] > 0.05:
        return best[1:]
    low, high = counts.min(axis=0), counts.max(axis=0)
    kind = int((high - low).argmax())
    return (kind, int(low[kind] + high[kind]) // 2) if high[kind] > low[kind] else None


def _grow(trees: Trees, node: int, counts: np.ndarray, most: int, by_hash: bool) -> list[tuple[int, np.ndarray]]:
    """Split a leaf until no part has more than ``most`` rows; its leaves and the rows of each.

    Rows of equal counts stay together, or are cut ``by_hash``, which leaves open what goes where.
    """
    leaves, todo = [], [(node, np.arange(len(counts)))]
    while todo:
        node, rows = todo.pop()
        chosen = _best_split(counts[rows]) if len(rows) > most else None
        if chosen is not None:
            above = counts[rows, chosen[0]] > chosen[1]
            low, high = trees.split(node, *chosen)
            todo += [(low, rows[~above]), (high, rows[above])]
        elif by_hash and len(rows) > most:
            low, high = trees.split_by_hash(node)
            todo += [(low, rows[::2]), (high, rows[1::2])]
        else:
            leaves.append((node, rows))
    return leaves


def _presence(counts: np.ndarray) -> np.ndarray:
    """Which kinds of letters occur, two kinds to a bit: one letter more or less changes one bit at most."""
    bits = (counts[:, :64] > 0) | (counts[:, 64:] > 0)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ in one letter."""
    return (a != b).sum(axis=1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``b`` are those of ``a`` with one letter inserted: equal up to somewhere, and then shifted."""
    edge = np.ones((len(a), 1), bool)
    head = np.hstack([edge, np.logical_and.accumulate(a == b[:, :-1], axis=1)])
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return (head & np.hstack([tail, edge])).any(axis=1)


def near_pairs(words: list[str], points: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (query, point) of all words one letter apart, every word being a query with the steps it may take.

    ``points`` are the indexes of the words searched, which all have one length; a query has that length or
    one letter less.
    """
    targets = [words[i] for i in points]
    counts = letter_counts(targets)
    present, trees = _presence(counts), Trees()
    leaves = _grow(trees, trees.leaf(), counts, _BUCKET, by_hash=False)
    order = np.concatenate([rows for _, rows in leaves])
    first, size = np.zeros((2, len(trees.kind)), np.int64)
    size[[node for node, _ in leaves]] = [len(rows) for _, rows in leaves]
    first[[node for node, _ in leaves]] = np.cumsum([0, *(len(rows) for _, rows in leaves)])[:-1]
    length, found, there = len(targets[0]), [np.zeros((2, 0), np.int64)], _letters(targets)
    widths = np.array([len(w) for w in words])
    for wide, same in ((length, _replaced), (length - 1, _inserted)):
        queries = np.flatnonzero(widths == wide)
        for start in range(0, len(queries), _QUERIES):
            some = queries[start : start + _QUERIES]
            texts = [words[i] for i in some.tolist()]
            mine, here, at = letter_counts(texts), _letters(texts), np.arange(len(some))
            bits = _presence(mine)
            query, leaf, *_ = trees.reach(mine, at, np.zeros_like(at), up[some], down[some])
            until = np.cumsum(size[leaf])
            cuts = np.searchsorted(until, np.arange(_PAIRS, (until[-1] if len(until) else 0) + _PAIRS, _PAIRS))
            for lo, hi in zip([0, *(cuts[:-1] + 1)], cuts + 1):
                sizes = size[leaf[lo:hi]]
                q = np.repeat(query[lo:hi], sizes)
                p = order[np.repeat(first[leaf[lo:hi]] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(q))]
                # A letter more or less changes one bit at most: pairs too far apart in L1 go by that.
                close = np.bitwise_count(bits[q] ^ present[p]) <= 1 + (wide == length)
                q, p = q[close], p[close]
                step = max(1, _PAIRS * 4 // max(1, length))
                for k in range(0, len(q), step):
                    x, y = q[k : k + step], p[k : k + step]
                    keep = same(here[x], there[y])
                    found.append(np.stack([some[x[keep]], points[y[keep]]]))
    query, point = np.concatenate(found, axis=1)
    return query, point


def _plant(words: DataFrame) -> Trees:
    """The upper trees of all lengths that have more words than a leaf holds."""
    trees = Trees()
    sizes = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > LEAF_WORDS)
    over = {}
    for length, n in sizes.collect():  # at most one row for each LEAF_WORDS words, as below
        trees.roots[length] = trees.leaf()
        over[trees.roots[length]] = n
    while over:
        rate = min(_LEAST_SAMPLE * 8 / LEAF_WORDS, SAMPLE_WORDS / sum(over.values()))
        sample: dict[int, list[str]] = {node: [] for node in over}
        hashed = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(rate * (1 << 30))
        for node, word in _homes(words.where(hashed), trees, set(over)).collect():
            sample[node].append(word)
        for node, n in over.items():
            some = sorted(sample[node])
            most = max(_LEAST_SAMPLE, LEAF_WORDS * len(some) // n)
            if len(some) > most:
                _grow(trees, node, letter_counts(some), most, by_hash=True)
            else:  # too few to choose by
                trees.split_by_hash(node)
        sizes = _homes(words, trees).where("leaf >= 0").groupBy("leaf").count().where(F.col("count") > LEAF_WORDS)
        over = dict(map(tuple, sizes.collect()))
    return trees


def _homes(words: DataFrame, trees: Trees, only: set[int] | None = None) -> DataFrame:
    """(leaf, word) of the words in the leaves of ``only``; leaf -1 where a length has no tree."""
    shared = words.sparkSession.sparkContext.broadcast((trees, only))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, only = shared.value
        for batch in batches:
            some = batch.column("word").to_pylist()
            leaf = _home(trees, some, letter_counts(some))
            kept = np.isin(leaf, list(only)) if only is not None else np.ones(len(leaf), bool)
            yield pa.record_batch([pa.array(leaf[kept], pa.int32()), batch.column("word").filter(pa.array(kept))], names=["leaf", "word"])

    return words.select("word").mapInArrow(run, "leaf int, word string")


def _home(trees: Trees, words: list[str], counts: np.ndarray) -> np.ndarray:
    leaf = np.array([trees.roots.get(len(w), -1) for w in words], np.int64)
    inside = leaf >= 0
    hashes = _hashes(words) if trees.by_hash else np.zeros(len(words), np.uint64)
    leaf[inside] = trees.home(counts[inside], hashes[inside], leaf[inside])
    return leaf


def _routed(words: DataFrame, trees: Trees) -> DataFrame:
    """Every word at its home leaf and, as a query, at all leaves that its steps reach, of its own length and the next."""
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            some = batch.column("word").to_pylist()
            counts = letter_counts(some)
            home, all_ = _home(trees, some, counts), np.arange(len(some))
            for longer in (0, 1):
                length = np.array([len(w) for w in some], np.int64) + longer
                root = np.array([trees.roots.get(n, -1) for n in length.tolist()], np.int64)
                up, down = np.ones(len(some), bool), np.full(len(some), not longer)
                inside = root >= 0
                parts = trees.reach(counts, all_[inside], root[inside], up[inside], down[inside])
                outside = (all_[~inside], root[~inside], up[~inside], down[~inside])
                row, leaf, up, down = (np.concatenate(c) for c in zip(parts, outside))
                own = (leaf == home[row]) & (not longer)
                columns = [
                    pa.array(length[row], pa.int32()),
                    pa.array(leaf, pa.int32()),
                    pa.array(own),
                    pa.array(up),
                    pa.array(down),
                    batch.column("word").take(pa.array(row)),
                    batch.column("n").take(pa.array(row)),
                ]
                yield pa.record_batch(columns, names=["length", "leaf", "own", "up", "down", "word", "n"])

    return words.select("word", "n").mapInArrow(
        run, "length int, leaf int, own boolean, up boolean, down boolean, word string, n bigint"
    )


def _search(group: pa.Table) -> pa.Table:
    """For each word of a leaf or query that met one: number of near words found here, and the best of them."""
    words = group.column("word").to_pylist()
    n = group.column("n").to_numpy()
    own, up, down = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("own", "up", "down"))
    points = np.flatnonzero(own)
    if not len(points):
        return _NOTHING
    a, b = near_pairs(words, points, up, down)
    # Words of one length find each other from both sides; a shorter query is the longer word's only way.
    shorter = np.array([len(w) for w in words])[a] < len(words[points[0]])
    a, b = np.r_[a, b[shorter]], np.r_[b, a[shorter]]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    by = np.lexsort((rank[b], -n[b], a))
    word, first, count = np.unique(a[by], return_index=True, return_counts=True)
    best = b[by][first]
    columns = [
        pa.array([words[i] for i in word.tolist()], pa.string()),
        pa.array(count, pa.int64()),
        pa.array(n[best], pa.int64()),
        pa.array([words[i] for i in best.tolist()], pa.string()),
    ]
    return pa.table(columns, schema=_FOUND)


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
_NOTHING = _FOUND.empty_table()


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n and best (the near word of largest n, the smallest by code point) of all ``words``
    (word, n) that have a near word. ``words`` are distinct and read several times."""
    groups = _routed(words, _plant(words)).groupBy("length", "leaf")
    found = groups.applyInArrow(_search, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root of ``forms`` (word, form): where following forms ends.

    Each turn doubles the steps taken, and a form's n is ``RATIO`` times that of its word, so a few turns do.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        rows = now.select("word", "root").join(further, "root", "left")
        then = rows.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        then = written(then, "roots")
        drop(now)
        now = then
        if now.where("moved").isEmpty():
            return now.drop("moved")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of ``words`` (word, n).

    Two words are near if one letter (code point) inserted, deleted or replaced makes one of the other. A
    word's form is its near word of largest n, ties to the smallest by code point, if that n is ``ratio`` times
    the word's own at least; else null. Words of any letters and lengths take part; each is expected once.
    Without words there are no rows.
    """
    words = written(words.select("word", "n"), "words")
    near = words.join(near_words(words), "word", "left")
    enough = F.col("best_n") >= ratio * F.col("n")
    marked = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("best")).alias("form"),
        F.when(enough, F.col("best_n")).alias("form_n"),
    )
    marked = written(marked, "variants")
    ends = roots(marked.where("form IS NOT NULL"))
    return marked.join(ends, "word", "left").select("*", F.coalesce("root", "word").alias("end")).drop("root").withColumnRenamed("end", "root")


def count_words(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    change: Change | None = None,
) -> DataFrame:
    """word and n of the words of all whole texts of ``docs`` (doc_id, text) that are long and frequent enough.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; ``change`` makes of a document's id
    what makes another, not longer one of each of its words. A null or empty text has none. Repeated rows
    count each time, other columns are not read. Words are counted by batch before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, int] = {}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                # Bytes beyond ASCII are no part of A-Z, so lower-casing them as they are is right.
                text = (text.as_py() or b"").translate(_LOWER).decode("utf-8", "replace")
                words = Counter(_RUN.findall(text))
                alter = change(doc_id.as_py()) if change is not None else None
                for word, n in words.items():
                    if len(word) >= least_letters:
                        word = alter(word) if alter is not None else word
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= _HELD_WORDS:
                    yield _counted(counts, least_letters)
                    counts = {}
            if counts:
                yield _counted(counts, least_letters)

    found = docs.selectExpr("doc_id", "cast(text as binary) AS text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counted(counts: dict[str, int], least_letters: int) -> pa.RecordBatch:
    kept = {w: n for w, n in counts.items() if len(w) >= least_letters}
    return pa.record_batch([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])


_RUN = re.compile("[a-z\u00C0-\u00FF]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Words that a task counts before it sends them on.
_HELD_WORDS = 500_000
