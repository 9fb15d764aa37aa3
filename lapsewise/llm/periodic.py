"""Periodic runs of words, by uniting suffix classes in descending order of common prefixes.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends
and that repeats its period ``FOLDS`` times at least. For each text:

1. Words are numbered, suffixes are sorted (prefix doubling, only undecided ones again), and the
   common prefix lengths of neighbours in that order follow from the irreducible ones.
2. Neighbours are united in descending order of that length (Kruskal). A class is a sorted list of
   positions; the smaller is inserted into the larger. Where positions i < j of both become
   neighbours while length h is at hand, the suffixes at i and j have exactly h words in common: with
   d = j - i, the words [i, j + h) have period d. Were d not the smallest, a position between
   i and j would already be in the class. So the pair seeds a run if h >= (FOLDS - 1) * d, and it is
   the run's leftmost pair, which gives each run once, if the words before i and j differ.
3. Uniting stops below the least h that can seed a run. Texts in which no so long sequence of words
   occurs twice, most of them, skip all of this.

Texts stay where they are: no shuffle, and a task holds one batch. Work is n log n for a text of n
words, whatever its repeats are like.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A run has so many words, and its period so many times, at least.
LEAST_WORDS = 6
FOLDS = 4
#: Bytes of collapsed text sent back at a time.
SEND_BYTES = 8 << 20

Run = tuple[int, int, int]
#: Of a document's id and number of words: which of its words to take instead, in order (None: all).
Pick = Callable[[object, int], "np.ndarray | None"]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(index.__getitem__, words), np.int64, len(words))


def _repeats(ids: np.ndarray, width: int) -> bool:
    """May some ``width`` consecutive words occur twice? Never False if they do."""
    n = len(ids) - width + 1
    if n < 2:
        return False
    key = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k : n + k].astype(np.uint64) + np.uint64(1)
    key.sort()
    return bool((key[1:] == key[:-1]).any())


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes, sorted, a shorter one before those that it begins."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank, slots, width = np.empty(n, np.int64), np.arange(n), 0
    key = ids[order]
    while True:
        # Slots of equal keys are a class; its rank is its first slot, which no refinement moves.
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[first, len(key)])
        rank[order[slots]] = np.repeat(slots[first], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots):
            return order
        width = 2 * width or 1
        at = order[slots]
        behind = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + behind
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]


def _common(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at each a and b (a != b)."""
    n, out = len(ids), np.zeros(len(a), np.int64)
    open_, step = np.arange(len(a)), 0
    while len(open_) and step < 16:
        x, y = a[open_] + step, b[open_] + step
        inside = np.maximum(x, y) < n
        same = inside & (ids[np.minimum(x, n - 1)] == ids[np.minimum(y, n - 1)])
        open_, step = open_[same], step + 1
        out[open_] = step
    for k in open_.tolist():
        x, y, chunk = int(a[k]), int(b[k]), 64
        h, most = step, n - max(x, y)
        while h < most:
            until = min(h + chunk, most)
            off = np.flatnonzero(ids[x + h : x + until] != ids[y + h : y + until])
            if len(off):
                h += int(off[0])
                break
            h, chunk = until, chunk * 4
        out[k] = h
    return out


def common_prefixes(ids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each slot of the suffix order: how many words it has in common with the slot before.

    In text order, a suffix and its neighbour that follow equal words share one word less than
    these did. The others are compared; their lengths add up to n log n at most.
    """
    n = len(ids)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    plain = (here == 0) | (before <= 0)
    plain |= ids[here - 1] != ids[np.maximum(before, 1) - 1]
    start = np.flatnonzero(plain)
    # A suffix without neighbour shares nothing; comparing it with itself is avoided.
    shared = np.zeros(len(start), np.int64)
    some = before[start] >= 0
    shared[some] = _common(ids, start[some], before[start[some]])
    ends = np.full(n, 0, np.int64)
    ends[start] = shared + start
    last = np.maximum.accumulate(np.where(plain, here, 0))
    return (ends[last] - here)[order]


def periodic_runs(ids: np.ndarray, least: int = LEAST_WORDS, folds: int = FOLDS) -> list[Run]:
    """(start, length, period) of every run, by start and then period."""
    if folds < 3:
        raise ValueError("a class's neighbours are shown to seed all runs for three folds or more")
    # Common words of a run's leftmost pair: length - period.
    floor = min(max(least, folds * d) - d for d in range(1, max(2, least + 1)))
    if not _repeats(ids, floor):
        return []
    order = suffix_order(ids)
    height = common_prefixes(ids, order)
    slots = np.flatnonzero(height >= floor)
    slots = slots[np.argsort(-height[slots], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, list[int]] = {}
    found: list[Run] = []

    def root(slot: int) -> int:
        top = slot
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(slot, slot) != top:
            parent[slot], slot = top, parent[slot]
        return top

    def seed(i: int, j: int, h: int) -> None:
        d = j - i
        if (folds - 1) * d <= h and d + h >= least and (i == 0 or ids[i - 1] != ids[j - 1]):
            found.append((i, d + h, d))

    for slot, h in zip(slots.tolist(), height[slots].tolist(), strict=True):
        a, b = root(slot - 1), root(slot)
        large = classes.pop(a, None) or [int(order[a])]
        small = classes.pop(b, None) or [int(order[b])]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[a] = parent[b] = a
        classes[a] = large
        for x in small:
            large.insert(bisect_left(large, x), x)
        mine = set(small)
        for x in small:
            at = bisect_left(large, x)
            if at and large[at - 1] not in mine:
                seed(large[at - 1], x, h)
            if at + 1 < len(large) and large[at + 1] not in mine:
                seed(x, large[at + 1], h)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_words(n: int, runs: list[Run]) -> np.ndarray:
    """Of each of n words: does a run contain it behind that run's first period?"""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) > 0


def mark_runs(docs: DataFrame, least: int = LEAST_WORDS, folds: int = FOLDS, pick: Pick | None = None) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period, by start, then period), ``n_words`` and ``collapsed``,
    the words that no run repeats, joined by one space; one row for each row of ``docs``.

    Words are runs of bytes other than space and 0x09-0x0D. A null, empty or blank text has no words, no runs
    and collapses to an empty text. Repeated rows and null ids are handled row by row, an empty table gives
    an empty one, and columns other than doc_id and text are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                words = (text.as_py() or b"").split()
                ids, doc_id = numbered(words), doc_id.as_py()
                if pick is not None and (taken := pick(doc_id, len(words))) is not None:
                    ids, words = ids[taken], [words[i] for i in taken.tolist()]
                runs = periodic_runs(ids, least, folds)
                n = len(words)
                if runs:
                    words = [words[i] for i in np.flatnonzero(~repeated_words(n, runs)).tolist()]
                rows.append((doc_id, [dict(zip(_RUN, r, strict=True)) for r in runs], n, b" ".join(words)))
                held += len(rows[-1][3])
                if held >= SEND_BYTES:
                    yield _batch(rows, batch.schema.field("doc_id").type)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, batch.schema.field("doc_id").type)

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.selectExpr("doc_id", "cast(text as binary) AS text").mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, n_words bigint, collapsed binary"
    )
    return found.withColumn("collapsed", found["collapsed"].cast("string"))


_RUN = ("start", "length", "period")
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in _RUN]))


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, (id_type, _RUNS, pa.int64(), pa.binary()), strict=True)]
    return pa.record_batch(arrays, names=["doc_id", "runs", "n_words", "collapsed"])
