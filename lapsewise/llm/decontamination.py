"""Benchmark decontamination: short test items found inside documents of any length.

Test items are partitioned by size (their number of shingles). An item's sketch is its shingles
with the smallest MinHash values, and a partition's sketch size follows from its sizes: of n
shingles, at most floor((1 - threshold) * n) may be missing from a document that contains the
item, so one more than that many sketch shingles cannot all be missing. Documents are not
sketched at all: each of their shingles is looked up in the sorted sketches, which finds every
containing document whatever its length, and each hit is then verified by counting how many of
the item's shingles the document really has.

A shingle is five words (``words``); an item of fewer words is one shingle of its own length and is
looked for among word sequences of that length. Items are read in blocks of about
``BLOCK_SHINGLES`` shingles, so what is sent to the tasks is bounded whatever the benchmark's size;
documents are read once for each block and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm import words

BLOCK_SHINGLES = 1 << 20
THRESHOLD = 0.8


@dataclass
class _Partition:
    """Items of one shingle width whose sizes have the same binary length."""

    width: int
    items: np.ndarray  # place of each item in the block
    sketch: np.ndarray  # sorted sketch shingles, one row for each item that has it
    owner: np.ndarray  # the item (its place here) of each
    sets: list[np.ndarray]  # all shingles of each item


@dataclass
class ItemIndex:
    ids: list[int]
    threshold: float
    partitions: list[_Partition]

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shingles of the item, how many of them the text has) above the threshold."""
        for part in words.batches(texts):
            hashes, first = words.word_hashes(texts[part])
            for p in self.partitions:
                yield from self._found(p, hashes, first, part.start)

    def _found(self, p: _Partition, hashes, first, offset):
        lists = [words.shingles(hashes[a:b], p.width) if b - a >= p.width else hashes[:0] for a, b in zip(first[:-1], first[1:], strict=True)]
        flat = np.concatenate(lists)
        low = np.searchsorted(p.sketch, flat)
        hit = np.flatnonzero(p.sketch[np.minimum(low, len(p.sketch) - 1)] == flat)
        if not len(hit):
            return
        ends = np.cumsum([len(x) for x in lists])
        text = np.searchsorted(ends, hit, side="right")
        found = set()
        for t, h in set(zip(text.tolist(), flat[hit].tolist(), strict=True)):
            a, b = np.searchsorted(p.sketch, np.uint64(h), "left"), np.searchsorted(p.sketch, np.uint64(h), "right")
            found.update((t, i) for i in p.owner[a:b].tolist())
        have: dict[int, np.ndarray] = {}
        for t, i in sorted(found):
            if t not in have:
                have = {t: np.unique(lists[t])}
            n = len(p.sets[i])
            shared = int(np.isin(p.sets[i], have[t], assume_unique=True).sum())
            if shared >= self.threshold * n - 1e-9:
                yield offset + t, int(p.items[i]), n, shared


def build_index(items: list[tuple[int, str]], threshold: float = THRESHOLD, width: int = words.WIDTH) -> ItemIndex:
    hashes, first = words.word_hashes([t for _, t in items])
    groups: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if a < b:
            own = np.unique(words.shingles(hashes[a:b], width))
            groups.setdefault((min(width, b - a), len(own).bit_length()), []).append((i, own))
    partitions = []
    for (wide, bits), members in sorted(groups.items()):
        size = int((1 - threshold) * ((1 << bits) - 1) + 1e-9) + 1
        keys, owner = [], []
        for place, (_, own) in enumerate(members):
            least = own[np.argsort(words.mix(own), kind="stable")[:size]]
            keys.append(least)
            owner.append(np.full(len(least), place))
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        partitions.append(
            _Partition(wide, np.array([i for i, _ in members]), keys[order], owner[order], [own for _, own in members])
        )
    return ItemIndex([i for i, _ in items], threshold, partitions)


def _indexes(benchmark: DataFrame, threshold: float) -> Iterator[ItemIndex]:
    """An index for each block of items; equal rows count once."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    length = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + length // (4 * BLOCK_SHINGLES)
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = build_index([(r.item_id, r.text) for r in mine.orderBy("item_id", "text").toLocalIterator()], threshold)
        if index.partitions:
            yield index


def find_contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared and containment of each match.

    Null or empty texts on either side match nothing. A repeated document row gives its matches
    each time, a repeated item once. No rows on a side, no matches. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, n_shingles bigint, n_shared bigint"

    def search(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = list(index.value.matches(batch.column("text").to_pylist()))
                text, item, n, shared = zip(*got, strict=True) if got else ((), (), (), ())
                ids = [index.value.ids[i] for i in item]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").take(pa.array(text, pa.int64())),
                        *(pa.array(x, pa.int64()) for x in (ids, n, shared)),
                    ],
                    names=["doc_id", "item_id", "n_shingles", "n_shared"],
                )

        return run

    found = [
        docs.select("doc_id", "text").mapInArrow(search(spark.sparkContext.broadcast(index)), schema)
        for index in _indexes(benchmark, threshold)
    ]
    rows = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)
    return rows.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    spark = docs.sparkSession

    def clean(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[t for t, *_ in index.value.matches(batch.column("text").to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        return run

    for index in _indexes(benchmark, threshold):
        docs = docs.mapInArrow(clean(spark.sparkContext.broadcast(index)), docs.schema)
    return docs
