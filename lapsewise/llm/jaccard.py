"""N-gram Jaccard join: which documents share most of their word shingles.

A document's set is its distinct five-word shingles. Shingles have one global order, the rarest
first (document frequency, then hash), and that order is cut into vertical fragments by hash:
every fragment counts for itself.

1. Documents are hashed once, some megabytes at a time, and a batch sends each fragment its part of
   their sets, packed. A fragment thereby knows in how many documents each of its shingles occurs,
   and returns to each batch those that others have too. Most shingles occur once; they stay behind.
2. Two sets with a Jaccard index of at least t must share one of the first n - ceil(t * n) + 1
   shingles in the global order (of n). Documents whose first shingles are all their own are done.
   The others' first shared shingles are the keys by which candidates meet.
3. Candidates are compared by their partial overlaps: for each pair and fragment, the number of
   shared shingles there; a pair's sum is its overlap.

Documents with equal sets are one class from the start, known by a digest of the set; classes are
what fragments count and what is compared. Inside a group of classes with a common key, ``components.link`` compares members with leaders before it
lists pairs, and lists only pairs that are not yet connected: no link between components is
lost, and no group is spelled out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm import words
from lapsewise.llm.components import link
from lapsewise.llm.store import written

THRESHOLD_PERCENT = 80
#: Shingles in a fragment, about: 5 MB.
FRAGMENT_SHINGLES = 1_000_000
#: Bytes of a shingle's hash within its fragment.
_HASH_BYTES = 5
#: Texts that a worker has as strings at a time, and bytes of text whose sets travel together, about.
_TEXTS, _SPLIT_BYTES = 512, 8 * words.BATCH_BYTES
_RARITY_STEP = 8.0
#: A class's mark has so many words of 64 bits: sets of some hundred shingles are told apart by them.
_MARK_WORDS = 4
_WORDS = [f"w{i}" for i in range(_MARK_WORDS)]


def _packed(hashes: np.ndarray) -> np.ndarray:
    """The lower five bytes of each hash, one row each."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES])


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, _HASH_BYTES)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :_HASH_BYTES] = raw
    return out.view("<u8").reshape(-1)


def _repeats(hashes: np.ndarray) -> np.ndarray:
    """How often each hash is among them; half the memory of ``np.unique`` with its inverse."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    del ranked
    sizes = np.diff(np.append(starts, len(hashes))).astype(np.int32)
    out = np.empty(len(hashes), dtype=np.int32)
    out[order] = np.repeat(sizes, sizes)
    return out


def _set_digest(unique: np.ndarray) -> int:
    """A 64-bit digest of a set of hashes: its mixed sum."""
    return int(words.mix(unique ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)) if len(unique) else 0


def split_sets(docs: DataFrame, fragments: int, width: int = words.WIDTH) -> DataFrame:
    """Each batch's sets by fragment, packed: classes, sizes there and hashes; and, in one of a
    batch's fragments, each document's id, size and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, sets in _sets(batch, width):
                yield _split(no, ids, sets, fragments)
                no += 1

    schema = "batch bigint, fragment int, classes binary, counts binary, hashes binary, sizes binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and sets of the documents of a batch, those of some 8 MB of text at a time; few texts are strings at once."""
    ids, sets, size = [], [], 0
    for start in range(0, batch.num_rows, _TEXTS):
        rows = batch.slice(start, _TEXTS)
        texts = rows.column("text").to_pylist()
        for part in words.batches(texts):
            ids += rows.column("doc_id").slice(part.start, part.stop - part.start).to_pylist()
            sets += map(np.unique, words.shingle_lists(texts[part], width))
            size += sum(len(t or "") + 1 for t in texts[part])
            if size >= _SPLIT_BYTES:
                yield ids, sets
                ids, sets, size = [], [], 0
    if ids:
        yield ids, sets


def _split(no: int, ids: list, sets: list[np.ndarray], fragments: int) -> pa.RecordBatch:
    """One batch of ``split_sets``; the list of sets is emptied, so that they are held once."""
    lengths = np.array([len(u) for u in sets], dtype=np.int64)
    digests = np.array([_set_digest(u) for u in sets], dtype=np.int64)
    _, first = np.unique(digests, return_index=True)
    first = np.sort(first[lengths[first] > 0])
    flat = np.concatenate([sets[i] for i in first]) if len(first) else np.zeros(0, np.uint64)
    sets.clear()
    owner = np.repeat(first.astype(np.int32), lengths[first])
    # Higher bits choose the fragment, the lowest five bytes name the shingle in it.
    fragment = ((flat >> np.uint64(40)) % np.uint64(fragments)).astype(np.int32)
    order = np.argsort(fragment, kind="stable")
    flat, owner = flat[order], owner[order]
    fragment = fragment[order]
    del order
    sizes = np.stack([np.array(ids, dtype=np.int64), lengths, digests], axis=1).tobytes()
    rows = []
    present = np.unique(fragment) if len(fragment) else np.array([no % fragments])
    home = present[no % len(present)]
    for f, a, b in zip(present.tolist(), np.searchsorted(fragment, present), np.searchsorted(fragment, present, "right"), strict=True):
        who, counts = np.unique(owner[a:b], return_counts=True)
        blobs = (digests[who], counts.astype("<u4"), _packed(flat[a:b]))
        rows.append((no, f, *(x.tobytes() for x in blobs), sizes if f == home else b""))
    return _table(rows, _SPLIT).to_batches()[0]


_SPLIT = pa.schema(
    [("batch", pa.int64()), ("fragment", pa.int32()), *((c, pa.binary()) for c in ("classes", "counts", "hashes", "sizes"))]
)
_COUNTED = _SPLIT.append(pa.field("rarity", pa.binary()))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _joined(group: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(group[column].to_pylist()), kind)


def shared_parts(split: DataFrame, percent: int) -> DataFrame:
    """Each document's id, size and class; and the shared shingles of each class that can link.

    A fragment counts the classes that have a shingle and returns to each batch, in one row, which
    of its shingles others have, with a rarity (a number that grows with that count). Batches put
    their classes together: rows of the second kind have fragments (places), hashes and rarity.
    There are as many rows as documents and classes, however many fragments there are.
    """

    def count(group: pa.Table) -> pa.Table:
        # Copies met in several batches are one class: that of the first batch, in every fragment.
        group = group.sort_by("batch")
        f = group["fragment"][0].as_py()
        classes, counts = _joined(group, "classes", np.int64), _joined(group, "counts", "<u4")
        hashes = _unpacked(b"".join(group["hashes"].to_pylist()))
        place = np.repeat(np.arange(len(group)), [len(c) // 8 for c in group["classes"].to_pylist()])
        chosen = np.zeros(len(classes), dtype=bool)
        chosen[np.unique(classes, return_index=True)[1]] = True
        hashes = hashes[np.repeat(chosen, counts)]
        owner = np.repeat(np.flatnonzero(chosen), counts[chosen])
        df = _repeats(hashes)
        keep = np.flatnonzero(df > 1)
        rarity = np.minimum(255, np.round(_RARITY_STEP * np.log2(df[keep]))).astype(np.uint8)
        who, kept = np.unique(owner[keep], return_counts=True)
        raw, ends = _packed(hashes[keep]), np.cumsum(kept)
        edges = np.searchsorted(place[who], np.arange(len(group) + 1))
        at = np.append(0, ends)[edges]
        rows = []
        for i, (no, sizes) in enumerate(zip(group["batch"].to_pylist(), group["sizes"].to_pylist(), strict=True)):
            if edges[i] < edges[i + 1] or sizes:
                mine, here = slice(edges[i], edges[i + 1]), slice(at[i], at[i + 1])
                blobs = (classes[who[mine]], kept[mine].astype("<u4"), raw[here])
                rows.append((no, f, *(x.tobytes() for x in blobs), sizes, rarity[here].tobytes()))
        return _table(rows, _COUNTED)

    def put_together(group: pa.Table) -> pa.Table:
        docs = _joined(group, "sizes", np.int64).reshape(-1, 3)
        group = group.sort_by("fragment")
        classes, counts = _joined(group, "classes", np.int64), _joined(group, "counts", "<u4").astype(np.int64)
        held = [len(c) // 8 for c in group["classes"].to_pylist()]
        fragment = np.repeat(group["fragment"].to_numpy(), held)
        raw = _joined(group, "hashes", np.uint8).reshape(-1, _HASH_BYTES)
        rarity = _joined(group, "rarity", np.uint8)
        # Segments of a class one behind the other, by fragment.
        order = np.argsort(classes, kind="stable")
        sizes = counts[order]
        ends = np.cumsum(sizes)
        moved = np.repeat((np.cumsum(counts) - counts)[order] - ends + sizes, sizes) + np.arange(len(raw))
        raw, rarity = raw[moved], rarity[moved]
        places = np.stack([fragment[order], sizes], axis=1).astype("<u4")
        who, starts = np.unique(classes[order], return_index=True)
        stops = np.append(starts, len(classes))[1:]
        known, first = np.unique(docs[:, 2], return_index=True)
        n = docs[first, 1][np.searchsorted(known, who)]
        edges = np.append(0, ends)
        rows = [(c, i, m, None, None, None) for i, m, c in docs.tolist()]
        for c, m, a, b in zip(who.tolist(), n.tolist(), starts.tolist(), stops.tolist(), strict=True):
            x, y = edges[a], edges[b]
            if m - (y - x) < _first(m, percent):
                rows.append((c, None, m, places[a:b].tobytes(), raw[x:y].tobytes(), rarity[x:y].tobytes()))
        return _table(rows, _PARTS)

    counted = ", ".join(f"{f.name} {_SQL[f.type]}" for f in _COUNTED)
    parts = ", ".join(f"{f.name} {_SQL[f.type]}" for f in _PARTS)
    return split.groupBy("fragment").applyInArrow(count, counted).groupBy("batch").applyInArrow(put_together, parts)


_PARTS = pa.schema(
    [*((c, pa.int64()) for c in ("class", "doc_id", "n")), *((c, pa.binary()) for c in ("fragments", "hashes", "rarity"))]
)
_SQL = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}


def _first(n: int, percent: int) -> int:
    """How many of the first of n shingles a similar set must share one of."""
    return n - -(-percent * n // 100) + 1


def _whole(fragments: bytes, hashes: bytes) -> np.ndarray:
    """A class's shared shingles, each named by its fragment and its hash there."""
    places = np.frombuffer(fragments, dtype="<u4").reshape(-1, 2)
    return (np.repeat(places[:, 0], places[:, 1]).astype(np.uint64) << np.uint64(8 * _HASH_BYTES)) | _unpacked(hashes)


def _parity(names: np.ndarray) -> np.ndarray:
    """Of a set's hashes, dealt to as many places as there are bits, whether each place has an odd number."""
    places = (words.mix(names) % np.uint64(64 * _MARK_WORDS)).astype(np.int64)
    odd = np.bincount(places, minlength=64 * _MARK_WORDS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def candidate_keys(sets: DataFrame, percent: int) -> DataFrame:
    """key, id, rank and mark of classes: the shared ones among their first shingles.

    A class ranks first that has most of what others have: what they were copied from. The mark
    holds its size, how many of its shingles others have, and the parity of those.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ranks, marks, sizes = [np.zeros(0, np.int64)], [], [], []
            for row in batch.to_pylist():
                names = _whole(row["fragments"], row["hashes"])
                own = row["n"] - len(names)
                rarity = np.frombuffer(row["rarity"], np.uint8)
                order = np.lexsort((names, rarity))[: _first(row["n"], percent) - own]
                keys.append(words.mix(names[order]).view(np.int64))
                ranks.append(-float(rarity.sum(dtype=np.int64)))
                marks.append(np.concatenate([[row["n"], len(names)], _parity(names)]))
                sizes.append(len(order))
            at = np.repeat(np.arange(len(sizes)), sizes)
            mark = np.array(marks, dtype=np.int64).reshape(-1, 2 + _MARK_WORDS)[at]
            columns = [pa.array(c) for c in mark.T.copy()]
            yield pa.record_batch(
                [
                    pa.array(np.concatenate(keys)),
                    batch.column("id").take(pa.array(at)),
                    pa.array(np.array(ranks, dtype=np.float64)[at]),
                    pa.StructArray.from_arrays(columns, ["n", "s", *_WORDS]),
                ],
                names=["key", "id", "rank", "mark"],
            )

    mark = ", ".join(f"{c}: bigint" for c in ("n", "s", *_WORDS))
    return sets.mapInArrow(run, f"key bigint, id bigint, rank double, mark struct<{mark}>")


def _can_link(percent: int):
    """Whether two classes can link by their sizes, by how much of them others have, and by parities.

    Shingles that no other class has lie outside the overlap, and so does at least one for each place whose parities differ.
    """

    def alike(a: Column, b: Column) -> Column:
        sizes = 100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])
        shared = (100 + percent) * F.least(a["s"], b["s"]) >= percent * (a["n"] + b["n"])
        apart = a["n"] - a["s"] + b["n"] - b["s"]
        for c in _WORDS:
            apart = apart + F.bit_count(a[c].bitwiseXOR(b[c]))
        return sizes & shared & ((100 + percent) * (a["n"] + b["n"] - apart) >= 2 * percent * (a["n"] + b["n"]))

    return alike


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by partial overlaps: found fragment by fragment, and summed for each pair.

    Sizes say first which pairs cannot link. Where the number of ``common`` first shingles is known,
    it does too: what two sets share beyond the first shingles of the one whose first shingles end
    earlier lies among that one's other ceil(t * n) - 1.
    """
    size_a, size_b = (sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    set_a, set_b = (sets.select(F.col("id").alias(x), F.col("fragments").alias(f"f_{x}"), F.col("hashes").alias(f"h_{x}")) for x in "ab")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    possible = pairs.join(size_a, "a").join(size_b, "b").where(100 * small >= percent * large)
    if "common" in pairs.columns:
        beyond = F.ceil(F.lit(percent) * large / 100) - 1
        possible = possible.where((100 + percent) * (F.col("common") + beyond) >= percent * (small + large))
    possible = possible.select("a", "b", "n_a", "n_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            columns = [batch.column(c) for c in ("n_a", "n_b", "f_a", "h_a", "f_b", "h_b")]
            for i in range(batch.num_rows):
                n_a, n_b, f_a, h_a, f_b, h_b = (c[i].as_py() for c in columns)
                overlap = len(np.intersect1d(_whole(f_a, h_a), _whole(f_b, h_b), assume_unique=True))
                keep[i] = 100 * overlap >= percent * (n_a + n_b - overlap)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return possible.join(set_a, "a").join(set_b, "b").mapInArrow(run, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, percent: int = THRESHOLD_PERCENT, width: int = words.WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id it is linked with) of each document.

    Two documents link when 100 * intersection >= ``percent`` * union of their shingle sets. A
    document without words or text has no shingles and links with nothing: it is its own
    component. With fewer words than ``width``, all are one shingle. Rows with the same doc_id
    come back as often as they are there; each is linked by its own text, under that one id. Rows
    without a doc_id are left out. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(16, length // 7 // FRAGMENT_SHINGLES)
    parts = written(shared_parts(split_sets(texts, fragments, width), percent), "shared-shingles")
    sizes = parts.where("fragments IS NULL").select("doc_id", "n", "class")
    sets = parts.where("fragments IS NOT NULL").select(F.col("class").alias("id"), "n", "fragments", "hashes", "rarity")
    labels = link(
        candidate_keys(sets, percent), lambda pairs: _overlaps(pairs, sets, percent), alike=_can_link(percent)
    )
    placed = sizes.join(labels.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "group", F.when(F.col("n") > 0, F.coalesce("component", "class"))
    )
    smallest = placed.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return placed.join(smallest, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One document of each component: the one with the smallest doc_id. All columns stay."""
    found = jaccard_components(docs, percent)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
