"""Line dedup: lines that are the same up to small edits stay once.

A line's normal form is lower case, every digit a 0, and one space for each run of anything else
than letters and digits. Every line takes part whose normal form is not empty, however short. Two
normal forms are linked if their edit similarity, 1 - Levenshtein distance / longer
length, is at least ``SIMILARITY``. Of each connected group the first occurrence stays, in the
order of document id and line number.

Edit similarity alone decides; which pairs it is asked for is a search by MinHash, which may miss
some (the README names its recall):

* Equal normal forms are one from the start: occurrences are combined by hash before any shuffle.
* A line's words, each weighing its length, make ``_HASHES`` weighted MinHashes; a fifth of the
  characters in changed words leaves two thirds of the weight in common. Lines that are short or
  have few spaces make as many from their pairs of characters too: there one edit may leave no
  word as it was.
* Every three hashes are a key, so each such family gives ``_BANDS`` keys; they travel as packed
  bytes with a sketch of two bits of every hash, and only what has a neighbour of fitting length
  and sketch under the same key goes on.
* Every pair that shares a key, and whose lengths and sketches fit, is compared (``edits.within``) once, where
  the first key that both have lies, unless what was found there before connects it. Lines travel there only
  with keys that are the first common one of some pair.
* Normal forms are made of batches of texts in numpy, by a table of what Spark makes of each code
  point; documents are read twice (and once more to count lines): once for the keys, once for the lines, which are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import edits, words
from lapsewise.llm.components import components
from lapsewise.llm.store import written

SIMILARITY = 0.8
_HASHES = 64
_ROWS = 3
_BANDS = 16
#: Hashes whose two bits differ, at most: with half of the weight in common it is 24 on average,
#: with next to nothing 47.
_APART = 32
#: Lines of fewer characters, or of more for each word, have keys by pairs of characters too.
_SHORT = 48
_LONG_WORDS = 12
_ODD = np.random.default_rng(7).integers(0, 1 << 62, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Texts that a worker has as strings at a time.
_TEXTS = 512
#: Ids that a task remembers, so as to pack a line once.
_MET = 300_000
_KIND = np.uint64(5)
_EVEN_BITS = 0x5555555555555555
#: A packed key: key, id, sketch and length.
_ENTRY = np.dtype([("key", "<u8"), ("id", "<i8"), ("s0", "<u8"), ("s1", "<u8"), ("n", "<u4")])
_MARK = "struct<n:int,s0:bigint,s1:bigint>"
#: Keys in a fragment, about: 9 MB, of which a task holds some copies.
_FRAGMENT_KEYS = 250_000
#: Bytes of lines and their keys that are compared in one fragment, about, and pairs that are compared at a time.
_FRAGMENT_BYTES = 3_000_000
#: Bytes of a line's mark and all its keys, about, which travel with each of them.
_KEYED_BYTES = 200
_PAIRS = 2_000
#: Pairs whose distances are computed at a time: those that are not found to be near with little work.
_LATE = 20_000
#: Times that they are asked of one pair of each line before they are asked of all that are left.
_TURNS = 2


def normal_form(line: Column) -> Column:
    return _plain(F.lower(line))


def _plain(lower: Column) -> Column:
    spaced = F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " ")
    return F.trim(F.regexp_replace(spaced, r"\p{Nd}", "0"))


@functools.lru_cache(maxsize=4)
def _kept_points(spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    """The code points that a normal form keeps, and those that it makes a 0, as Spark has them."""
    points = spark.range(0x110000).where("id < 55296 OR id > 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    made = points.select("id", _plain(char).alias("norm")).where("norm <> ''").select("id", (F.col("norm") == "0").alias("zero")).toArrow()
    kept, zero = made["id"].to_numpy(), made["zero"].to_numpy()
    return kept[~zero].astype(np.int32), kept[zero].astype(np.int32)


def _classes(kept: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """What becomes of each code point of a text in lower case: itself, a 0, a space, or the end of a line."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    out[kept], out[zero], out[10] = kept, 48, 10
    return out


def normal_forms(texts: list[str], classes: np.ndarray) -> list[str]:
    """The normal forms of all lines of some texts in lower case, one after the other."""
    points = classes[np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    gap = points <= 32
    # One space for each run, none at the beginning of a line, and then none at its end.
    points = points[~((points == 32) & np.append(True, gap[:-1]))]
    points = points[~((points == 32) & np.append(points[1:] == 10, True))]
    return points.tobytes().decode("utf-32-le", "surrogatepass").split("\n")[:-1]


def _readings(docs: DataFrame) -> tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[tuple]]]:
    """doc_id, row (a hash of the whole text) and the text in lower case of the documents that have one, and a
    function that yields of a batch of them lists of documents (their place in the batch), line numbers and normal forms."""
    kept, zero = _kept_points(docs.sparkSession)
    table: list[np.ndarray] = []

    def lines(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
        if not table:
            table.append(_classes(kept, zero))
        for start in range(0, batch.num_rows, _TEXTS):
            texts = batch.column("text").slice(start, _TEXTS).to_pylist()
            for part in words.batches(texts, 1 << 19):
                some = texts[part]
                norms = normal_forms(some, table[0])
                counts = np.array([t.count("\n") + 1 for t in some])
                number = np.arange(len(norms)) - np.repeat(np.cumsum(counts) - counts, counts)
                taken = np.array([i for i, norm in enumerate(norms) if norm], dtype=np.int64)
                owner = np.repeat(np.arange(start + part.start, start + part.stop), counts)
                yield owner[taken], number[taken], [norms[i] for i in taken.tolist()]

    rows = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), F.lower("text").alias("text"))
    return rows, lines


def _ids(norms: list[str]) -> np.ndarray:
    """A hash of each normal form."""
    hashes = b"".join(blake2b(n.encode("utf-8", "surrogatepass"), digest_size=8).digest() for n in norms)
    return np.frombuffer(hashes, dtype="<i8")


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the whole text), line (from 0), norm and id (its hash) of the lines that take part."""
    rows, lines = _readings(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, number, norms in lines(batch):
                doc = [batch.column(c).take(pa.array(owner)) for c in ("doc_id", "row")]
                made = [pa.array(number, pa.int32()), pa.array(norms, pa.string()), pa.array(_ids(norms))]
                yield pa.record_batch([*doc, *made], names=["doc_id", "row", "line", "norm", "id"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, line int, norm string, id bigint")


def _min_hashes(features: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The weighted MinHashes of sets laid end to end, none of them empty; a row for each set."""
    out = np.empty((_HASHES, len(first)), dtype=np.float32)
    share = (1 / weights).astype(np.float32)
    product, drawn = np.empty(len(features), dtype=np.uint64), np.empty(len(features), dtype=np.float32)
    high = product.view(np.uint32)[1::2]
    whole = np.empty(len(features), dtype=np.uint32)
    for k, odd in enumerate(_ODD):
        np.multiply(features, odd, out=product)
        np.right_shift(high, np.uint32(8), out=whole)
        np.copyto(drawn, whole.view(np.int32), casting="unsafe")
        drawn += np.float32(0.5)
        drawn *= share
        np.minimum.reduceat(drawn, first, out=out[k])
    return np.ascontiguousarray(out.T).view(np.uint32)


def by_words(norms: list[str]) -> np.ndarray:
    """MinHashes of the words of normal forms that are not empty, each word weighing its length."""
    hashes, first = words.word_hashes(norms)
    lengths = np.fromiter((len(w) for n in norms for w in n.split(" ")), dtype=np.float64, count=len(hashes))
    return _min_hashes(hashes, lengths, first[:-1])


def by_characters(norms: list[str]) -> np.ndarray:
    """MinHashes of the pairs of neighbouring characters, the edges of the line among them."""
    coded = "".join(f"\n{n}\n" for n in norms).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(coded, dtype="<u4").astype(np.uint64)
    ends = np.cumsum([len(n) + 2 for n in norms])
    inside = np.ones(len(points), dtype=bool)
    inside[ends - 1] = False
    pairs = words.mix((points << np.uint64(21)) | np.append(points[1:], np.uint64(0)))[inside]
    return _min_hashes(pairs, np.ones(len(pairs)), np.append(0, ends[:-1]) - np.arange(len(norms)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """For each row of MinHashes, its keys: one for every three hashes."""
    keys = np.empty((len(hashes), _BANDS), dtype=np.uint64)
    for band in range(_BANDS):
        key = np.full(len(hashes), band + 1, dtype=np.uint64)
        for k in range(band * _ROWS, (band + 1) * _ROWS):
            key = words.mix(key * np.uint64(0xD6E8FEB86659FD93) + hashes[:, k])
        keys[:, band] = key
    return keys


def sketches(hashes: np.ndarray) -> np.ndarray:
    """Two bits of every MinHash, in two numbers."""
    bits = words.mix(hashes.astype(np.uint64)) & np.uint64(3)
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    return np.stack([(bits[:, i : i + 32] << shifts).sum(axis=1, dtype=np.uint64) for i in (0, 32)], axis=1)


def _families(norms: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By words and by characters: the places of the norms that take part, and their MinHashes."""
    yield np.arange(len(norms)), by_words(norms)
    few = [i for i, n in enumerate(norms) if len(n) < _SHORT or len(n) > _LONG_WORDS * (n.count(" ") + 1)]
    if few:
        yield np.array(few), by_characters([norms[i] for i in few])


def entries(norms: list[str], ids: np.ndarray) -> np.ndarray:
    """The keys of some lines, with what is to be compared under them."""
    lengths = np.fromiter(map(len, norms), dtype=np.uint32, count=len(norms))
    out = [np.zeros(0, dtype=_ENTRY)]
    for part in words.batches(norms, 1 << 18):
        for family, (at, hashes) in enumerate(_families(norms[part])):
            made = np.empty((len(at), _BANDS), dtype=_ENTRY)
            sketch = sketches(hashes)
            # The last five bits say which of a line's keys it is.
            made["key"] = words.mix(band_keys(hashes) + np.uint64(family)) >> _KIND << _KIND | (np.arange(_BANDS) + family * _BANDS).astype(np.uint64)
            made["id"], made["n"] = ids[part][at, None], lengths[part][at, None]
            made["s0"], made["s1"] = sketch[:, :1], sketch[:, 1:]
            out.append(made.reshape(-1))
    return np.concatenate(out)


def near_members(docs: DataFrame, fragments: int) -> DataFrame:
    """key, id and mark (length and sketch) of the lines of some documents that have another near under the same key.

    A line has ``_BANDS`` keys of each family at most; their last bits are the family and a number.
    """
    rows, lines = _readings(docs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, _, norms in lines(batch):
                new = {i: norm for i, norm in zip(_ids(norms).tolist(), norms, strict=True) if i not in met}
                if len(met) > _MET:
                    met.clear()
                met.update(new)
                made = entries(list(new.values()), np.array(list(new), dtype=np.int64))
                part = ((made["key"] >> _KIND) % np.uint64(fragments)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                found, starts = np.unique(part[order], return_index=True)
                data = [made[idx].tobytes() for idx in np.split(order, starts[1:])] if len(found) else []
                yield pa.record_batch([pa.array(found, pa.int32()), pa.array(data, pa.binary())], names=["fragment", "data"])

    def find(group: pa.Table) -> pa.Table:
        packed = group["data"].combine_chunks()
        ends = np.frombuffer(packed.buffers()[1], dtype="<i4")[packed.offset :][[0, len(packed)]].tolist()
        data = np.frombuffer(packed.buffers()[2], dtype=np.uint8)[slice(*ends)].view(_ENTRY)
        # Most keys are there once.
        order = np.argsort(data["key"])
        same = np.diff(data["key"][order]) == 0
        data = data[order[np.append(False, same) | np.append(same, False)]]
        data = data[np.lexsort((data["id"], data["n"], data["key"]))]
        # The same line from several tasks is one.
        again = (data["key"][1:] == data["key"][:-1]) & (data["id"][1:] == data["id"][:-1])
        data = data[np.append(True, ~again)[: len(data)]]
        near = np.zeros(len(data), dtype=bool)
        for a, b in _alike_pairs(data, lambda a, b: ~(near[a] & near[b])):
            near[a] = near[b] = True
        data = data[near]
        mark = [pa.array(data["n"].astype(np.int32)), *(pa.array(data[c].view(np.int64)) for c in ("s0", "s1"))]
        mark = pa.StructArray.from_arrays(mark, ["n", "s0", "s1"])
        return pa.table({"key": pa.array(data["key"].view(np.int64)), "id": pa.array(data["id"]), "mark": mark})

    packed = rows.select("text").mapInArrow(pack, "fragment int, data binary")
    return packed.groupBy("fragment").applyInArrow(find, f"key bigint, id bigint, mark {_MARK}")


def _alike_pairs(data: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs with the same key and fitting lengths and sketches, some at a time; ``data`` is sorted by key and length.

    Each is held against the next of its key, then the one after it, and so on; ``wanted`` says for which pairs that is of use by then.
    """
    key, n = data["key"].copy(), data["n"].astype(np.int64)
    s0, s1 = (np.ascontiguousarray(data[c]) for c in ("s0", "s1"))
    most = np.floor((1 - SIMILARITY) * n + 1e-9).astype(np.int64)
    active, step = np.arange(len(data)), 0
    while len(active):
        step += 1
        active = active[: np.searchsorted(active, len(data) - step)]
        # Lines further on are longer still.
        active = active[(key[active] == key[active + step]) & (n[active + step] - n[active] <= most[active + step])]
        for at in range(0, len(active), 1 << 16):
            a = active[at : at + (1 << 16)]
            a = a[wanted(a, a + step)]
            differ = np.zeros(len(a), dtype=np.uint8)
            for s in (s0, s1):
                x = s[a] ^ s[a + step]
                differ += np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_EVEN_BITS))
            a = a[differ <= _APART]
            yield a, a + step


def _fragments(lines: int) -> int:
    """How many fragments the keys of so many lines, some 20 each, are dealt to."""
    return max(8, lines * 20 // _FRAGMENT_KEYS)


def _keyed_fragments(members: int) -> int:
    """How many fragments so many keys are dealt to, each with all other keys of its line."""
    return max(8, members * _KEYED_BYTES // _FRAGMENT_BYTES)


def _compared(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between lines that share a key (``near_members``).

    A pair is compared where the first of the keys that both have lies, unless what was found there before has connected it.
    """
    family = F.col("key").bitwiseAND(1 << 4)
    lines = members.groupBy("id", family.alias("family")).agg(F.first("mark").alias("mark"), F.collect_list("key").alias("keys"))

    def dealt(rows: DataFrame, fragments: int) -> DataFrame:
        fragment = F.pmod(F.shiftrightunsigned("key", int(_KIND)), F.lit(fragments))
        return rows.withColumn("fragment", fragment).groupBy("fragment")

    def first(group: pa.Table) -> pa.Table:
        data, first_shared = _sorted_rows(group)
        used = np.zeros(len(data), dtype=bool)
        for a, b in _alike_pairs(data, lambda a, b: ~(used[a] & used[b])):
            here = first_shared(a, b)
            used[a[here]] = used[b[here]] = True
        rows = group.select(["key", "id", "n", "s0", "s1", "keys"]).take(pa.array(data["row"][used]))
        return rows.set_column(5, "keys", rows["keys"].cast(pa.list_(pa.int64())))

    kind = "key bigint, id bigint, n int, s0 bigint, s1 bigint, keys array<bigint>"
    rows = lines.select("id", "mark.*", "keys", F.explode("keys").alias("key"))
    # A line goes on only under those of its keys that are the first common one of a pair.
    rows = written(dealt(rows, _keyed_fragments(members.count())).applyInArrow(first, kind), "compared-lines")
    size = rows.agg(F.sum(F.lit(150) + F.col("n")).alias("size")).head().size or 0

    def compare(group: pa.Table) -> pa.Table:
        data, first_shared = _sorted_rows(group)
        ids, at, line = np.unique(data["id"], return_index=True, return_inverse=True)
        lines = edits.Lines(group["norm"].take(pa.array(data["row"][at])).to_pylist())
        n = data["n"].astype(np.int64)
        root = np.arange(len(ids))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        late: list[tuple[np.ndarray, np.ndarray]] = []

        def wanted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return root[line[a]] != root[line[b]]

        def most(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.floor((1 - SIMILARITY) * np.maximum(n[a], n[b]) + 1e-9).astype(np.int64)

        def judge() -> None:
            a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            near, unsure = edits.soon(lines, line[a], line[b], most(a, b))
            _unite(root, line[a[near]], line[b[near]])
            late.append((a[unsure], b[unsure]))

        def settle() -> None:
            a, b = (np.concatenate(x) for x in zip(*late, strict=True))
            late.clear()
            for turn in range(_TURNS + 1):
                # What has been connected since needs no answer.
                here = wanted(a, b)
                a, b = a[here], b[here]
                # Of each line one pair at first: most lines of a group are connected by that.
                some = np.unique(line[(a, b)[turn % 2]], return_index=True)[1] if turn < _TURNS else np.arange(len(a))
                x, y = a[some], b[some]
                near = edits.settled(lines, line[x], line[y], most(x, y))
                _unite(root, line[x[near]], line[y[near]])
                a, b = np.delete(a, some), np.delete(b, some)

        for a, b in _alike_pairs(data, wanted):
            here = first_shared(a, b)
            if here.any():
                held.append((a[here], b[here]))
                if sum(len(x) for x, _ in held) >= _PAIRS:
                    judge()
                    if sum(len(x) for x, _ in late) >= _LATE:
                        settle()
        if held:
            judge()
        if late:
            settle()
        linked = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[linked]), "b": pa.array(ids[root[linked]])})

    return dealt(rows.join(texts, "id"), max(8, size // _FRAGMENT_BYTES)).applyInArrow(compare, "a bigint, b bigint")


def _sorted_rows(group: pa.Table) -> tuple[np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """Rows as ``_alike_pairs`` needs them, with their places in ``group``, and a function that says of pairs
    whether the key under which they are found is the first that both have."""
    data = np.empty(group.num_rows, dtype=[*_ENTRY.descr, ("row", "<i8")])
    for c in ("key", "s0", "s1"):
        data[c] = group[c].to_numpy().view(np.uint64)
    data["id"], data["n"], data["row"] = group["id"].to_numpy(), group["n"].to_numpy(), np.arange(len(data))
    keys = np.zeros((len(data), _BANDS), dtype=np.uint64)
    listed = group["keys"].combine_chunks()
    flat = listed.flatten().to_numpy().view(np.uint64)
    keys[np.repeat(np.arange(len(data)), listed.value_lengths().to_numpy(zero_copy_only=False)), flat % np.uint64(_BANDS)] = flat
    data = data[np.lexsort((data["id"], data["n"], data["key"]))]
    row, band = data["row"].copy(), (data["key"] % np.uint64(_BANDS)).astype(np.int64)

    def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        common = (keys[row[a]] == keys[row[b]]) & (keys[row[a]] != 0)
        return common.argmax(axis=1) == band[a]

    return data, first_shared


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let ``root`` hold the smallest number that each is connected with, now also by links from ``a`` to ``b``."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root[:] = root[root]


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, row and line of every line that repeats an earlier one, exactly or nearly.

    Null and empty texts have no lines that take part. Rows with the same doc_id and text are one
    document; those with the same doc_id, or none, and different texts are not.
    """
    count = docs.agg(F.sum(F.size(F.split("text", "\n"))).alias("n")).head().n or 0
    members = written(near_members(docs, _fragments(count)), "near-lines")
    lines = written(lines_of(docs), "lines")
    texts = written(lines.select("id", "norm").join(members.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "line-texts")
    links = written(_compared(members, texts), "line-links")
    labels = written(components(links), "line-labels")
    distinct = lines.groupBy("id").agg(F.min(F.struct("doc_id", "line", "row")).alias("first"), F.count("*").alias("n"))
    grouped = written(distinct.join(labels, "id", "left").where("n > 1 OR component IS NOT NULL"), "repeated-lines")
    kept = grouped.groupBy(F.coalesce("component", "id").alias("group")).agg(F.min("first").alias("kept"))
    decided = grouped.withColumn("group", F.coalesce("component", "id")).join(kept, "group").select("id", "kept")
    here = F.struct("doc_id", "line", "row")
    occurrences = lines.select("doc_id", "row", "line", "id").join(decided, "id")
    return occurrences.where(~here.eqNullSafe(F.col("kept"))).select("doc_id", "row", "line").distinct()


def mark_repeats(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with ``removed``, the numbers of their repeated lines (null if none),
    and ``left``, the text without those lines."""
    gone = repeated_lines(docs).groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.sort_array(F.collect_list("line")).alias("removed"))
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__row"])
    joined = docs.join(gone, same, "left").drop("__id", "__row")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i))
    left = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("left", left)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without its repeated lines: texts, and ``n_chars`` if there is one, are made anew.

    Documents of which nothing but blank lines is left, and that had more, are left out. Documents
    without a text stay as they are. All columns of ``docs`` come back.
    """
    marked = mark_repeats(docs).where(F.col("removed").isNull() | (F.trim("left") != ""))
    made = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        size = F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(F.length("left"))
        made["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return marked.select(*[made[c].alias(c) if c in made else c for c in docs.columns])
