"""Token ids as compressed files: every document a zstandard frame of its own, one dictionary for all.

Documents are put in ascending id order over the shards of a table. A shard's rows are blocks: up
to ``BLOCK_TOKENS`` tokens of consecutive documents, each document's ids (little-endian unsigned
32-bit) compressed by itself with a dictionary that was trained on the serialized ids of a few
documents. A block holds the frames end to end, where each frame starts, each document's id and
token count, and the dictionary's hash, so one document is read by decompressing one frame. The
dictionary lies beside the blocks. Spark writes and reads the files, so they may lie wherever
Spark can write, and a lost task's files are written anew.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A block holds whole documents up to about so many tokens; a longer document is one of its own.
BLOCK_TOKENS = 1 << 20
#: Documents that the dictionary is trained on (those with the smallest id hashes), bytes taken of
#: each, and the dictionary's size.
DICTIONARY_ROWS, DICTIONARY_SAMPLE, DICTIONARY_BYTES = 1000, 4096, 64 << 10
#: Plain words, and other units of text, whose ids a worker keeps, about 200 bytes each.
KNOWN_UNITS, KNOWN_WORDS = 400_000, 1_000_000
#: Bytes of text encoded at a time; a longer single text is one batch of its own.
BATCH_BYTES = 4 << 20

_BLOCKS = (
    "shard int, start bigint, n_tokens bigint, dictionary string, doc_ids array<bigint>, "
    "tokens array<bigint>, offsets array<bigint>, frames binary"
)
_WORD = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?|]*)$"


class Encoder:
    """Ids of texts by a ``tokenizers`` file; what was met before is looked up.

    Where a tokenizer drops white space, a text's ids are those of its space-separated units in a
    row. Arrow finds the distinct units of many texts; those of plain letters, perhaps with marks
    behind, are a word and its marks, and what was not met before goes to the library, words many
    at a time: the ids of a word end where an id has the end-of-word suffix. numpy lays the parts'
    ids end to end again. A tokenizer of another kind gets whole texts.
    """

    def __init__(self, path: str, most: int = KNOWN_UNITS, most_words: int = KNOWN_WORDS) -> None:
        # A task has one core: the library's threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.by_unit = _drops_space(rules)
        if self.by_unit:
            suffix = rules["model"]["end_of_word_suffix"]
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most, self.most_words = most, most_words

    def encode(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text in turn; a null one has none."""
        texts = texts.fill_null("")
        if not self.by_unit:
            for text in texts:
                yield self._library([text.as_py()])[0]
            return
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        for batch in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_BYTES)) + 1):
            if len(batch):
                yield from self._encode(texts.slice(batch[0], len(batch)))

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        units = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        borders = units.offsets.to_numpy() - units.offsets[0].as_py()
        coded = units.flatten().dictionary_encode()
        flat, starts, lengths, parts = self._parts(coded.dictionary)
        chosen = parts[coded.indices.to_numpy()].reshape(-1)
        size = lengths[chosen]
        ends = np.zeros(len(chosen) + 1, dtype=np.int64)
        np.cumsum(size, out=ends[1:])
        ids = flat[np.repeat(starts[chosen] - ends[:-1], size) + np.arange(ends[-1])]
        borders = ends[2 * borders]
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            yield ids[a:b].tobytes()

    def _parts(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all parts of some units end to end, where each begins, how many it has, and two parts for each unit."""
        found = pc.extract_regex(units, _WORD)
        split = found.is_valid().to_numpy(zero_copy_only=False)
        word, marks = (c.dictionary_encode() for c in found.filter(found.is_valid()).flatten())
        lower = pc.utf8_lower(word.dictionary).dictionary_encode()
        others = units.filter(found.is_null()).to_pylist()
        words, signs = lower.dictionary.to_pylist(), marks.dictionary.to_pylist()
        plain = self._looked_up(self.words, words + signs, self.most_words, self._learn_words)
        ids = [*plain, *self._looked_up(self.known, others, self.most, self._learn_units), b""]
        parts = np.full((len(units), 2), len(ids) - 1, dtype=np.int64)
        parts[split, 0] = lower.indices.to_numpy()[word.indices.to_numpy()]
        parts[split, 1] = len(words) + marks.indices.to_numpy()
        parts[~split, 0] = len(plain) + np.arange(len(others))
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        return np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(lengths) - lengths, lengths, parts

    @staticmethod
    def _looked_up(met: dict[str, bytes], wanted: list[str], most: int, learn) -> list[bytes]:
        found = list(map(met.get, wanted))
        new = [x for x, ids in zip(wanted, found, strict=True) if ids is None]
        if len(met) + len(new) > most:
            met.clear()
            new = wanted
        learn(new)
        return [met[x] if ids is None else ids for x, ids in zip(wanted, found, strict=True)]

    def _library(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in got]

    def _learn_units(self, units: list[str]) -> None:
        self.known.update(zip(units, self._library(units), strict=True))

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                starts = [0, *stops[:-1].tolist()]
                raw = ids.tobytes()
                found = [raw[4 * a : 4 * b] for a, b in zip(starts, stops.tolist(), strict=True)]
            else:
                found = self._library(some)
            self.words.update(zip(some, found, strict=True))


def _drops_space(rules: dict) -> bool:
    """Whether every white space is a border that leaves no id, and words end in a suffix."""
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
    first = steps[0] if steps else {}
    pattern = first.get("pattern", {}).get("Regex", "")
    return bool(
        rules["model"].get("end_of_word_suffix")
        and first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert")
        and "[^\\s\\p{L}\\p{N}]+" in pattern
        and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in rules["added_tokens"])
    )


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, tokenizer: str, rows: int = DICTIONARY_ROWS) -> bytes:
    """A dictionary for the serialized ids of ``docs``, from at most ``rows`` of them; empty if there are too few."""

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            ids = [raw[:DICTIONARY_SAMPLE] for raw in encoder.encode_all(batch.column("text"))]
            yield pa.record_batch([pa.array(ids, pa.binary())], names=["ids"])

    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    texts = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).select("text")
    samples = sorted(r.ids for r in texts.mapInArrow(serialize, "ids binary").toLocalIterator())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(s) for s in samples]).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of every text of ``docs`` (doc_id, text), each with ``end_id`` behind, to ``path``.

    A null text counts as empty: its ids are the end id alone. Rows without an id come first; rows
    with the same id follow each other in the order of their texts. Without rows there are no blocks.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "dictionary string, content binary").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = _encoder(tokenizer), _compressor(shared.value)
        shard, start, held = TaskContext.get().partitionId(), 0, 0
        ids, sizes, frames = [], [], []

        def block():
            offsets = np.cumsum([0, *map(len, frames)])[:-1].tolist()
            row = (shard, start, held, name, ids, sizes, offsets, b"".join(frames))
            return pa.RecordBatch.from_pylist([dict(zip(_NAMES, row, strict=True))], schema=_SCHEMA)

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode_all(batch.column("text")), strict=True):
                raw += end
                ids.append(doc_id)
                sizes.append(len(raw) // 4)
                frames.append(pack.compress(raw))
                held += sizes[-1]
                if held >= BLOCK_TOKENS:
                    yield block()
                    start, held = start + held, 0
                    ids, sizes, frames = [], [], []
        if ids:
            yield block()

    ordered = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id")
    ordered.sortWithinPartitions("doc_id", "text").mapInArrow(encode, _BLOCKS).write.parquet(f"{path}/blocks")


_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("dictionary", pa.string()),
        ("doc_ids", pa.list_(pa.int64())),
        ("tokens", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("frames", pa.binary()),
    ]
)
_NAMES = _SCHEMA.names


def _compressor(dictionary: bytes):
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _frames(batch: pa.RecordBatch, dictionaries: dict[str, bytes]) -> Iterator[tuple]:
    """Shard, place among the shard's tokens, id, token count and raw ids of each document."""
    for row in batch.to_pylist():
        content = dictionaries[row["dictionary"]]
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)
        start, ends = row["start"], [*row["offsets"][1:], len(row["frames"])]
        for doc_id, n, a, b in zip(row["doc_ids"], row["tokens"], row["offsets"], ends, strict=True):
            yield row["shard"], start, doc_id, n, unpack.decompress(row["frames"][a:b])
            start += n


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, bytes]]:
    rows = spark.read.parquet(f"{path}/dictionary").collect()  # one, of at most DICTIONARY_BYTES
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks"), {r.dictionary: bytes(r.content) for r in rows}


def read_token_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32 and, if wanted, the ids."""
    blocks, dictionaries = _opened(spark, path)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before, place = {}, 0
    for shard, n in totals:  # one number for each shard
        before[shard], place = place, place + n
    shared = spark.sparkContext.broadcast((before, dictionaries))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, contents = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [
                    (doc_id, offsets[shard] + start, n, zlib.crc32(raw), np.frombuffer(raw, "<u4") if ids else None)
                    for shard, start, doc_id, n, raw in _frames(batch.slice(i, 1), contents)
                ]
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    arrays.append(pa.array(columns[4], pa.list_(pa.int64())))
                yield pa.record_batch(arrays, names=[*names, "ids"][: len(arrays)])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return blocks.mapInArrow(decode, schema + ", ids array<bigint>" * ids)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with that id), decompressing no other's."""
    blocks, dictionaries = _opened(spark, path)
    at = F.array_position("doc_ids", doc_id).cast("int")
    held = blocks.where(F.array_contains("doc_ids", doc_id)).orderBy("shard", "start")
    found = []
    for row in held.select("dictionary", "doc_ids", "offsets", "frames", at.alias("at")).toLocalIterator():
        content = dictionaries[row.dictionary]
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)
        ends = [*row.offsets[1:], len(row.frames)]
        for i in range(row["at"] - 1, len(ends)):
            if row.doc_ids[i] != doc_id:
                break
            found.append(np.frombuffer(unpack.decompress(bytes(row.frames[row.offsets[i] : ends[i]])), "<u4").tolist())
    return found
