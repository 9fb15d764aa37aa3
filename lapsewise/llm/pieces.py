"""SentencePiece encoding and decoding; giant documents by a max-plus scan over chunks.

A text longer than ``CHUNK`` characters is split into chunks of that length. What happens left of a
chunk matters to it only through the piece that reaches or ends at the cut: that piece and how
far it reaches over are the boundary state. Each chunk yields its transfer matrix by itself: for
every state at its left cut and every state at its right cut, the best score of the pieces in
between, minus infinity if there are none. Matrices are combined in the max-plus sense, which is
associative, into the score of every state at every cut; from the end of the text, the best states are
read off backwards; and with the states at its two cuts known, each chunk spells its pieces
by itself. The result is what one pass over the whole text gives.

Inside a chunk, spaces are borders that no piece of the model goes over, so all chunk states meet
at the first space; only what lies before it and after the last one is scored state by state, and
the units between are encoded by the library, once for each distinct unit that a worker meets. A
shorter text is one chunk with nothing before and behind. A chunk without a space, or a model with
pieces over spaces, is scored as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lapsewise.llm.bpe import SPACE, START, UNKNOWN, PieceModel, ids_to_bytes, piece_model, units
from lapsewise.llm.store import written

CHUNK = 1 << 15
#: Distinct units whose ids a worker keeps, about 150 bytes each.
KEPT = 150_000

#: A boundary state: the piece (or UNKNOWN, or START) that reaches over a cut, and by how much.
State = tuple[int, int]
Matrix = dict[State, dict[State, float]]


def compose(left: Matrix, right: Matrix) -> Matrix:
    """The max-plus product of two transfer matrices; what is not listed is minus infinity."""
    out: Matrix = {}
    for a, row in left.items():
        sums: dict[State, float] = {}
        for b, x in row.items():
            for c, y in right.get(b, {}).items():
                if c not in sums or x + y > sums[c]:
                    sums[c] = x + y
        if sums:
            out[a] = sums
    return out


class Chunk:
    """A stretch of a text with up to a piece's length of what lies before and behind it."""

    def __init__(self, model: PieceModel, before: str, text: str, behind: str, first: bool, last: bool) -> None:
        self.model, self.first, self.last = model, first, last
        self.whole = (before + text + behind).replace(" ", SPACE)
        self.left, self.right = len(before), len(before) + len(text)
        spaces = model.breaks_at_space
        found = self.whole.find(SPACE, self.left, self.right) if spaces else -1
        while found > 0 and self.whole[found - 1] == SPACE:  # runs of spaces may be one piece
            found = self.whole.find(SPACE, found + 1, self.right)
        self.head = found  # where the first unit that begins here starts
        tail = self.whole.rfind(SPACE, self.left, self.right) if spaces else -1
        while tail > 0 and self.whole[tail - 1] == SPACE:
            tail -= 1
        self.tail = tail if found >= 0 and tail >= found else -1
        if self.tail < 0:
            self.head = -1

    def states(self, cut: int) -> list[State]:
        """All states that the text around a cut allows."""
        m, whole = self.model, self.whole
        out = [(UNKNOWN, 0)] if cut and whole[cut - 1] not in m.ids else []
        for a in range(max(0, cut - m.longest), cut):
            for b in range(cut, min(len(whole), a + m.longest) + 1):
                piece = m.ids.get(whole[a:b])
                if piece is not None:
                    out.append((piece, b - cut))
        return out

    def _run(self, start: int, last: int, stop: int) -> list:
        """Best entries from ``start`` (after piece ``last``) to ``stop``."""
        best: list = [None] * (stop + 1)
        best[start] = (0.0, last, None)
        for at in range(start + 1, stop + 1):
            self.model.extend(self.whole, at, best, start)
        return best

    def _over(self, best: list, start: int) -> dict[State, tuple[float, int]]:
        """Right states that pieces begun in this chunk reach: score, and where the piece begins."""
        m, whole, out = self.model, self.whole, {}
        for a in range(max(start, self.right - m.longest), self.right):
            if best[a] is None:
                continue
            for b in range(self.right, min(len(whole), a + m.longest) + 1):
                piece = m.ids.get(whole[a:b])
                if piece is None:
                    continue
                more = m.weight(best[a][1], piece)
                if more is not None:
                    state, score = (piece, b - self.right), best[a][0] + more
                    if state not in out or score > out[state][0]:
                        out[state] = (score, a)
        if self.right > start and best[self.right] is not None and best[self.right][1] == UNKNOWN:
            out[UNKNOWN, 0] = (best[self.right][0], best[self.right][2])
        return out

    def matrix(self) -> Matrix:
        """Best scores from each left state to each right state; a text's two ends are START."""
        lefts = [(START, 0)] if self.first else self.states(self.left)
        if self.head >= 0:
            if self.last:
                rights = {(START, 0): 0.0}
            else:
                best = self._run(self.tail, START, self.right)
                rights = {s: v for s, (v, _) in self._over(best, self.tail).items()}
            # What the units between score is the same for all states, and is left out.
            rows = {}
            for piece, over in lefts:
                start = self.left + over
                if start > self.head:
                    continue
                end = self._run(start, piece, self.head)[self.head]
                if end is not None:
                    rows[piece, over] = {s: end[0] + v for s, v in rights.items()}
            return rows
        rows = {}
        for piece, over in lefts:
            start = self.left + over
            if start > self.right:
                continue
            best = self._run(start, piece, self.right)
            if self.last:
                row = {(START, 0): best[self.right][0]} if best[self.right] is not None else {}
            else:
                row = {s: v for s, (v, _) in self._over(best, start).items()}
                if start == self.right:
                    row[piece, 0] = 0.0
            if row:
                rows[piece, over] = row
        return rows

    def spell(self, left: State, right: State, encoder: Encoder) -> list[int]:
        """Ids of the pieces that begin in this chunk, given the states at its cuts."""
        start = self.left + left[1]
        if self.head >= 0:
            ids = self.model.trace(self.whole, self._run(start, left[0], self.head), self.head)
            stop = self.right if self.last else self.tail
            middle = self.whole[self.head : stop]
            if middle:
                ids += np.frombuffer(encoder.encode_units(middle[1:]), "<u4").tolist()
            return ids if self.last else ids + self._to_cut(self.tail, START, right)
        if self.last:
            return self.model.trace(self.whole, self._run(start, left[0], self.right), self.right)
        return self._to_cut(start, left[0], right)

    def _to_cut(self, start: int, last: int, right: State) -> list[int]:
        if start == self.right:
            return []
        best = self._run(start, last, self.right)
        _, a = self._over(best, start)[right]
        return self.model.trace(self.whole, best, a) + self.model.spelled(right[0], self.whole[a : self.right])


def scan(matrices: list[Matrix]) -> list[State]:
    """The best states at all cuts, both ends included, from the transfer matrices in order."""
    sums: list[dict[State, float]] = [{(START, 0): 0.0}]
    for matrix in matrices:
        step = compose({(START, 0): sums[-1]}, matrix)
        sums.append(step.get((START, 0), {}))
    states = [(START, 0)]
    for before, matrix in zip(sums[-2::-1], matrices[::-1], strict=True):
        goal = states[-1]
        fits = [(before[s] + row[goal], s) for s, row in matrix.items() if s in before and goal in row]
        states.append(max(fits)[1])
    return states[::-1]


class Encoder:
    """Ids of texts, with units met before looked up."""

    def __init__(self, model: PieceModel, kept: int = KEPT) -> None:
        self.model, self.kept, self.known = model, kept, {}

    def encode_units(self, text: str) -> bytes:
        """Ids of a text that is one chunk, as little-endian unsigned 32-bit integers."""
        if not self.model.breaks_at_space:
            return ids_to_bytes(self.model.library.encode(text))
        parts = units(text)
        missing = set(parts).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > self.kept:
                self.known.clear()
                missing = set(parts)
            some = list(missing)
            # The library writes no space before an empty text, but a lone space is a unit here.
            for unit, ids in zip(some, self.model.library.encode(some, num_threads=1), strict=True):
                self.known[unit] = ids_to_bytes(ids if unit else self._lone_space())
        return b"".join(map(self.known.__getitem__, parts))

    def _lone_space(self) -> list[int]:
        best = [(0.0, START, None), None]
        self.model.extend(SPACE, 1, best)
        return self.model.trace(SPACE, best, 1)

    def encode(self, text: str | None) -> bytes:
        return self.encode_units(text) if text else b""


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    return _encoders.setdefault(path, Encoder(piece_model(path)))


def cut_text(text: str, size: int, margin: int) -> list[tuple[str, str, str]]:
    """A text, with the model's space before it, as chunks with what lies around them."""
    text = " " + text
    return [(text[max(0, a - margin) : a], text[a : a + size], text[a + size : a + size + margin]) for a in range(0, len(text), size)]


def _dump(matrix: Matrix) -> str:
    return json.dumps([[a, list(row.items())] for a, row in matrix.items()])


def _load(text: str) -> Matrix:
    return {tuple(a): {tuple(b): v for b, v in row} for a, row in json.loads(text)}


def encode(docs: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers, as binary) of every text of ``docs``.

    A null or empty text has no ids. Repeated rows are encoded one by one; other columns are not
    read. The ids are those that the model's library gives for the whole text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    is_giant = F.coalesce(F.length("text") > chunk, F.lit(False))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = [encoder.encode(t.as_py()) for t in part.column("text")]
                yield pa.record_batch([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    plain = texts.where(~is_giant).mapInArrow(short, f"doc_id {kind}, ids binary")
    return plain.unionAll(_encode_giants(texts.where(is_giant), model_path, chunk, kind))


def _encode_giants(giants: DataFrame, model_path: str, chunk: int, kind: str) -> DataFrame:
    margin = 64  # at least a piece's length

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = cut_text(row["text"].replace(SPACE, " "), chunk, margin)
                yield pa.RecordBatch.from_pylist(
                    [{"key": row["key"], "k": k, "n": len(parts), "before": b, "text": t, "behind": a} for k, (b, t, a) in enumerate(parts)],
                    schema=pa.schema([("key", pa.string()), ("k", pa.int32()), ("n", pa.int32()), ("before", pa.string()), ("text", pa.string()), ("behind", pa.string())]),
                )

    def chunk_of(row) -> Chunk:
        return Chunk(piece_model(model_path), row["before"], row["text"], row["behind"], row["k"] == 0, row["k"] == row["n"] - 1)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.record_batch(
                [batch.column("key"), batch.column("k"), pa.array([_dump(chunk_of(r).matrix()) for r in rows], pa.string())],
                names=["key", "k", "matrix"],
            )

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunks = sorted(row["chunks"], key=lambda c: c["k"])
                found = scan([_load(c["matrix"]) for c in chunks])
                yield pa.record_batch(
                    [
                        pa.array([row["key"]] * len(chunks), pa.string()),
                        pa.array(range(len(chunks)), pa.int32()),
                        *(pa.array([s[i] for s in side], pa.int32()) for side in (found[:-1], found[1:]) for i in (0, 1)),
                    ],
                    names=["key", "k", "p0", "o0", "p1", "o1"],
                )

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            ids = [ids_to_bytes(chunk_of(r).spell((r["p0"], r["o0"]), (r["p1"], r["o1"]), encoder)) for r in batch.to_pylist()]
            yield pa.record_batch([batch.column("key"), batch.column("k"), pa.array(ids, pa.binary())], names=["key", "k", "ids"])

    # Equal texts are encoded once; their hash stands for them from here on.
    keyed = giants.withColumn("key", F.sha2("text", 256))
    owners = keyed.select("doc_id", "key")
    distinct = keyed.groupBy("key").agg(F.first("text").alias("text"))
    cut = distinct.mapInArrow(pieces_of, "key string, k int, n int, before string, text string, behind string")
    chunks = written(cut, "chunks")
    by_key = chunks.mapInArrow(matrices, "key string, k int, matrix string").groupBy("key")
    listed = by_key.agg(F.collect_list(F.struct("k", "matrix")).alias("chunks"))
    borders = listed.mapInArrow(states, "key string, k int, p0 int, o0 int, p1 int, o1 int")
    parts = chunks.join(borders, ["key", "k"]).mapInArrow(spelled, "key string, k int, ids binary")
    whole = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(p["ids"] for p in parts) for parts in batch.column("parts").to_pylist()]
            yield pa.record_batch([batch.column("key"), pa.array(ids, pa.binary())], names=["key", "ids"])

    return owners.join(whole.mapInArrow(joined, "key string, ids binary"), "key").select("doc_id", "ids")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The rows of ``encoded`` with their ``ids`` decoded as ``decoded``; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = piece_model(model_path).library
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = [None if b is None else library.decode(np.frombuffer(b, "<u4").tolist()) for b in part.column("ids").to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(made, pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
