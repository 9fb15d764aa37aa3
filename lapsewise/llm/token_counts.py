"""Token counts by a trie of pre-tokens: scores once for each shared prefix.

A batch's distinct pre-tokens (space-separated units) are walked in the order of a trie: sorted,
each begins where it leaves its predecessor's path, so the forward score of a prefix is computed
once for all pre-tokens that share it, and only one path is held at a time. What a path's end
says, the number of ids, is stored for each pre-token; a text's count is the sum over its
pre-tokens. Texts are not shuffled, and what a worker keeps is bounded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lapsewise.llm.bpe import SPACE, START, PieceModel, piece_model, units

#: Pre-tokens whose counts a worker keeps, about 150 bytes each.
KEPT = 1_000_000


def count_in_trie(model: PieceModel, pre_tokens: Iterable[str]) -> dict[str, int]:
    """Number of ids of each distinct pre-token, which stands behind a space."""
    counts = {}
    path, best, ids = "", [(0.0, START, None)], [0]
    for pre_token in sorted(set(pre_tokens)):
        text = SPACE + pre_token.replace(" ", SPACE)
        shared, most = 0, min(len(path), len(text))
        while shared < most and path[shared] == text[shared]:
            shared += 1
        del best[shared + 1 :], ids[shared + 1 :]
        for at in range(shared + 1, len(text) + 1):
            best.append(None)
            model.extend(text, at, best)
            _, piece, start = best[at]
            ids.append(ids[start] + model.width(piece, text[start:at]))
        counts[pre_token] = ids[-1]
        path = text
    return counts


class Counter:
    """Counts of whole texts, with what was met before looked up."""

    def __init__(self, model: PieceModel, kept: int = KEPT) -> None:
        self.model, self.kept, self.known = model, kept, {}

    def count(self, texts: list[str | None]) -> list[int]:
        split = [units(t) if t else [] for t in texts]
        missing = set().union(*split).difference(self.known)
        if len(self.known) + len(missing) > self.kept:
            self.known.clear()
            missing = set().union(*split)
        self.known.update(count_in_trie(self.model, missing))
        look = self.known.__getitem__
        return [sum(map(look, parts)) for parts in split]


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and n_tokens, as many ids as the model makes of each text; 0 for a null or empty one.

    Repeated rows are counted one by one; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.setdefault(model_path, Counter(piece_model(model_path)))
        for batch in batches:
            counts = counter.count(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint")
