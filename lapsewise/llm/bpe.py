"""Segmentation by a SentencePiece model as a forward score over prefixes.

For a unigram model, the score of a prefix is the best sum of piece scores. For a BPE model, pieces
have ranks, not probabilities, and a sequence is the encoding exactly if every two neighbours are
what the merges make of their joined text: a merge across the border between two pieces would
happen in the two alone as soon as it does in the whole. So a piece weighs 0 after a neighbour
that it may follow and minus infinity after others, and every prefix has one last piece. Either
way the score of a prefix is the maximum, over its last piece, of the score before it plus a
weight, which depends on nothing that comes later.

Characters that no piece holds stand alone: they are one unknown id or, with byte fallback, one id
for each UTF-8 byte.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

SPACE = "▁"
#: Last piece of the empty prefix, and of a prefix that ends in an unknown character.
START, UNKNOWN = -1, -2
_PAIRS = 2_000_000


class PieceModel:
    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as file:
            content = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        spec = proto.ModelProto()
        spec.ParseFromString(content)
        rules = spec.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that keep texts as they are, with a space before, are supported")
        self.is_bpe = spec.trainer_spec.model_type == proto.TrainerSpec.BPE
        kinds = proto.ModelProto.SentencePiece
        usable = (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type in usable}
        self.scores = [p.score for p in spec.pieces]
        self.texts = [p.piece for p in spec.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kinds.BYTE}
        self.unknown_id = self.library.unk_id()
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        self.by_last = {}
        for piece in self.ids:
            self.by_last.setdefault(piece[-1], set()).add(len(piece))
        self.by_last = {c: sorted(n, reverse=True) for c, n in self.by_last.items()}
        self._follows: dict[tuple[int, int], bool] = {}
        #: No piece goes on after a space into which it did not begin: spaces are borders.
        self.breaks_at_space = not any(SPACE in p.lstrip(SPACE) for p in self.ids)

    def weight(self, last: int, piece: int) -> float | None:
        """What ``piece`` adds after ``last``; None if it may not follow."""
        if not self.is_bpe:
            return self.scores[piece]
        key = (last, piece)
        ok = self._follows.get(key)
        if ok is None:
            if len(self._follows) >= _PAIRS:
                self._follows.clear()
            left = "" if last < 0 else self.texts[last]
            ok = self._follows[key] = self._stays_split(left, self.texts[piece])
        return 0.0 if ok else None

    def _stays_split(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends in just these two (in ``right`` if left is empty)."""
        text = left + right
        ends = list(range(1, len(text) + 1))  # where the symbol that begins here ends; 0 if none does
        before = list(range(-1, len(text) - 1))
        wait: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int, put) -> None:
            found = self.ids.get(text[a : ends[b]])
            if found is not None:
                put((-self.scores[found], a, b, ends[b]))

        for b in range(1, len(text)):
            offer(b - 1, b, wait.append)
        heapify(wait)
        while wait:
            _, a, b, stop = heappop(wait)
            if ends[a] != b or ends[b] != stop:
                continue
            if a < len(left) < stop:
                return False
            ends[a], ends[b] = stop, 0
            if stop < len(text):
                before[stop] = a
                offer(a, stop, lambda x: heappush(wait, x))
            if before[a] >= 0:
                offer(before[a], a, lambda x: heappush(wait, x))
        return (not left or ends[0] == len(left)) and ends[len(left)] == len(text)

    def extend(self, text: str, at: int, best: list, floor: int = 0) -> None:
        """Fill ``best[at]`` (score, last piece, its start) from the entries before it.

        ``text`` has spaces as in pieces; pieces begin at ``floor`` or later.
        """
        found = None
        for n in self.by_last.get(text[at - 1], ()):
            start = at - n
            if start < floor or best[start] is None:
                continue
            piece = self.ids.get(text[start:at])
            if piece is None:
                continue
            more = self.weight(best[start][1], piece)
            if more is not None and (found is None or best[start][0] + more > found[0]):
                found = (best[start][0] + more, piece, start)
                if self.is_bpe:
                    break
        if found is None and at - 1 >= floor and best[at - 1] is not None and text[at - 1] not in self.ids:
            found = (best[at - 1][0] + (0.0 if self.is_bpe else self.unknown_score), UNKNOWN, at - 1)
        best[at] = found

    def width(self, piece: int, char: str) -> int:
        """How many ids a piece is; ``char`` is the text of an unknown one."""
        return len(char.encode("utf-8", "surrogatepass")) if piece == UNKNOWN and self.bytes else 1

    def spelled(self, piece: int, char: str) -> list[int]:
        if piece != UNKNOWN:
            return [piece]
        if self.bytes:
            return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]
        return [self.unknown_id]

    def trace(self, text: str, best: list, at: int) -> list[int]:
        """Ids of the best way to ``best[at]``."""
        parts = []
        while best[at] is not None and best[at][2] is not None:
            _, piece, start = best[at]
            parts.append(self.spelled(piece, text[start:at]))
            at = start
        return [i for part in reversed(parts) for i in part]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each worker, so that what it has looked up stays."""
    return PieceModel(path)


def units(text: str) -> list[str]:
    """Space-separated parts, without the space before each; further spaces before stay.

    Joined again with a space before each they are the text with a space before it.
    """
    text = text.replace(SPACE, " ")
    parts = text.split(" ")
    if "" not in parts:
        return parts
    out, held = [], 0
    for i, part in enumerate(parts):
        if part or i == len(parts) - 1:
            out.append(" " * held + part)
            held = 0
        else:
            held += 1
    return out


def ids_to_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()
