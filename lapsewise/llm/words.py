"""Words and word shingles of whole texts as 64-bit hashes, in numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D of the UTF-8 text; A-Z count as a-z.
A batch of texts is laid end to end, and every step (word borders, word hashes, shingle hashes)
is one array operation over the batch, so no Python loop runs over words.

A word's hash is its bytes as digits of a number in an odd base, modulo 2^64, taken from running
sums and scaled back by the inverse base; it is then mixed, as shingle hashes are. Two different
shingles share a hash with a chance of about 2^-64 for each pair compared.
"""

from __future__ import annotations

import numpy as np

#: Words in a shingle, unless a caller says otherwise.
WIDTH = 5
#: Bytes of text hashed at a time; a longer single text is one batch of its own.
BATCH_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ..., at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BATCH_BYTES + (1 << 16)), base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and the index of each text's first word (one more at the end)."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    if not raw:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, stops = edge[0::2], edge[1::2]
    digits = (data.astype(np.uint64) + np.uint64(1)) * inside * _power(_BASE, len(data))[: len(data)]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(digits, out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _power(_BASE_INVERSE, len(data))[starts]
    first = np.zeros(len(raw) + 1, dtype=np.int64)
    first[1:] = np.searchsorted(starts, ends)
    return mix(hashes), first


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the shingles of one text's words, in order; with fewer words, one for them all."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : n - width + 1 + k]
    return mix(out)


def shingle_lists(texts: list[str | None], width: int = WIDTH):
    """Yields each text's shingle hashes, in order and with repeats."""
    words, first = word_hashes(texts)
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield shingles(words[a:b], width)


def batches(texts: list[str | None], most: int = BATCH_BYTES):
    """Slices of a list of texts of about so many bytes each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
