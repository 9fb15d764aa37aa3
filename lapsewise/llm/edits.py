"""Which of many pairs of lines are similar by edit distance, in numpy.

All pairs are taken at once. Characters are counted first: an edit changes one single character and
two pairs of neighbours, so counts that differ by more than the most edits could do rule a pair out.
Of longer lines, edits are then allowed one by one: of every diagonal of the table is kept how far so
many edits lead on it (Ukkonen), so a copy with few edits costs the square of its distance instead of
that of its length. Pairs that need more than an eighth of the most edits are left to Myers' bit vectors
(64 rows of the table in a number): all pairs of like length at a time and, one column apart, all their numbers.
"""

from __future__ import annotations

import numpy as np

#: Characters that are counted at a time.
_COUNTED = 1 << 19
#: Diagonals of the pairs compared at a time.
_DIAGONALS = 1 << 16
#: Numbers in the table of where each character lies in each line, for the pairs compared at a time.
_TABLE = 1 << 19
#: Different characters of a line, about, and numbers in the table of the places of all characters.
_ALPHABET, _CODES = 64, 1 << 21
#: Fewer pairs of like length than this cost less one by one.
_FEW = 12
#: Lines of no more characters have bit vectors at once.
_BRIEF = 128
_SINGLE, _PAIRED = 32, 64
_ONE = np.uint64(1)
_LAST = np.uint64(63)


class Lines:
    """Some lines as numbered characters, one line after the other, with counts of each."""

    def __init__(self, lines: list[str]) -> None:
        points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
        self.starts = np.cumsum(self.sizes) - self.sizes
        there = np.zeros(0x110000, dtype=bool)
        there[points] = True
        self.letters = int(there.sum())
        self.codes = (np.cumsum(there, dtype=np.int32) - 1)[points]
        self.single = np.zeros((len(lines), _SINGLE), dtype=np.int16)
        self.paired = np.zeros((len(lines), _PAIRED), dtype=np.int16)
        ends = self.starts + self.sizes
        first = 0
        while first < len(lines):
            last = max(first + 1, int(np.searchsorted(ends, self.starts[first] + _COUNTED)))
            codes = self.codes[self.starts[first] : ends[last - 1]].astype(np.int64)
            owner = np.repeat(np.arange(last - first), self.sizes[first:last])
            self.single[first:last] = _counts(owner, codes, _SINGLE, last - first)
            inside = owner[1:] == owner[:-1]
            pairs = (codes[:-1] * 0x9E3779B1 + codes[1:] * 0x85EBCA77) >> 7
            self.paired[first:last] = _counts(owner[1:][inside], pairs[inside], _PAIRED, last - first)
            first = last
        # As many characters from each place on as a number holds, also where the line ends before.
        self.bits = 16 if self.letters <= 1 << 16 else 32
        self.ahead = np.zeros(len(points) + 1, dtype=np.uint64)
        self.ahead[:-1] = self.codes
        for shift in (s for s in (32, 16) if s >= self.bits):
            by = shift // self.bits
            self.ahead[:-by] |= self.ahead[by:] << np.uint64(shift)

    def padded(self, at: np.ndarray, width: int) -> np.ndarray:
        """So many characters from each of some places on, a row each, also where the line is shorter."""
        place = at[:, None] + np.arange(width)
        return self.codes[np.minimum(place, len(self.codes) - 1)]


def _counts(owner: np.ndarray, what: np.ndarray, kinds: int, n: int) -> np.ndarray:
    """How often each line has each kind of character (more than 32,767 times counts as that)."""
    out = np.bincount(owner * kinds + what % kinds, minlength=n * kinds)
    return np.minimum(out, 32767).astype(np.int16).reshape(n, kinds)


def within(lines: Lines, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether the lines numbered ``a`` and ``b`` are at most ``most`` edits apart, pair by pair."""
    out, unsure = soon(lines, a, b, most)
    out[unsure] = settled(lines, a[unsure], b[unsure], most[unsure])
    return out


def soon(lines: Lines, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are found with little work to be within ``most`` edits, and the places of those not yet known (for ``settled``)."""
    out, unsure = np.zeros(len(a), dtype=bool), [np.zeros(0, dtype=np.int64)]
    for at in range(0, len(a), 1 << 14):
        some = slice(at, at + (1 << 14))
        x, y, k = a[some], b[some], most[some]
        differ = lines.single[x] - lines.single[y]
        more = np.where(differ > 0, differ, 0).sum(axis=1)
        possible = (more <= k) & (more - differ.sum(axis=1) <= k)
        left = np.flatnonzero(possible)
        apart = np.abs(lines.paired[x[left]] - lines.paired[y[left]]).sum(axis=1)
        left = left[apart <= 4 * k[left]]
        x, y, k = x[left], y[left], k[left]
        size = np.maximum(lines.sizes[x], lines.sizes[y])
        # Putting all of the other line in the place of one takes as many edits as the longer has characters.
        near = size <= k
        long = np.flatnonzero(~near & (size > _BRIEF))
        near[long] = _few_edits(lines, x[long], y[long], k[long] >> 3)
        out[at + left] = near
        unsure.append(at + left[~near])
    return out, np.concatenate(unsure)


def _few_edits(lines: Lines, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which pairs are at most ``most`` edits apart, fewer than the longer line has characters."""
    swap = lines.sizes[a] > lines.sizes[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    m, n = lines.sizes[a], lines.sizes[b]
    out = np.zeros(len(a), dtype=bool)
    rest = np.flatnonzero(n - m <= most)
    rest = rest[np.argsort(most[rest], kind="stable")]
    for at in range(0, len(rest), _DIAGONALS >> 4):
        pairs = rest[at : at + (_DIAGONALS >> 4)]
        start = _equal(lines, lines.starts[a[pairs]], lines.starts[b[pairs]], m[pairs])
        # Pairs, the edits allowed, the first diagonal (place in b less place in a) and how far in a each leads.
        todo = [(pairs, 0, 0, start[:, None])]
        while todo:
            pairs, edits, low, reach = todo.pop()
            while len(pairs):
                more = n[pairs] - m[pairs]
                end = reach[np.arange(len(pairs)), np.clip(more - low, 0, reach.shape[1] - 1)]
                there = (end == m[pairs]) & (more >= low) & (more < low + reach.shape[1])
                out[pairs[there]] = True
                going = ~there & (edits < most[pairs])
                if not going.all():
                    pairs, reach = pairs[going], reach[going]
                    if not len(pairs):
                        break
                if reach.size > _DIAGONALS and len(pairs) > 1:
                    half = len(pairs) // 2
                    todo.append((pairs[half:], edits, low, reach[half:]))
                    pairs, reach = pairs[:half], reach[:half]
                edits += 1
                low, reach = _one_more(lines, a[pairs], b[pairs], most[pairs] - edits, low, reach)
    return out


def _one_more(lines: Lines, a: np.ndarray, b: np.ndarray, left: np.ndarray, low: int, reach: np.ndarray) -> tuple[int, np.ndarray]:
    """The first diagonal and how far each is reached with one edit more; ``left`` are the edits allowed after that."""
    count, width = reach.shape
    m, n = lines.sizes[a], lines.sizes[b]
    out = np.full((count, width + 2), -1, dtype=reach.dtype)
    out[:, 2:] = reach
    np.maximum(out[:, 1:-1], reach + 1, out=out[:, 1:-1])
    np.maximum(out[:, :-2], reach + 1, out=out[:, :-2])
    # The end is on diagonal n - m, and every step to another diagonal is an edit.
    first = max(low - 1, int((n - m - left).min()))
    last = min(low + width, int((n - m + left).max()))
    out = out[:, first - low + 1 : last - low + 2]
    diagonal = np.arange(first, last + 1)
    np.minimum(out, np.minimum(m[:, None], n[:, None] - diagonal), out=out)
    at_b = out + diagonal
    room = np.minimum(m[:, None] - out, n[:, None] - at_b)
    place = lines.starts[a][:, None] + out, lines.starts[b][:, None] + np.maximum(at_b, 0)
    out += _equal(lines, place[0].ravel(), place[1].ravel(), room.ravel()).reshape(out.shape)
    return first, out


def _equal(lines: Lines, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many characters from two places on are the same, ``room`` at most."""
    each, shift = 64 // lines.bits, np.uint8(lines.bits.bit_length() - 1)
    differ = lines.ahead[a] ^ lines.ahead[b]
    out = (np.bitwise_count((differ & (~differ + _ONE)) - _ONE) >> shift).astype(np.int64)
    on = np.flatnonzero((differ == 0) & (room > each))
    while len(on):
        differ = lines.ahead[a[on] + out[on]] ^ lines.ahead[b[on] + out[on]]
        step = (np.bitwise_count((differ & (~differ + _ONE)) - _ONE) >> shift).astype(np.int64)
        out[on] += step
        on = on[(step == each) & (out[on] < room[on])]
    return np.minimum(out, room)


def settled(lines: Lines, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """As :func:`within`, by the distance itself; better of many pairs at a time."""
    swap = lines.sizes[a] > lines.sizes[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    m, n = lines.sizes[a], lines.sizes[b]
    out = n <= most
    # Of an empty line that was all there is to say.
    rest = np.flatnonzero(~out & (m > 0) & (n - m <= most))
    rest = rest[np.argsort(n[rest] + (m[rest] - 1 >> 6), kind="stable")]
    while len(rest):
        # Lines of like length, as many as the tables have room for.
        step = max(1, min(_TABLE // (((int(n[rest[0]]) >> 6) + 1) * _ALPHABET), _CODES // lines.letters))
        some = rest[: min(step, int(np.searchsorted(n[rest], 2 * n[rest[0]], side="right")) or 1)]
        rest = rest[len(some) :]
        if len(some) < _FEW:
            out[some] = [_reached(lines, *pair) for pair in zip(a[some].tolist(), b[some].tolist(), most[some].tolist(), strict=True)]
        else:
            out[some] = _distances(lines, lines.starts[a[some]], m[some], lines.starts[b[some]], n[some], int(most[some].max())) <= most[some]
    return out


def _reached(lines: Lines, a: int, b: int, most: int) -> bool:
    """Whether a line is within so many edits of one that is no shorter: all rows of the table in one whole number."""
    one, other = (lines.codes[lines.starts[x] : lines.starts[x] + lines.sizes[x]] for x in (a, b))
    places = {c: int.from_bytes(np.packbits(one == c, bitorder="little").tobytes(), "little") for c in np.unique(one).tolist()}
    m, left = len(one), len(other)
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for c in other.tolist():
        eq = places.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = ((ph << 1) | 1) & full
        up = ((mh << 1) & full) | (full & ~(xv | ph))
        down = ph & xv
        left -= 1
        # Every character that is left brings one less at most.
        if score - left > most:
            return False
    return True


def _places(lines: Lines, at: np.ndarray, sizes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits that say where each character lies in some lines, words first, and for each line and character its place there (0: none)."""
    codes = lines.padded(at, int(sizes.max())) + (np.arange(len(at)) * lines.letters)[:, None]
    inside = np.arange(codes.shape[1]) < sizes[:, None]
    there = np.zeros(len(at) * lines.letters, dtype=bool)
    there[codes[inside]] = True
    number = np.where(there, np.cumsum(there, dtype=np.int32), 0)
    table = np.zeros((words, int(there.sum()) + 1), dtype=np.uint64)
    # What lies behind a line's end counts as place 0, which is emptied.
    for i, place in enumerate(np.where(inside, number[codes], 0).T):
        table[i >> 6, place] |= np.uint64(1 << (i & 63))
    table[:, 0] = 0
    return table, number


def _distances(lines: Lines, at_a: np.ndarray, m: np.ndarray, at_b: np.ndarray, n: np.ndarray, band: int) -> np.ndarray:
    """Edit distances of pairs, sorted by ``n`` and the number of words of 64 bits that ``m`` takes together.

    In a step, each word takes the column after that of the word below, so that what goes from one to the next is known by then.
    Only words with a row no more than ``band`` from the diagonal are looked at; a distance above ``band`` may come out larger.
    """
    count, band = len(m), max(1, band)
    end = (m - 1) >> 6
    words = int(end.max()) + 1
    table, number = _places(lines, at_a, m, words)
    text = np.zeros((int(n.max()) + words, count), dtype=np.int32)
    text[:-words] = number[lines.padded(at_b, len(text) - words) + (np.arange(count) * lines.letters)[:, None]].T
    flat, offset = table.ravel(), (np.arange(words) * table.shape[1])[:, None]
    up, down = np.full((words, count), ~np.uint64(0)), np.zeros((words, count), dtype=np.uint64)
    # What each word gets from the one before (more, less), and the distance at its lowest row.
    into, score = np.zeros((2, words + 1, count), dtype=np.uint64), np.zeros((words, count), dtype=np.uint64)
    lowest, pairs = np.full((words, count), _LAST), np.arange(count)
    lowest[end, pairs] = (m - 1) & 63
    out, done, entered, lowered = np.zeros(count, dtype=np.int64), n - 1 + end, -1, 0
    firsts = np.searchsorted(done, np.arange(int(done[-1]) + 2)).tolist()
    for t, first in enumerate(firsts[:-1]):
        low, high = max(0, (t - band - 64) // 65 + 1), min(words - 1, t, (t + band) // 65)
        if high > entered:
            score[high, first:] = score[high - 1, first:] - into[0, high, first:] + into[1, high, first:] if high else 0
            score[high, first:] += lowest[high, first:] + _ONE
            entered = high
        if low == lowered:
            into[0, low], into[1, low] = 1, 0
        # The word that is left out from now on has still had this column.
        lowered = low
        pv, mv, given = up[low : high + 1, first:], down[low : high + 1, first:], into[:, low : high + 1, first:]
        place = text[t - high : t - low + 1, first:][::-1] + offset[low : high + 1]
        eq = flat.take(place)
        xv = eq | mv
        eq |= given[1]
        xh = eq & pv
        xh += pv
        xh ^= pv
        xh |= eq
        step = np.empty((2, *eq.shape), dtype=np.uint64)
        ph, mh = step
        np.bitwise_or(xh, pv, out=ph)
        np.invert(ph, out=ph)
        ph |= mv
        np.bitwise_and(pv, xh, out=mh)
        passed = step >> lowest[low : high + 1, first:]
        passed &= _ONE
        at_end = score[low : high + 1, first:]
        at_end += passed[0]
        at_end -= passed[1]
        step <<= _ONE
        step |= given
        np.bitwise_and(ph, xv, out=mv)
        xv |= ph
        np.invert(xv, out=xv)
        np.bitwise_or(mh, xv, out=pv)
        into[:, low + 1 : high + 2, first:] = passed
        over = slice(first, firsts[t + 1])
        out[over] = score[end[over], pairs[over]].view(np.int64)
    return out
