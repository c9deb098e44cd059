"""A compressed FM-index over word codes, in numpy, for many searches at a time."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
#: Suffixes of an interval whose codes before are looked at one by one; wider ones are counted in the wavelet tree.
NARROW = 4


class Bits:
    """A bit vector with rank: 64-bit words and the number of ones before each."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(self.n // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """A wavelet tree whose levels are stored one after the other, highest bit first."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            bit = (codes >> level) & 1
            self.levels.append((level, Bits(bit.astype(bool)), int(len(codes) - bit.sum())))
            codes = np.concatenate([codes[bit == 0], codes[bit == 1]])
        self.first = self._mapped(np.zeros(1 << bits, np.int64), np.arange(1 << bits)) if len(codes) else np.zeros(1 << bits, np.int64)

    def _mapped(self, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((codes >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each code occurs before its position."""
        return self._mapped(at, codes) - self.first[codes]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` codes at least.

    Three codes are packed into the first key; later rounds sort only what is
    still equal, by ranks ``step`` codes further on.
    """
    n = len(text)
    width = max(1, int(text.max(initial=0)).bit_length())
    wide = np.zeros(n + 3, np.int64)
    wide[:n] = text
    key, step = wide[:n].copy(), 1
    while step < 3 and (step + 1) * width <= 62:
        key = (key << width) | wide[step:n + step]
        step += 1
    order = np.argsort(key, kind="stable")
    ranks = np.zeros(n + depth + 1, np.int64)
    head = np.flatnonzero(np.diff(key[order], prepend=-1))
    groups = np.repeat(head, np.diff(head, append=n))
    ranks[order] = groups + 1
    while step < depth:
        sizes = np.diff(head, append=n)
        tied = np.repeat(sizes > 1, sizes)
        if not tied.any():
            break
        where = np.flatnonzero(tied)
        moved = order[where]
        after = ranks[np.minimum(moved + step, n + depth)]
        # Both are below 2^31.
        sort = np.argsort(groups[where] << 32 | after)
        order[where] = moved[sort]
        after = after[sort]
        new = np.flatnonzero((np.diff(groups[where], prepend=-1) != 0) | (np.diff(after, prepend=-1) != 0))
        groups[where] = np.repeat(where[new], np.diff(new, append=len(where)))
        ranks[order[where]] = groups[where] + 1
        head = np.flatnonzero(np.diff(groups, prepend=-1))
        step *= 2
    return order


class FMIndex:
    """Counts and finds patterns of at most ``depth`` codes in a text of codes above 0."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth, self.n = depth, len(text)
        self.order = suffix_array(text, depth)
        top = int(text.max(initial=0))
        self.smaller = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=top + 1), out=self.smaller[1:])
        self.last = WaveletMatrix(text[self.order - 1], max(1, top.bit_length()))
        #: Where in the order each suffix stands that is longer by the code before.
        self.longer = np.empty(self.n, np.int32)
        ranks = np.empty(self.n, np.int32)
        ranks[self.order] = np.arange(self.n, dtype=np.int32)
        self.longer[:] = ranks[self.order - 1]

    def extend(self, low: np.ndarray, high: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the suffixes that start with a code before each interval's pattern.

        No interval is empty. Each different wide interval and code is counted
        once. The suffixes of a narrow one that follow the code are those whose
        longer suffix starts with it; together these are the new interval.
        """
        new_low, new_high = np.empty_like(low), np.empty_like(high)
        wide = high - low > NARROW
        at = np.flatnonzero(wide)
        if len(at):
            _, first, back = np.unique(low[at] * len(self.smaller) + codes[at], return_index=True, return_inverse=True)
            pick = at[first]
            both = np.concatenate([codes[pick], codes[pick]])
            found = self.smaller[both] + self.last.rank(both, np.concatenate([low[pick], high[pick]]))
            new_low[at], new_high[at] = found[:len(pick)][back], found[len(pick):][back]
        at = np.flatnonzero(~wide)
        if len(at):
            sizes = high[at] - low[at]
            head = np.cumsum(sizes) - sizes
            longer = self.longer[np.repeat(low[at] - head, sizes) + np.arange(int(sizes.sum()))]
            bottom, top = self.smaller[codes[at]], self.smaller[codes[at] + 1]
            follows = (longer >= np.repeat(bottom, sizes)) & (longer < np.repeat(top, sizes))
            # Without any, the interval is empty.
            least = np.minimum.reduceat(np.where(follows, longer, self.n), head)
            new_low[at], new_high[at] = least, least + np.add.reduceat(follows, head, dtype=np.int64)
        return new_low, new_high

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How far back from each end a pattern occurs at least twice, ``depth`` codes at most.

        The text is streamed through the index it is part of, so an interval
        of one suffix is the place itself and its search is over. Returns the
        lengths, and the intervals of those that reach ``depth``.
        """
        length = np.zeros(len(ends), np.int64)
        low = np.zeros(len(ends), np.int64)
        high = np.full(len(ends), self.n, np.int64)
        alive = np.arange(len(ends))
        for step in range(self.depth):
            codes = text[ends[alive] - step]
            lo, hi = self.extend(low[alive], high[alive], codes) if step else (self.smaller[codes], self.smaller[codes + 1])
            more = hi - lo > 1
            alive, low_now, high_now = alive[more], lo[more], hi[more]
            low[alive], high[alive], length[alive] = low_now, high_now, step + 1
            if not len(alive):
                break
        return length, low, high

    def first_places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least text position of each suffix interval; intervals may repeat but not overlap."""
        starts, back = np.unique(low, return_inverse=True)
        ends = np.zeros(len(starts), np.int64)
        ends[back] = high
        padded = np.append(self.order, self.n)
        return np.minimum.reduceat(padded, np.stack([starts, ends], 1).ravel())[::2][back] if len(low) else low
