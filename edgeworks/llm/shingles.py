"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd constants of a common 64-bit mixing function (fixed values).
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Words whose hashes a worker remembers.
REMEMBERED = 1 << 17


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
        return x ^ (x >> np.uint64(31))


def folded(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of each row of equally long columns, which their order enters."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    with np.errstate(over="ignore"):
        for column in columns:
            out = mixed(out * np.uint64(_MIX[0]) + column)
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of a text's ``k``-word shingles.

    Words are what lies between ASCII white space, A-Z in lower case. A text of
    fewer than ``k`` words, but not none, is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h, k = word_hashes(words), min(k, len(words))
    n = len(h) - k + 1
    return np.unique(folded([h[i:i + n] for i in range(k)]))
