"""Blocked Bloom filters over words, and hashes of words that follow an edit cheaply.

The hash of a word is a sum over its places of letter times a fixed number of
the place. Replacing or deleting one letter changes it by a difference of such
terms, so the hashes of all edits of a word come from prefix sums.

A filter is a row of blocks of eight 64-bit lanes. A key sets one bit in each
lane of one block, so a probe touches one block only; where the first lane says
no, the others are not looked at.
"""

from __future__ import annotations

import numpy as np

from edgeworks.llm.shingles import mixed

LANES = 8
#: Bits of a filter for each key.
BITS_PER_KEY = 16


def place_numbers(n: int) -> np.ndarray:
    """The odd numbers of the first ``n`` places."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_sums(letters: np.ndarray) -> np.ndarray:
    """Sums of the rows of a table of letters, all of one length."""
    with np.errstate(over="ignore"):
        return (letters * place_numbers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // (64 * LANES)))


def _block(hashed: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def _lane_bits(hashed: np.ndarray, lane: int) -> np.ndarray:
    """The bit of a lane; lanes take theirs from two rounds of mixing."""
    taken = hashed if lane < 5 else mixed(hashed)
    return np.uint64(1) << ((taken >> np.uint64(6 * (lane % 5))) & np.uint64(63))


def key_bits(sums: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and what it sets in that block's lanes."""
    hashed = mixed(sums)
    return _block(hashed, blocks).astype(np.int64), np.stack([_lane_bits(hashed, k) for k in range(LANES)], axis=1)


def may_hold(lanes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Places of the keys that a filter, a table of blocks by lanes, may hold; all that it does hold are among them."""
    hashed = mixed(sums)
    block = _block(hashed, len(lanes))
    at = np.arange(len(sums))
    for k in range(LANES):
        bit = _lane_bits(hashed, k)
        hit = (lanes[block, k] & bit) != 0
        at, hashed, block = at[hit], hashed[hit], block[hit]
    return at


def slice_of(sums: np.ndarray, slices: int) -> np.ndarray:
    """Which part of a divided filter a key belongs to; independent of its block."""
    return (mixed(sums ^ np.uint64(0x94D049BB133111EB)) % np.uint64(slices)).astype(np.int64)
