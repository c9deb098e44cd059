"""Byte-pair merges by a segment tree over the ranks of adjacent pairs.

A leaf stands for a symbol and the one after it, and holds the rank of their
merge above the leaf's place, so that the least number at the root is the
leftmost pair of lowest rank. A merge changes three leaves (the pair itself,
the one before it, and that of the symbol that went), each on a path of
logarithmic length. It ends when the root says that nothing can be merged.

``merged`` does so for one sequence of any length. ``merged_many`` keeps the
trees of many short sequences side by side in one array and merges once in
each of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Sequences of at most so many symbols stand side by side.
SHORT = 64
#: Numbers in the trees that stand side by side at a time.
FOREST = 1 << 20


class Merges:
    """Ranks and results of pair merges, for single pairs and for arrays of them."""

    def __init__(self, pairs: Iterable[tuple[int, int]], made: Iterable[int], symbols: int):
        pairs = list(pairs)
        self.symbols = symbols
        self.made = np.array(list(made), np.int32)
        #: pair -> (rank, symbol it becomes)
        self.of = {p: (r, int(m)) for r, (p, m) in reversed(list(enumerate(zip(pairs, self.made, strict=True))))}
        coded = np.array([a * symbols + b for a, b in self.of], np.int64)
        ranks = np.array([r for r, _ in self.of.values()], np.int32)
        order = np.argsort(coded)
        self.none = max(1, len(pairs))
        self._coded, self._ranks = np.append(coded[order], np.int64(symbols) * symbols), np.append(ranks[order], self.none).astype(np.int32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``none`` where it does not merge."""
        coded = a.astype(np.int64) * self.symbols + b
        at = np.searchsorted(self._coded, coded)
        return np.where(self._coded[at] == coded, self._ranks[at], self.none)


def merged(ids: list[int], merges: Merges) -> list[int]:
    """The symbols that are left of one sequence."""
    n = len(ids)
    if n < 2:
        return list(ids)
    width = 1 << (n - 1).bit_length()
    none, of, ids = merges.none * width, merges.of, list(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * width)
    for i, pair in enumerate(zip(ids, ids[1:])):
        if pair in of:
            tree[width + i] = of[pair][0] * width + i
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                break
            tree[node] = least

    def rank(i: int, j: int) -> int:
        found = of.get((ids[i], ids[j])) if 0 <= i and j < n else None
        return none if found is None else found[0] * width + i

    while tree[1] < none:
        i = tree[1] % width
        gone = after[i]
        ids[i] = of[ids[i], ids[gone]][1]
        right, left = after[gone], before[i]
        after[i] = right
        if right < n:
            before[right] = i
        put(gone, none)
        put(i, rank(i, right))
        if left >= 0:
            put(left, rank(left, i))
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def _side_by_side(ids: np.ndarray, sizes: np.ndarray, merges: Merges) -> list[bytes]:
    """What is left of each row of ``ids``, a width of a power of two, as 32-bit numbers."""
    rows, width = ids.shape
    kind = np.int32 if (merges.none + 1) * width < 1 << 31 else np.int64
    none = kind(merges.none * width)
    place = np.arange(width, dtype=kind)
    leaves = np.full((rows, width), none, kind)
    ranks = merges.ranks(ids[:, :-1], ids[:, 1:]).astype(kind)
    ranks[place[None, 1:] >= sizes[:, None]] = merges.none
    leaves[:, :-1] = np.where(ranks < merges.none, ranks * width + place[:-1], none)
    tree = np.empty((rows, 2 * width), kind)
    tree[:, width:] = leaves
    half = width // 2
    while half:
        tree[:, half:2 * half] = np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2])
        half //= 2
    # The place after the last one is the row's size; before the first stands -1.
    after = np.tile(place + 1, (rows, 1))
    before = np.tile(place - 1, (rows, 1))
    alive = place[None, :] < sizes[:, None]
    tree_, ids_, after_, before_, alive_ = (x.reshape(-1) for x in (tree, ids, after, before, alive))
    todo = np.flatnonzero(tree[:, 1] < none)
    while len(todo):
        base, root = todo * width, tree_[todo * 2 * width + 1]
        i, rank = root % width, root // width
        gone = after_[base + i]
        right, left = after_[base + gone], before_[base + i]
        ids_[base + i] = merges.made[rank]
        after_[base + i] = right
        alive_[base + gone] = False
        some = right < sizes[todo]
        before_[(base + right)[some]] = i[some]
        new = np.full((3, len(todo)), none, kind)
        for k, (a, b, has) in enumerate(((i, right, some), (left, i, left >= 0)), 1):
            found = merges.ranks(ids_[(base + a)[has]], ids_[(base + b)[has]]).astype(kind)
            new[k, has] = np.where(found < merges.none, found * width + a[has], none)
        # Without a symbol before it, the pair's own leaf is put again.
        new[2] = np.where(left >= 0, new[2], new[1])
        node = np.stack([gone, i, np.where(left >= 0, left, i)]) + width
        top = todo * 2 * width
        tree_[top + node] = new
        while True:
            node >>= 1
            at = top + node
            tree_[at] = np.minimum(tree_[at + node], tree_[at + node + 1])
            if node[0, 0] == 1:
                break
        todo = todo[tree_[top + 1] < none]
    left_over = ids_[alive_].astype("<u4").tobytes()
    ends = np.cumsum(alive.sum(axis=1)) * 4
    return [left_over[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def merged_many(sequences: list[bytes], byte_ids: np.ndarray, merges: Merges) -> list[bytes]:
    """What is left of each sequence of bytes, as little-endian 32-bit numbers; ``byte_ids`` are the bytes' symbols."""
    sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
    out: list[bytes] = [b""] * len(sequences)
    low = 1
    for width in (1, 2, 4, 8, 16, 32, SHORT):
        group = np.flatnonzero((sizes >= low) & (sizes <= width))
        low = width + 1
        step = max(1, FOREST // width)
        for at in range(0, len(group), step):
            some = group[at:at + step]
            raw = b"".join([sequences[k].ljust(width, b"\0") for k in some.tolist()])
            ids = byte_ids[np.frombuffer(raw, np.uint8).reshape(len(some), width)].astype(np.int32)
            found = _side_by_side(ids, sizes[some], merges) if width > 1 else [x.tobytes() for x in ids[:, 0].astype("<u4")]
            for k, x in zip(some.tolist(), found, strict=True):
                out[k] = x
    for k in np.flatnonzero(sizes > SHORT).tolist():
        out[k] = np.array(merged(byte_ids[np.frombuffer(sequences[k], np.uint8)].tolist(), merges), "<u4").tobytes()
    return out
