"""Rounds of votes over links packed in a grid, see ``grid``.

A part's labels are arrays, and a round sends them to the blocks of the part.
There the votes of a block are summed per (vertex, label) and packed, sorted, as
differences; so in the first rounds a vote is a few bytes, and once labels settle
there is one for each label that a vertex still sees. The vertices of a part
are dealt to slices of at most about ``SLICE_LINKS`` links, and the votes of a
slice meet in one task. It chooses the labels and may keep the votes beside
them, packed: then a round can send corrections alone, minus the vote for the
old label and plus the one for the new, of those vertices that changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.operators.grid import CHUNK, Grid, _codec

#: Links of the vertices that choose in one task, about.
SLICE_LINKS = 4_000_000

#: ``label`` has the labels of a slice; ``moved`` and ``was`` are the places that changed and their labels before.
STATE = "part int, sub int, label binary, moved binary, was binary, codes binary, names binary, votes binary, changed bigint, messages bigint"
SENT = "part int, sub int, codes binary, names binary, votes binary"


def slices_for(links: int, parts: int) -> int:
    return max(1, -(-links // (parts * SLICE_LINKS)))


def _tally():
    """Functions that sum, pack and unpack votes; made here, so that workers need not have this package."""
    packed, unpacked, _, _, _ = _codec()

    def summed(codes: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each code once with its votes, in order, those that come to nothing left out."""
        if not len(codes):
            return codes, votes
        order = np.argsort(codes)
        codes = codes[order]
        first = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
        total = np.add.reduceat(votes[order], first)
        return codes[first][total != 0], total[total != 0]

    def coded(place: np.ndarray, label: np.ndarray, votes: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """Votes in the order of place and label; nothing is said where all are one."""
        names, at = np.unique(label, return_inverse=True)
        return packed(place * max(1, len(names)) + at), packed(names), packed(votes) if (votes != 1).any() else b""

    def decoded(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        names, codes = unpacked(row["names"]), unpacked(row["codes"])
        place, at = np.divmod(codes, max(1, len(names)))
        return place, names[at], unpacked(row["votes"]) if row["votes"] else np.ones(len(codes), np.int64)

    return summed, coded, decoded


def _kinds(schema: str) -> list[tuple[str, pa.DataType]]:
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return [(name, types[kind]) for name, kind in (x.split() for x in schema.split(", "))]


def _as_table():
    """A function that makes a table of rows; made here for the same reason."""

    def as_table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
        columns = list(zip(*rows)) or [[]] * len(schema)
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, schema)], [name for name, _ in schema])

    return as_table


def _voter(slices: int, corrections: bool, chunk: int):
    _, unpacked, _, _, _ = _codec()
    summed, coded, _ = _tally()
    kinds, as_table = _kinds(SENT), _as_table()

    def vote(sent: pa.Table, block: pa.Table) -> pa.Table:
        if not sent.num_rows or not block.num_rows:
            return as_table([], kinds)
        parts = sent.to_pylist()
        size = sum(len(x["label"]) for x in parts) // 8
        label = np.empty(size, np.int64)
        before, moved = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for x in parts:
            label[x["sub"]::slices] = np.frombuffer(x["label"], np.int64)
            if corrections:
                moved.append(unpacked(x["moved"]) * slices + x["sub"])
                before.append(np.frombuffer(x["was"], np.int64))
        moved = np.concatenate(moved)
        names, at = np.unique(np.concatenate([label, *before]), return_inverse=True)
        now, was, turned = at[:size], at[:size].copy(), np.zeros(size, bool)
        was[moved], turned[moved] = at[size:], True
        n_dst, goes_to = block["n_dst"][0].as_py(), parts[0]["goes_to"]
        width = -(-n_dst // slices)
        out: list[tuple] = []

        def put(codes: np.ndarray, votes: np.ndarray) -> None:
            ends = np.searchsorted(codes, np.arange(slices + 1) * width * len(names))
            for sub in range(slices):
                a, b = ends[sub], ends[sub + 1]
                if a < b:
                    place, at = np.divmod(codes[a:b] - sub * width * len(names), len(names))
                    out.append((goes_to, sub, *coded(place, names[at], votes[a:b])))

        codes, votes = np.empty(0, np.int64), np.empty(0, np.int64)
        for links, copies in zip(block["links"], block["copies"]):
            u, v = np.divmod(unpacked(links.as_py()), n_dst)
            often = unpacked(copies.as_py()) if copies.as_py() else np.ones(len(u), np.int64)
            if corrections:
                meant = turned[u]
                u, v, often = u[meant], v[meant], often[meant]
            base = ((v % slices) * width + v // slices) * len(names)
            more, these = [base + now[u]], [often]
            if corrections:
                more.append(base + was[u])
                these.append(-often)
            codes, votes = summed(np.concatenate([codes, *more]), np.concatenate([votes, *these]))
            if len(codes) >= chunk:
                put(codes, votes)
                codes, votes = codes[:0], votes[:0]
        put(codes, votes)
        return as_table(out, kinds)

    return vote


def _chooser(keep: bool, corrections: bool):
    packed, _, _, _, _ = _codec()
    summed, coded, decoded = _tally()
    kinds, as_table = _kinds(STATE), _as_table()

    def choose(sent: pa.Table, state: pa.Table) -> pa.Table:
        own = state.to_pylist()[0]
        label = np.frombuffer(own["label"], np.int64)

        def together(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            found = [decoded(x) for x in rows] or [[np.empty(0, np.int64)] * 3]
            place, name, votes = (np.concatenate(x) for x in zip(*found))
            names, at = np.unique(name, return_inverse=True)
            codes, votes = summed(place * max(1, len(names)) + at, votes)
            place, at = np.divmod(codes, max(1, len(names)))
            return place, names[at], votes

        rows = sent.to_pylist()
        place, name, votes = together(rows)
        messages = len(place)
        if corrections and own["codes"] is not None:
            place, name, votes = together([own, *rows])
        order = np.lexsort((name, -votes, place))
        first = order[np.flatnonzero(np.diff(place[order], prepend=-1))]
        after = label.copy()
        after[place[first]] = name[first]
        moved = np.flatnonzero(after != label)
        kept = coded(place, name, votes) if keep else (None, None, None)
        row = (own["part"], own["sub"], after.tobytes(), packed(moved), label[moved].tobytes(), *kept, len(moved), messages)
        return as_table([row], kinds)

    return choose


class Ballots:
    """The labels of a grid's vertices, for rounds of votes over its links; ids are whole numbers."""

    def __init__(self, grid: Grid, slices: int):
        self.grid, self.slices = grid, slices

    def start(self) -> DataFrame:
        """Every vertex with its own id as its label."""
        slices, listed, kinds, as_table = self.slices, _codec()[3], _kinds(STATE), _as_table()

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, ids in zip(batch["part"].to_pylist(), batch["ids"].to_pylist()):
                    label = listed(ids).to_numpy().astype(np.int64)
                    rows = [(part, sub, label[sub::slices].tobytes(), None, None, None, None, None, 0, 0) for sub in range(slices)]
                    yield from as_table(rows, kinds).to_batches()

        return self.grid.ids.select("part", "ids").mapInArrow(fill, STATE)

    def round(self, state: DataFrame, corrections: bool, keep: bool) -> DataFrame:
        """The next state; ``state`` must have been written, and hold votes where only corrections are sent."""
        told = ["label", "moved", "was"] if corrections else ["label"]
        to = F.broadcast(self.grid.targets.filter("NOT own").select("part", "key", "goes_to"))
        sent = state.select("part", "sub", *told).join(to, "part").select("key", "goes_to", "sub", *told)
        votes = sent.groupBy("key").cogroup(self.grid.blocks.groupBy("key")).applyInArrow(
            _voter(self.slices, corrections, CHUNK), SENT)
        return votes.groupBy("part", "sub").cogroup(state.groupBy("part", "sub")).applyInArrow(
            _chooser(keep, corrections), STATE)

    def rows(self, state: DataFrame) -> DataFrame:
        """``id, label``."""
        slices, listed, kind = self.slices, _codec()[3], self.grid.kind

        def unfold(ids: pa.Table, state: pa.Table) -> pa.Table:
            held = listed(ids["ids"][0].as_py())
            label = np.empty(len(held), np.int64)
            for x in state.to_pylist():
                label[x["sub"]::slices] = np.frombuffer(x["label"], np.int64)
            return pa.table([held, pa.array(label).cast(held.type)], ["id", "label"])

        return self.grid.ids.groupBy("part").cogroup(state.select("part", "sub", "label").groupBy("part")).applyInArrow(
            unfold, f"id {kind}, label {kind}")
