"""Greedy matching over edges packed in a grid, see ``grid``.

A link's number is the edge's place in the random order. In a round the blocks
learn which vertices still take part, one bit each, and send for each vertex of
theirs the first edge between two of these. A part takes the first of what
its blocks say, tells the parts of the named vertices, and vertices that name
each other are chosen. So edges travel once, packed, and dead ones send nothing.
Hubs need no care: a vertex is one number of each block, whatever its edges are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import Workspace
from edgeworks.operators import grid
from edgeworks.operators.graph import vertices_of
from edgeworks.operators.votes import _as_table, _kinds

#: Edges of a block, about, with eight bytes of order each, and edges from which a grid is worth its jobs.
BLOCK_EDGES, LEAST_EDGES = 16_000_000, 4_000_000

#: ``live`` has a bit for each vertex; ``places`` and ``mates`` are the vertices chosen in the round and the ids they are matched with.
STATE = "part int, n bigint, live binary, places binary, mates binary, chosen bigint, going bigint"
FIRST = "part int, mate_part int, places binary, priorities binary, mates binary"
NAMED = "part int, told_by int, n bigint, places binary, mates binary, mate_parts binary, ids binary"
_LAST = np.iinfo(np.int64).max


def _namer():
    _, unpacked, _, _, _ = grid._codec()
    packed, kinds, as_table, last = grid._codec()[0], _kinds(FIRST), _as_table(), _LAST

    def name(sent: pa.Table, block: pa.Table) -> pa.Table:
        ends = {x["side"]: x for x in sent.to_pylist()}
        if len(ends) < 2 or not block.num_rows:
            return as_table([], kinds)
        bits = [np.unpackbits(np.frombuffer(x["live"], np.uint8), count=x["n"], bitorder="little").astype(bool) for x in (ends["src"], ends["dst"])]
        first = [(np.full(len(x), last), np.zeros(len(x), np.int64)) for x in bits]
        if not (bits[0].any() and bits[1].any()):
            return as_table([], kinds)
        for links, priorities in zip(block["links"], block["copies"]):
            u, v = np.divmod(unpacked(links.as_py()), len(bits[1]))
            order = unpacked(priorities.as_py()) if priorities.as_py() else np.ones(len(u), np.int64)
            meant = bits[0][u] & bits[1][v]
            u, v, order = u[meant], v[meant], order[meant]
            for (least, mate), at, other in zip(first, (u, v), (v, u)):
                np.minimum.at(least, at, order)
                said = least[at] == order
                mate[at[said]] = other[said]
        out = []
        for (least, mate), mine, other in zip(first, ("src", "dst"), ("dst", "src")):
            found = np.flatnonzero(least != last)
            if len(found):
                out.append((ends[mine]["part"], ends[other]["part"], packed(found), least[found].tobytes(), packed(mate[found])))
        return as_table(out, kinds)

    return name


def _teller():
    packed, unpacked, _, listed, _ = grid._codec()
    kinds, as_table, last = _kinds(NAMED), _as_table(), _LAST

    def tell(said: pa.Table, own: pa.Table) -> pa.Table:
        part, n = own["part"][0].as_py(), own["n"][0].as_py()
        least, mate, mate_part = np.full(n, last), np.zeros(n, np.int64), np.full(n, -1)
        for at in range(said.num_rows):
            row = {name: said[name][at].as_py() for name in said.column_names}
            places, order = unpacked(row["places"]), np.frombuffer(row["priorities"], np.int64)
            better = order < least[places]
            places = places[better]
            least[places], mate[places], mate_part[places] = order[better], unpacked(row["mates"])[better], row["mate_part"]
        named = np.flatnonzero(mate_part >= 0)
        rows = [(part, None, n, packed(named), packed(mate[named]), packed(mate_part[named]), None)]
        ids = listed(own["ids"][0].as_py()).to_numpy().astype(np.int64) if len(named) else None
        for to in np.unique(mate_part[named]).tolist():
            at = np.flatnonzero(mate_part == to)
            rows.append((to, part, n, packed(at), packed(mate[at]), None, packed(ids[at])))
        return as_table(rows, kinds)

    return tell


def _matcher():
    packed, unpacked, _, _, _ = grid._codec()
    kinds, as_table = _kinds(STATE), _as_table()

    def match(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        own = next(x for x in rows if x["told_by"] is None)
        n, named = own["n"], unpacked(own["places"])
        mate, mate_part, live = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, bool)
        mate[named], mate_part[named], live[named] = unpacked(own["mates"]), unpacked(own["mate_parts"]), True
        places, ids = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for x in rows:
            if x["told_by"] is not None:
                theirs, mine = unpacked(x["places"]), unpacked(x["mates"])
                met = (mate_part[mine] == x["told_by"]) & (mate[mine] == theirs)
                places.append(mine[met])
                ids.append(unpacked(x["ids"])[met])
        places, ids = np.concatenate(places), np.concatenate(ids)
        live[places] = False
        row = (own["part"], n, np.packbits(live, bitorder="little").tobytes(), packed(places), packed(ids), len(places), int(live.sum()))
        return as_table([row], kinds)

    return match


def parts_for(edges: int, vertices: int, tasks: int) -> int:
    return max(grid.parts_for(edges, vertices, tasks), math.ceil(math.sqrt(edges / BLOCK_EDGES)))


def pays(edges: DataFrame, n_edges: int) -> bool:
    """Whether the edges are many enough, and their ids whole numbers."""
    return n_edges >= LEAST_EDGES and {edges.schema[x].dataType.simpleString() for x in ("src", "dst")} in ({"int"}, {"bigint"})


def greedy_rounds(work: Workspace, edges: DataFrame, n_edges: int, label: int | None = None) -> DataFrame | None:
    """``src, dst, round``: the greedy matching of edges ``src, dst, priority``, each given once and without null ends.

    ``round`` is ``label``, or the number of the greedy round; None without a choice.
    """
    spark = edges.sparkSession
    vertices, seen = work.keep(vertices_of(edges).withColumn("out", F.lit(0).cast("bigint")), "ends")
    if not seen["rows"]:
        return None
    states, done = [], 0
    parts = parts_for(n_edges, seen["rows"], spark.sparkContext.defaultParallelism)
    with grid.Grid(edges.select("src", "dst", F.col("priority").alias("copies")), vertices, parts) as blocks:
        state = _all_live(blocks)
        while True:
            done += 1
            state, seen = work.keep(_round(blocks, state), "greedy", chosen=F.sum("chosen"), going=F.sum("going"))
            if not seen.get("chosen"):
                break
            states.append(state.select("part", "places", "mates", F.lit(done if label is None else label).alias("round")))
            if not seen["going"]:
                break
        if not states:
            return None
        every = states[0]
        for one in states[1:]:
            every = every.unionAll(one)
        return work.keep(_pairs(blocks, every), "chosen")[0]


def _all_live(blocks: grid.Grid) -> DataFrame:
    kinds, as_table = _kinds("part int, n bigint, live binary"), _as_table()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(part, n, np.packbits(np.ones(n, bool), bitorder="little").tobytes()) for part, n in zip(batch["part"].to_pylist(), batch["n"].to_pylist())]
            yield from as_table(rows, kinds).to_batches()

    return blocks.ids.select("part", "n").mapInArrow(fill, "part int, n bigint, live binary")


def _round(blocks: grid.Grid, state: DataFrame) -> DataFrame:
    to = blocks.targets.filter("NOT own")
    sides = {"src": to.select("part", "key"), "dst": to.select(F.col("goes_to").alias("part"), "key")}
    sent = [state.select("part", "n", "live").join(F.broadcast(x), "part").withColumn("side", F.lit(side)) for side, x in sides.items()]
    said = sent[0].unionByName(sent[1]).groupBy("key").cogroup(blocks.blocks.groupBy("key")).applyInArrow(_namer(), FIRST)
    named = said.groupBy("part").cogroup(blocks.ids.select("part", "n", "ids").groupBy("part")).applyInArrow(_teller(), NAMED)
    return named.groupBy("part").applyInArrow(_matcher(), STATE)


def _pairs(blocks: grid.Grid, chosen: DataFrame) -> DataFrame:
    """Both ends know their mate; the lesser one tells."""
    _, unpacked, _, listed, _ = grid._codec()

    def unfold(rows: pa.Table, own: pa.Table) -> pa.Table:
        held = listed(own["ids"][0].as_py())
        ids, out = held.to_numpy().astype(np.int64), [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))]
        for x in rows.to_pylist():
            src, dst = ids[unpacked(x["places"])], unpacked(x["mates"])
            less = src < dst
            out.append((src[less], dst[less], np.full(int(less.sum()), x["round"], np.int32)))
        src, dst, number = (pa.array(np.concatenate(x)) for x in zip(*out))
        return pa.table([src.cast(held.type), dst.cast(held.type), number], ["src", "dst", "round"])

    return chosen.groupBy("part").cogroup(blocks.ids.select("part", "ids").groupBy("part")).applyInArrow(
        unfold, f"src {blocks.kind}, dst {blocks.kind}, round int")
