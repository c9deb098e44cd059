"""Triangles and local clustering, by cells of vertex colours.

Vertices are hashed to ``c`` colours. A cell is a choice of three colours, and
each edge goes to the ``c`` cells that have both of its ends' colours, so a
triangle has all of its edges in exactly one cell that matches its colours:
what is shuffled is ``c`` times the edges, whatever lists the vertices have.
Edges travel in blocks, one for each two colours: a block is made once, its
edges sorted, as differences and packed (two or three bytes an edge), and it is
blocks that are copied to the cells, some of the cells after the others, so that
the copies on disk at a time are about ``COPIED_EDGES`` at most. In
a cell, edges are turned from lower to higher degree, which bounds every list of
neighbours by the square root of twice the cell's edges, and the lists stand
sorted side by side; an edge is closed by looking the shorter of its ends' lists
up among the edges of the other end.

``c`` grows with the square root of the edges, so that a cell holds about
``PACKED_EDGES``. A vertex with more than ``CELL_EDGES / 8`` edges is a hub: it would
make all cells of its colour hot. Triangles with a hub are counted apart, by the
lists of hubs next to the two ends of each edge; there are few hubs (fewer than
16 times the edges by ``CELL_EDGES``), so these lists are short.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import Workspace
from edgeworks.operators.graph import Graph, canonical_edges, degrees, hot_vertices
from edgeworks.operators.skew import spread_join

#: Edges of a cell of rows, about; a cell is not made smaller than the second for the sake of more tasks.
CELL_EDGES, SMALL_CELL = 2_000_000, 100_000
#: Edges of a cell of packed blocks, about.
PACKED_EDGES = 10_000_000
#: Copies of edges, two or three bytes each, that lie in shuffle files at a time.
COPIED_EDGES = 2_000_000_000
#: Candidates that are looked up at a time in a cell.
LOOKED_UP = 1 << 21


def colours_for(edges: int, tasks: int, cell_edges: int = CELL_EDGES, small_cell: int = SMALL_CELL) -> int:
    """How many colours keep cells at ``cell_edges``, or below it while tasks would be idle.

    A cell of three colours holds six edges in the square of the colours.
    """
    needed = math.ceil(math.sqrt(6 * edges / cell_edges))
    sensible = math.isqrt(6 * edges // small_cell)
    # Twice as many cells as tasks, for cells with equal colours are smaller.
    wide = next(c for c in range(1, 2 * tasks + 1) if math.comb(c + 2, 3) >= 2 * tasks)
    return max(1, needed, min(wide, sensible))


def _coloured(edges: DataFrame, colours: int) -> DataFrame:
    """``src, dst`` with the colours ``a`` and ``b`` of the ends."""
    n = F.lit(colours).cast("bigint")
    return edges.select("src", "dst", *(F.pmod(F.xxhash64(side), n).cast("int").alias(name) for side, name in (("src", "a"), ("dst", "b"))))


def _each_cell(rows: DataFrame, colours: int) -> tuple[DataFrame, Column]:
    """Rows of two colours ``a`` and ``b``, once for each third ``c``, and the number of the cell."""
    n = F.lit(colours).cast("bigint")
    third = F.explode(F.sequence(F.lit(0), F.lit(colours - 1))).alias("c")
    low, high = F.least("a", "b", "c"), F.greatest("a", "b", "c")
    middle = F.col("a") + F.col("b") + F.col("c") - low - high
    return rows.select("*", third), ((low * n + middle) * n + high).alias("cell")


def colour_cells(edges: DataFrame, colours: int) -> DataFrame:
    """``cell, src, dst, a, b``: every edge once in each cell that has its ends' colours ``a`` and ``b``.

    The cell of the colours x <= y <= z is numbered ``(x * colours + y) * colours + z``.
    """
    rows, cell = _each_cell(_coloured(edges, colours), colours)
    return rows.select(cell, "src", "dst", "a", "b")


#: A block: the colours, how many ids have the first of them, the ids of either colour in order, the edges.
BLOCK = "a bigint, b bigint, n_first bigint, ids binary, edges binary"


def _packer():
    """The function that packs the edges of one block; made here, so that workers need not have this package."""

    def packed(values: np.ndarray) -> bytes:
        # Differences, lowest bytes of all first: the high ones are zeros nearly everywhere.
        gaps = np.diff(values.astype(np.int64), prepend=0)
        return zlib.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)

    def stored(ids: pa.Array) -> bytes:
        if pa.types.is_integer(ids.type):
            return packed(ids.to_numpy(zero_copy_only=False))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as writer:
            writer.write_table(pa.table([ids], ["id"]))
        return zlib.compress(sink.getvalue().to_pybytes(), 1)

    def pack(rows: pa.Table) -> pa.Table:
        a, b = rows["a"][0].as_py(), rows["b"][0].as_py()
        sides = [rows["src"].chunks, rows["dst"].chunks]
        kind = rows["src"].type
        if a == b:
            every = [pa.chunked_array(sides[0] + sides[1], kind)] * 2
        else:
            every = [pa.chunked_array(side, kind) for side in sides]
        lists = []
        for values in every[: 1 if a == b else 2]:
            ids = pc.unique(values)
            lists.append(ids.take(pc.sort_indices(ids)))
        u, v = (pc.index_in(rows[name], value_set=lists[i % len(lists)]).to_numpy().astype(np.int64) for i, name in enumerate(("src", "dst")))
        if a == b:
            u, v = np.minimum(u, v), np.maximum(u, v)
        ids = pa.concat_arrays(lists)
        return pa.table(
            [pa.array([x]) for x in (a, b, len(lists[0]), stored(ids), packed(np.sort(u * len(lists[-1]) + v)))],
            ["a", "b", "n_first", "ids", "edges"])

    return pack


def _unpackers(kind: str):
    """Functions that unpack edges and lists of ids."""
    integers = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}.get(kind)

    def unpacked(data: bytes) -> np.ndarray:
        planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
        return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())

    def listed(data: bytes) -> pa.Array:
        if integers is not None:
            return pa.array(unpacked(data)).cast(integers)
        ids = pa.ipc.open_stream(zlib.decompress(data)).read_all()["id"].combine_chunks()
        return pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids

    return unpacked, listed


def _closer(colours: int, kind: str, looked_up: int = LOOKED_UP):
    """The function that closes the triangles of one cell; made here, so that workers need not have this package."""
    unpacked, listed = _unpackers(kind)

    def close(rows: pa.Table) -> pa.Table:
        cell = rows["cell"][0].as_py()
        blocks = rows.select(["a", "b", "n_first", "ids", "edges"]).to_pylist()
        lists = [listed(block["ids"]) for block in blocks]
        coded = pa.chunked_array(lists).combine_chunks().dictionary_encode()
        # Places and edges of a cell fit 32 bits, which halves what a worker holds.
        ids, places = coded.dictionary, coded.indices.to_numpy().astype(np.int32)
        n = len(ids)
        colour, us, vs, begin = np.zeros(n, np.int64), [], [], 0
        for block, known in zip(blocks, lists):
            own, first = places[begin:begin + len(known)], block["n_first"]
            begin += len(known)
            # Where both ends have one colour there is one list of ids.
            second = own[first:] if block["a"] != block["b"] else own
            colour[second], colour[own[:first]] = block["b"], block["a"]
            u, v = np.divmod(unpacked(block["edges"]), len(second))
            us.append(own[u])
            vs.append(second[v])
        u, v = np.concatenate(us), np.concatenate(vs)
        del us, vs, blocks, lists
        m = len(u)
        by_degree = np.argsort(np.bincount(u, minlength=n) + np.bincount(v, minlength=n), kind="stable")
        place = np.empty(n, np.int32)
        place[by_degree] = np.arange(n, dtype=np.int32)
        colour = colour[by_degree]
        u, v = place[u], place[v]
        codes = np.minimum(u, v).astype(np.int64)
        codes *= n
        codes += np.maximum(u, v)
        del u, v
        codes.sort()
        low = (codes // n).astype(np.int32)
        high = (codes - np.multiply(low, n, dtype=np.int64)).astype(np.int32)
        start = np.searchsorted(low, np.arange(n + 1, dtype=np.int32))
        out = np.diff(start)
        near = np.where(out[low] < out[high], low, high)
        edge = np.flatnonzero(out[near]).astype(np.int32)
        total = np.cumsum(out[near[edge]])
        counts, at = np.zeros(n, np.int64), 0
        wanted = sorted((cell // colours // colours, cell // colours % colours, cell % colours))
        while at < len(edge):
            done = total[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(total, done + looked_up, "right")))
            e = edge[at:upto]
            lists, x, y = near[e], low[e], high[e]
            size = out[lists]
            first = np.repeat(start[lists] - np.cumsum(size) + size, size)
            w = high[first + np.arange(len(first))]
            other = np.repeat(x + y - lists, size).astype(np.int64)
            key = other * n + w
            hit = codes[np.minimum(np.searchsorted(codes, key), m - 1)] == key
            x, y, w = np.repeat(x, size)[hit], np.repeat(y, size)[hit], w[hit]
            if len(set(wanted)) < 3:
                # Ends of one colour meet in more cells than the one that matches.
                fits = (np.sort(np.stack([colour[x], colour[y], colour[w]]), axis=0) == np.array(wanted)[:, None]).all(axis=0)
                x, y, w = x[fits], y[fits], w[fits]
            for corner in (x, y, w):
                counts += np.bincount(corner, minlength=n)
            at = upto
        found = np.flatnonzero(counts)
        return pa.table([ids.take(pa.array(by_degree[found])), pa.array(counts[found])], ["id", "n"])

    return close


def _in_blocks(edges: DataFrame, n_edges: int, colours: int) -> DataFrame:
    """The edges packed in blocks, one for each two colours, as ``BLOCK`` says."""
    # An edge between two colours stands in their block with the lower one first.
    rows, turned = _coloured(edges, colours), F.col("a") > F.col("b")
    rows = rows.select(*(F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("src", "dst"), ("dst", "src"), ("a", "b"), ("b", "a"))))
    parts = min(math.comb(colours + 1, 2), _most_tasks(edges, n_edges))
    return rows.repartition(parts, "a", "b").groupBy("a", "b").applyInArrow(_packer(), BLOCK)


def _most_tasks(rows: DataFrame, n_edges: int) -> int:
    """Small in bytes, a block or cell is much work: they are not to be put together again."""
    return max(4 * rows.sparkSession.sparkContext.defaultParallelism, n_edges // SMALL_CELL)


def _in_cells(work: Workspace, blocks: DataFrame, n_edges: int, colours: int, kind: str) -> DataFrame:
    """``id, n``: triangles of the vertices, cell by cell; each pass over the written blocks takes a share of the cells."""
    passes = max(1, -(-n_edges * colours // COPIED_EDGES))
    parts = min(-(-math.comb(colours + 2, 3) // passes), _most_tasks(blocks, n_edges))
    found = None
    for number in range(passes):
        copies, cell = _each_cell(blocks, colours)
        cells = copies.select(cell, "a", "b", "n_first", "ids", "edges")
        if passes > 1:
            cells = cells.filter(F.pmod(F.xxhash64("cell"), F.lit(passes).cast("bigint")) == number)
        credits = cells.repartition(parts, "cell").groupBy("cell").applyInArrow(_closer(colours, kind), f"id {kind}, n bigint")
        if passes > 1:
            credits, _ = work.keep(credits.groupBy("id").agg(F.sum("n").alias("n")), "credits")
        found = credits if found is None else found.unionAll(credits)
    return found


def _counter(kind: str):
    """The function that counts the edges of the vertices of packed blocks; made here, so that workers need not have this package."""
    unpacked, listed = _unpackers(kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids, first = listed(block["ids"]), block["n_first"]
                # Where both ends have one colour there is one list of ids.
                same = block["a"] == block["b"]
                u, v = np.divmod(unpacked(block["edges"]), first if same else len(ids) - first)
                n = np.bincount(np.concatenate([u, v if same else v + first]), minlength=len(ids))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64())], ["id", "n"])

    return count


def _with_hubs(work: Workspace, marked: DataFrame, hubs: DataFrame) -> DataFrame:
    """``id, n``: triangles with a hub; ``marked`` edges tell which ends are hubs.

    Vertices are in an order, hubs last. A triangle's first two are an edge, and
    its last is a hub in both of their lists of later hubs.
    """
    turned = F.col("src_hub") & ~F.col("dst_hub")
    edges = marked.select(
        F.when(turned, F.col("dst")).otherwise(F.col("src")).alias("u"),
        F.when(turned, F.col("src")).otherwise(F.col("dst")).alias("v"),
        (F.col("src_hub") | F.col("dst_hub")).alias("hub"))
    lists, _ = work.keep(edges.filter("hub").groupBy(F.col("u").alias("id")).agg(F.collect_set("v").alias("later")), "hub-lists")
    hot = hubs.withColumnRenamed(hubs.columns[0], "id")
    met = edges.select("u", "v")
    for side, other in (("u", "v"), ("v", "u")):
        known = lists.select(F.col("id").alias(side), F.col("later").alias(f"{side}_later"))
        met = spread_join(met, known, side, hot, by=[other])
    met = met.select("u", "v", F.array_intersect("u_later", "v_later").alias("common")).filter(F.size("common") > 0)
    n = F.size("common").cast("bigint")
    credit = F.concat(
        F.array(F.struct(F.col("u").alias("id"), n.alias("n")), F.struct(F.col("v").alias("id"), n.alias("n"))),
        F.transform("common", lambda x: F.struct(x.alias("id"), F.lit(1).cast("bigint").alias("n"))))
    return met.select(F.inline(credit))


def _counted(
    graph: Graph, min_hot_rows: int | None, cell_edges: int | None, with_degrees: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """``id, triangles`` for vertices in triangles, and all degrees if asked for."""
    hub_rows = max(1, (CELL_EDGES if cell_edges is None else cell_edges) // 8) if min_hot_rows is None else min_hot_rows
    cell_edges = PACKED_EDGES if cell_edges is None else cell_edges
    work = Workspace(graph.edges.sparkSession)
    edges, seen = work.keep(canonical_edges(graph.edges), "edges")
    kind, n_edges = edges.schema["src"].dataType.simpleString(), seen["rows"]
    colours = colours_for(n_edges, work.spark.sparkContext.defaultParallelism, cell_edges, min(SMALL_CELL, cell_edges))
    hubs, plain, degree = hot_vertices(edges, min_rows=hub_rows), edges, None
    if hubs is not None:
        marked = edges
        for side in ("src", "dst"):
            flag = hubs.select(F.col("id").alias(side), F.lit(True).alias(f"{side}_hub"))
            marked = spread_join(marked, flag, side, hubs, by=["src", "dst"], how="left")
        marked = marked.na.fill(False, ["src_hub", "dst_hub"]).select("src", "dst", "src_hub", "dst_hub")
        marked, _ = work.keep(marked, "marked")
        plain = marked.filter("NOT src_hub AND NOT dst_hub").select("src", "dst")
    blocks, _ = work.keep(_in_blocks(plain, n_edges, colours), "blocks")
    if with_degrees:
        # A block has one row for each of its vertices to add, not one for each end of an edge.
        ends = degrees(edges).withColumnRenamed("degree", "n") if hubs is not None else blocks.mapInArrow(
            _counter(kind), f"id {kind}, n bigint")
        degree, _ = work.keep(ends.groupBy("id").agg(F.sum("n").alias("degree")), "degrees")
    work.drop(edges)
    credits = _in_cells(work, blocks, n_edges, colours, kind)
    if hubs is not None:
        credits = credits.unionAll(_with_hubs(work, marked, hubs))
    found, _ = work.keep(credits.groupBy("id").agg(F.sum("n").alias("triangles")), "triangles")
    work.clear(*(x for x in (degree, found) if x is not None))
    return found, degree


def triangle_count(graph: Graph, min_hot_rows: int | None = None, cell_edges: int | None = None) -> DataFrame:
    """``id, count`` for every vertex; direction, copies and loops of edges
    do not matter. ``min_hot_rows`` is the degree above which a vertex is a hub."""
    found, _ = _counted(graph, min_hot_rows, cell_edges)
    count = F.coalesce("triangles", F.lit(0)).cast("bigint")
    return graph.vertices.select("id").join(found, "id", "left").select("id", count.alias("count"))


def clustering_coefficient(graph: Graph, min_hot_rows: int | None = None, cell_edges: int | None = None) -> DataFrame:
    """``id, coefficient``: which share of the pairs of neighbours is joined;
    0 for a vertex with fewer than two neighbours."""
    found, degree = _counted(graph, min_hot_rows, cell_edges, with_degrees=True)
    d, t = F.col("degree"), F.coalesce("triangles", F.lit(0))
    share = F.when(d > 1, 2.0 * t / (d * (d - 1))).otherwise(F.lit(0.0))
    joined = graph.vertices.select("id").join(degree, "id", "left").join(found, "id", "left")
    return joined.select("id", share.alias("coefficient"))
