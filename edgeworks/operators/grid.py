"""Links packed in a grid of blocks, for rounds in which vertices send numbers that are summed.

Vertices are hashed to ``n`` parts, and a link lies in the block of its ends' two
parts. Links travel once, packed: sorted, as differences, four or five bytes
each. A part's numbers are one array, in the order of its ids; in a round it goes
to the ``n`` blocks of the part, which hold places in it in place of ids and
send back one array of sums. So a round shuffles ``2 * n`` numbers a vertex,
whatever the links are, and no id. ``n`` grows with the square root of the links
where a block would hold more than ``BLOCK_LINKS``. A block that has more than that all
the same, for a hub, is divided; each piece gets the array.

For sparse graphs, with few links a vertex, ``routes`` moves less; see ``pays``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import SHUFFLE_PARTS, freed_shuffles

#: Links of a block, about, and vertices of a part, about; a block is not made smaller than the third for more tasks.
BLOCK_LINKS, PART_VERTICES, SMALL_BLOCK = 48_000_000, 4_000_000, 1_000_000
#: Links that are packed together.
CHUNK = 2_000_000
#: Shuffled bytes of a number in an array, and of a number with its id in a row.
IN_ARRAY, IN_ROW = 8, 12

CHUNKS = "block int, n bigint, srcs binary, dsts binary, links binary, copies binary"
PLACED = "key int, n_dst bigint, outs binary, links binary, copies binary"


def parts_for(links: int, vertices: int, tasks: int) -> int:
    """Parts that keep blocks and arrays at their size, or below it while tasks would be idle."""
    wide = min(math.ceil(math.sqrt(tasks)), math.ceil(math.sqrt(links / SMALL_BLOCK)))
    return max(1, wide, math.ceil(math.sqrt(links / BLOCK_LINKS)), math.ceil(vertices / PART_VERTICES))


def pays(links: int, vertices: int, parts: int) -> bool:
    """Whether a round of arrays shuffles less than a row for every link."""
    return 2 * parts * vertices * IN_ARRAY < links * IN_ROW


def _codec():
    """Functions that pack sorted numbers and ids; made here, so that workers need not have this package."""

    def packed(values: np.ndarray) -> bytes:
        # Differences, lowest bytes of all first: the high ones are zeros nearly everywhere.
        gaps = np.diff(values.astype(np.int64), prepend=0)
        return zlib.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)

    def unpacked(data: bytes) -> np.ndarray:
        planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
        return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())

    def stored(ids: pa.Array) -> bytes:
        if pa.types.is_int64(ids.type) and not ids.null_count:
            return b"d" + packed(ids.to_numpy())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as writer:
            writer.write_table(pa.table([ids], ["id"]))
        return b"s" + zlib.compress(sink.getvalue().to_pybytes(), 1)

    def listed(data: bytes) -> pa.Array:
        if data[:1] == b"d":
            return pa.array(unpacked(data[1:]))
        ids = pa.ipc.open_stream(zlib.decompress(data[1:])).read_all()["id"].combine_chunks()
        return pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids

    def in_order(ids: pa.Array) -> pa.Array:
        return ids.take(pc.sort_indices(ids))

    return packed, unpacked, stored, listed, in_order


def _packer(chunk: int):
    packed, _, stored, _, in_order = _codec()

    def coded(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        ids = in_order(pc.unique(column))
        return ids, pc.index_in(column, value_set=ids).to_numpy().astype(np.int64)

    def of(rows: pa.RecordBatch) -> tuple:
        srcs, u = coded(rows["src"])
        dsts, v = coded(rows["dst"])
        codes = u * len(dsts) + v
        order, copies = np.argsort(codes), rows["copies"].to_numpy()
        # Nothing is said where no link has copies.
        often = packed(copies[order]) if (copies != 1).any() else b""
        return rows["block"][0].as_py(), len(codes), stored(srcs), stored(dsts), packed(codes[order]), often

    def blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = rows["block"].to_numpy()
        order = np.argsort(key, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            row = of(rows.take(pa.array(at)))
            kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], ["block", "n", "srcs", "dsts", "links", "copies"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= chunk:
                yield from blocks(held)
                held, size = [], 0
        if held:
            yield from blocks(held)

    return pack


def _lister():
    packed, _, stored, _, _ = _codec()

    def ids_of(rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows["id"])
        ids = pa.concat_arrays(rows["id"].take(order).chunks)
        outs = packed(rows["out"].take(order).to_numpy())
        return pa.table([pa.array([x], t) for x, t in (
            (rows["part"][0].as_py(), pa.int32()), (len(ids), pa.int64()), (stored(ids), pa.binary()), (outs, pa.binary()))],
            ["part", "n", "ids", "outs"])

    return ids_of


def _placer(chunk: int):
    packed, unpacked, _, listed, _ = _codec()

    def places(some: list[pa.Array], ids: pa.Array) -> list[np.ndarray]:
        if pa.types.is_integer(ids.type):
            known = ids.drop_null().to_numpy()
            return [
                np.where(x.is_null().to_numpy(False), len(known), np.searchsorted(known, x.fill_null(0).to_numpy()))
                for x in some]
        found = pc.index_in(pa.concat_arrays(some), value_set=ids).to_numpy().astype(np.int64)
        return np.split(found, np.cumsum([len(x) for x in some])[:-1])

    def place(chunks: pa.Table, ends: pa.Table) -> pa.Table:
        out = []
        if chunks.num_rows:
            ends = {row["side"]: row for row in ends.to_pylist()}
            srcs, dsts = listed(ends["src"]["ids"]), listed(ends["dst"]["ids"])
            key, n_dst, held, size = chunks["key"][0].as_py(), len(dsts), [], 0
            for at in range(chunks.num_rows):
                row = {name: chunks[name][at].as_py() for name in ("n", "srcs", "dsts", "links", "copies")}
                near, far = listed(row["srcs"]), listed(row["dsts"])
                u, v = np.divmod(unpacked(row["links"]), len(far))
                codes = places([near], srcs)[0][u] * n_dst + places([far], dsts)[0][v]
                held.append((codes, unpacked(row["copies"]) if row["copies"] else np.ones(len(codes), np.int64)))
                size += len(codes)
                if size >= chunk or at + 1 == chunks.num_rows:
                    codes, copies = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(codes)
                    often = packed(copies[order]) if (copies != 1).any() else b""
                    out.append((key, n_dst, None if out else ends["src"]["outs"], packed(codes[order]), often))
                    held, size = [], 0
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "n_dst", "outs", "links", "copies"])

    return place


def _summer(least: float | None):
    _, unpacked, _, _, _ = _codec()

    def carry(sent: pa.Table, block: pa.Table) -> pa.Table:
        row, sums = sent.slice(0, 1).to_pylist()[0] if sent.num_rows else None, None
        if row is not None and row["own"]:
            sums = row["numbers"]
        elif row is not None and block.num_rows:
            numbers = np.frombuffer(row["numbers"], np.float64)
            outs = np.array(unpacked(pc.drop_null(block["outs"])[0].as_py()))
            sends = outs > 0 if least is None else (outs > 0) & (numbers > least)
            unit = np.divide(numbers, outs, out=np.zeros(len(numbers)), where=sends)
            total = np.zeros(block["n_dst"][0].as_py())
            if sends.any():
                for links, copies in zip(block["links"], block["copies"]):
                    u, v = np.divmod(unpacked(links.as_py()), len(total))
                    share, often = unit[u], copies.as_py()
                    np.add.at(total, v, share * unpacked(often) if often else share)
            sums = total.tobytes()
        else:
            row = None
        rows = [] if row is None else [(row["goes_to"], row["own"], row["n"], sums)]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "own", "n", "numbers"])

    return carry


STATE = "part int, n bigint, value binary, held binary, total double, sending bigint"


def _merger(reset: float, least: float | None):
    def merge(rows: pa.Table) -> pa.Table:
        own = rows.filter(rows["own"]).slice(0, 1).to_pylist()[0]
        gained = np.zeros(own["n"])
        for numbers in rows.filter(pc.invert(rows["own"]))["numbers"]:
            gained += np.frombuffer(numbers.as_py(), np.float64)
        gained *= 1 - reset
        if least is None:
            rank = gained + reset
            said = (rank.tobytes(), None, rank.sum(), 0)
        else:
            rank = np.frombuffer(own["numbers"], np.float64) + gained
            said = (gained.tobytes(), rank.tobytes(), rank.sum(), int((gained > least).sum()))
        row = (own["part"], own["n"], *said)
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.int64())
        return pa.table([pa.array([x], t) for x, t in zip(row, kinds)], ["part", "n", "value", "held", "total", "sending"])

    return merge


class Grid:
    """Packed links of a graph, for loops that run, and end, inside a ``with`` block.

    ``links`` has ``src, dst, copies``, ``vertices`` each ``id`` once with the ``out``
    copies of its links; ends without a vertex there are not allowed.
    """

    def __init__(self, links: DataFrame, vertices: DataFrame, n_parts: int):
        spark, self.kind = links.sparkSession, links.schema["src"].dataType.simpleString()
        self.spark, self.usual = spark, spark.conf.get(SHUFFLE_PARTS)
        # Equal ids have equal hashes, null has one too.
        part = {c: F.pmod(F.xxhash64(c), F.lit(n_parts).cast("bigint")).cast("int") for c in ("src", "dst", "id")}
        self.ids = vertices.select(part["id"].alias("part"), "id", "out").groupBy("part").applyInArrow(
            _lister(), "part int, n bigint, ids binary, outs binary").persist(StorageLevel.MEMORY_AND_DISK)
        chunks = links.select("src", "dst", "copies", (part["src"] * n_parts + part["dst"]).alias("block")).mapInArrow(
            _packer(CHUNK), CHUNKS).persist(StorageLevel.MEMORY_AND_DISK)
        # One row for each block and each part.
        sizes = {row["block"]: row["n"] for row in chunks.groupBy("block").agg(F.sum("n").alias("n")).collect()}
        pieces = {block: -(-n // (2 * BLOCK_LINKS)) for block, n in sizes.items()}
        first, targets = {}, [(p, -1 - p, p, True) for p in range(n_parts)]
        for block in sorted(sizes):
            first[block] = len(targets) - n_parts
            targets += [(block // n_parts, first[block] + x, block % n_parts, False) for x in range(pieces[block])]
        self.targets = spark.createDataFrame(targets, "part int, key int, goes_to int, own boolean")
        # Blocks are few and much work each: they should not meet in a task.
        spark.conf.set(SHUFFLE_PARTS, str(2 * len(targets)))
        keys = spark.createDataFrame([(b, first[b], pieces[b]) for b in sorted(sizes)], "block int, first int, pieces int")
        piece = F.pmod(F.xxhash64("links"), F.col("pieces").cast("bigint")).cast("int")
        keyed = chunks.join(F.broadcast(keys), "block").select((F.col("first") + piece).alias("key"), "n", "srcs", "dsts", "links", "copies")
        to = self.targets.filter("NOT own")
        ends = self.ids.join(F.broadcast(to), "part").select("key", F.lit("src").alias("side"), "ids", "outs").unionAll(
            self.ids.join(F.broadcast(to.drop("part").withColumnRenamed("goes_to", "part")), "part").select(
                "key", F.lit("dst").alias("side"), "ids", F.lit(None).cast("binary").alias("outs")))
        placed = keyed.groupBy("key").cogroup(ends.groupBy("key")).applyInArrow(_placer(CHUNK), PLACED)
        self.blocks = placed.repartition(int(spark.conf.get(SHUFFLE_PARTS)), "key").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with freed_shuffles(spark):
                self.blocks.count()
        except Exception:
            self.__exit__()
            raise
        finally:
            chunks.unpersist()

    def __enter__(self) -> Grid:
        return self

    def __exit__(self, *_) -> None:
        self.spark.conf.set(SHUFFLE_PARTS, self.usual)
        self.blocks.unpersist()
        self.ids.unpersist()

    def start(self, value: float, held: float | None = None) -> DataFrame:
        """The state of a loop: a part's numbers, ``value`` those that are sent, ``held`` those that wait."""

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, n in zip(batch["part"].to_pylist(), batch["n"].to_pylist()):
                    row = (part, n, *(None if x is None else np.full(n, x).tobytes() for x in (value, held)), value * n, n)
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], ["part", "n", "value", "held", "total", "sending"])

        return self.ids.select("part", "n").mapInArrow(fill, STATE)

    def round(self, state: DataFrame, reset: float, least: float | None = None) -> DataFrame:
        """The next state; numbers of at most ``least`` are not sent. Uses ``state`` once."""
        numbers = F.when(F.col("own"), F.col("held")).otherwise(F.col("value")).alias("numbers")
        sent = state.join(F.broadcast(self.targets), "part").select("key", "goes_to", "own", "n", numbers)
        sums = sent.groupBy("key").cogroup(self.blocks.groupBy("key")).applyInArrow(
            _summer(least), "part int, own boolean, n bigint, numbers binary")
        return sums.groupBy("part").applyInArrow(_merger(reset, least), STATE)

    def rows(self, state: DataFrame, column: str, name: str) -> DataFrame:
        """``id`` and the numbers in ``column``."""
        listed = _codec()[3]

        def unfold(ids: pa.Table, numbers: pa.Table) -> pa.Table:
            return pa.table([listed(ids["ids"][0].as_py()), pa.array(np.frombuffer(numbers["numbers"][0].as_py(), np.float64))], ["id", name])

        numbers = state.select("part", F.col(column).alias("numbers"))
        return self.ids.groupBy("part").cogroup(numbers.groupBy("part")).applyInArrow(unfold, f"id {self.kind}, {name} double")
