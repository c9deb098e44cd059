"""A stored graph that finds the edges of a vertex without scanning the others.

Edges are written twice, sorted by source and sorted by destination, in files
that each hold a range of their ids. A small table, the index, names the least
and the largest id of every file, so a lookup opens only the files whose range
covers the vertex; inside these the statistics and the Bloom filter of each row
group tell which groups are read. Copies of an edge are one row with a count,
and the edges of a hub are divided by their other end, so no file depends on
one vertex.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions import found_message, other_end

COPIES = "edge_copies"
GROUP_BYTES = 8 << 20
BLOCK = 10_000
ENDS = ("src", "dst")


@dataclass(frozen=True)
class EdgeStore:
    """The edges stored below ``path``; ``src, dst`` and any other columns but ``edge_copies`` and ``edge_block``."""

    spark: SparkSession
    path: str

    @classmethod
    def write(
        cls, edges: DataFrame, path: str, files: int | None = None, group_bytes: int = GROUP_BYTES, mode: str = "error"
    ) -> EdgeStore:
        """Store ``edges`` below ``path``, each side in about ``files`` files (default: as the session shuffles)."""
        taken = {COPIES, "edge_block"} & set(edges.columns)
        if taken:
            raise ValueError(f"the store keeps these columns for itself: {sorted(taken)}")
        read = edges.sparkSession.read
        single = edges.groupBy(*[F.col(f"`{c}`") for c in edges.columns]).agg(F.count(F.lit(1)).alias(COPIES))
        rest = [F.col(f"`{c}`") for c in edges.columns if c not in ENDS]
        for end, far in (ENDS, ENDS[::-1]):
            keys = [F.col(end), F.col(far), F.xxhash64(*(rest or [F.lit(0)]))]
            dealt = single.repartitionByRange(*keys) if files is None else single.repartitionByRange(files, *keys)
            writer = dealt.sortWithinPartitions(end, far).write.mode(mode)
            writer = writer.option("parquet.block.size", group_bytes).option(f"parquet.bloom.filter.enabled#{end}", True)
            writer.parquet(f"{path}/by_{end}")
            # The other side is made of this one, so the edges are computed for one of them only.
            single = stored = read.parquet(f"{path}/by_{end}")
            name = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
            ranges = stored.select(name, end).groupBy("file").agg(F.min(end).alias("low"), F.max(end).alias("high"))
            ranges.coalesce(1).write.mode(mode).parquet(f"{path}/index_{end}")
        return cls(edges.sparkSession, path)

    def side(self, end: str, vertex) -> DataFrame:
        """Stored rows whose ``end`` is the vertex, read from the files that may hold them."""
        folder = f"{self.path}/by_{end}"
        wanted = F.lit(vertex)
        index = self.spark.read.parquet(f"{self.path}/index_{end}")
        names = [r.file for r in index.filter((F.col("low") <= wanted) & (F.col("high") >= wanted)).select("file").collect()]
        schema = self.spark.read.parquet(folder).schema
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{folder}/{x}" for x in names]).filter(F.col(end) == wanted)

    def _incident(self, vertex) -> DataFrame:
        # A self-loop is on both sides and is taken from the first.
        other = self.side("dst", vertex).filter(~F.col("src").eqNullSafe(F.lit(vertex)))
        return self.side("src", vertex).unionByName(other)

    def incident_edges(self, vertex) -> DataFrame:
        """Edges with the vertex at either end, as often as they were stored."""
        return _repeated(self._incident(vertex))

    def neighbor_ids(self, vertex) -> DataFrame:
        """The other end ``id`` of every incident edge; parallel edges repeat it."""
        return _repeated(self._incident(vertex)).select(other_end(F.lit(vertex)).alias("id"))

    def incident_count(self, vertex) -> DataFrame:
        """Number of incident edges as ``edges``."""
        return self._incident(vertex).agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("edges"))

    def find_vertex_report(self, vertex) -> DataFrame:
        """One line ``message``: the vertex is, or is not, in the graph."""
        found = self._incident(vertex).agg((F.count(F.lit(1)) > 0).alias("found"))
        return found.select(found_message(F.lit(vertex), F.col("found")).alias("message"))

    def edges(self) -> DataFrame:
        """All stored edges, as often as they were stored."""
        return _repeated(self.spark.read.parquet(f"{self.path}/by_src"))


def _repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as it was stored; in blocks, so that no array grows with the copies."""
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({COPIES} - 1) div {BLOCK}")))
    blocks = rows.withColumn("edge_block", block)
    each = F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(BLOCK), F.col(COPIES) - F.col("edge_block") * BLOCK))
    return blocks.withColumn(COPIES, F.explode(each)).drop(COPIES, "edge_block")
