"""Operator 5: near duplicates by one-permutation MinHash.

1. Each text becomes the set of its word shingles. Texts of equal sets are one
   node from here on, so copies are never paired.
2. One hash function deals a set's shingles into bins, and each bin keeps its
   least. An empty bin borrows from another that a fixed random order of its
   own names first (optimal densification), so bins agree with the probability
   that is the sets' likeness even for sets smaller than the number of bins.
3. ``BANDS`` bands of ``ROWS`` bins are buckets. At a likeness of 0.8 a pair
   misses all of them with a probability below 1e-8.
4. Inside a bucket candidates are a star: one centre against the others, never
   all pairs. Candidates are confirmed on the full sets, and links make
   components, so a group of real copies costs one star.
5. What a bucket still holds of different components falls into smaller ones by
   the rarest of the shingles in which its texts differ from the centre, as many
   as an exact bound requires. Stars go on there, with eight times as many
   centres each round, until every pair of different components was compared
   that the bound on shared differences does not rule out. So no link between
   components is lost, and texts that differ from a common one each in its own
   way, as edits of it do, are not paired.

Each round's tables are written to the shared folder. Nothing is collected but
row counts.

Null or empty text, or one without words: an empty set, linked with nothing.
Fewer words than a shingle has: one shingle. Repeated rows are copies of each
other. A null doc_id never is a component's id unless it has no other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.llm.common import per_batch, small_batches, texts
from edgeworks.llm.components import components
from edgeworks.llm.shingles import folded, shingle_set
from edgeworks.loop import Workspace

BANDS, ROWS = 48, 5
SEED = 20_11


def orders(bins: int) -> np.ndarray:
    """For each bin, the order in which it looks for a full one; itself first."""
    draw = np.random.default_rng(SEED).random((bins, bins))
    draw[np.arange(bins), np.arange(bins)] = -1
    return np.argsort(draw, axis=1)


def signature(found: np.ndarray, look: np.ndarray) -> np.ndarray:
    """Least hash of each bin of a sorted set, empty bins filled from others."""
    bins = len(look)
    at = ((found >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(at, prepend=np.uint64(bins)))
    out, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    out[at[first]], full[at[first]] = found[first], True
    empty = np.flatnonzero(~full)
    if len(empty):
        out[empty] = out[look[empty, np.argmax(full[look[empty]], axis=1)]]
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    table = sig[:bands * rows].reshape(bands, rows)
    return folded([np.arange(bands, dtype=np.uint64), *table.T])


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n, node, keys)`` of ``(doc_id, text)``; node and keys are null for empty sets."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        look = orders(bands * rows)
        n, nodes, keys = [], [], []
        for text in batch["text"].to_pylist():
            found = shingle_set(text, words)
            n.append(len(found))
            nodes.append(_digest(found) if len(found) else None)
            keys.append(band_keys(signature(found, look), bands, rows).view(np.int64) if len(found) else None)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "node", "keys"])

    return per_batch(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, node binary, keys array<long>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(node, shingles)`` of ``(doc_id, text)``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(x, words) for x in batch["text"].to_pylist()]
        sets = pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([_digest(x) for x in found], pa.binary()), sets], ["node", "shingles"])

    return per_batch(docs, run, "node binary, shingles array<long>")


def _stars(members: DataFrame, centres: int, can: Callable[[Callable], Column]) -> tuple[DataFrame, DataFrame]:
    """Candidate edges ``(low, high, a, b)``, a being a centre, and the centres ``(bucket, node)``.

    The centre of a part of a bucket is, of those that may lead, the member that
    meets most others in its own buckets, as the text does that others are
    edited from. ``can`` says by both members' columns whether they may be alike.
    """
    facts = F.struct("weight", "node", *[x for x in members.columns if x not in ("bucket", "weight", "node", "lead")])
    part = F.pmod(F.xxhash64("node"), F.lit(centres)).alias("part")
    picked = members.filter("lead").groupBy("bucket", part).agg(F.max(facts).alias("c")).select("bucket", "c")
    c = lambda name: F.col(f"c.{name}")
    pairs = members.join(picked, "bucket").filter((F.col("root") != c("root")) & can(c))
    one = F.max(F.struct(c("weight").alias("weight"), c("node").alias("a"), F.col("node").alias("b"))).alias("e")
    edges = pairs.groupBy(F.least("node", c("node")).alias("low"), F.greatest("node", c("node")).alias("high")).agg(one)
    return edges.select("low", "high", "e.a", "e.b"), picked.select("bucket", c("node").alias("node"))


def _compared(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges with whether their full sets make them links.

    The centre's set joins first, while rows are light: a centre of a large
    group is a hot key there, which adaptive execution splits.
    """
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    found = edges.join(left, "a").join(right, "b").withColumn("inside", F.size(F.array_intersect("sa", "sb")))
    link = F.col("inside") * 100 >= (F.size("sa") + F.size("sb") - F.col("inside")) * percent
    return found.select("low", "high", "a", "b", link.alias("link"))


def _apart(work: Workspace, members: DataFrame, picked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members of what open buckets fall into, by how each text differs from the bucket's centre.

    With ``d`` the number of shingles that only one of a text and the centre
    has, two texts of ``n`` and ``m`` shingles are alike only if they share
    ``(d + e - (n + m) * q) / 2`` of these differences, ``q`` being
    ``(100 - percent) / (100 + percent)``, and one at least unless both are
    linked to the centre. So, rarest first, the first difference they share
    stands at most ``n * (100 - percent) / percent`` places behind each
    one's first (here it becomes their bucket), and at most half of that behind
    in the one with fewer (which may lead there). Differences of a single text
    take places, but make no bucket.
    """
    centre = F.col("centre")
    met = members.select("bucket", "node").join(picked.withColumnRenamed("node", "centre"), "bucket").filter(F.col("node") != centre).select("centre", "node").distinct()
    one = sets.select("node", F.col("shingles").alias("s"))
    other = sets.select(F.col("node").alias("centre"), F.col("shingles").alias("t"))
    items = F.concat(F.array_except("s", "t"), F.array_except("t", "s")).alias("items")
    diffs, _ = work.keep(met.join(other, "centre").join(one, "node").select("centre", "node", items), "differences")
    each = diffs.select("centre", "node", F.explode("items").alias("item"))
    common = each.groupBy("centre", "item").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    found = each.join(common, ["centre", "item"]).groupBy("centre", "node").agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("found"))
    rows = found.join(diffs.select("centre", "node", F.size("items").alias("size")), ["centre", "node"])
    rows = rows.select("centre", "node", "size", (F.col("size") - F.size("found")).alias("alone"), F.posexplode("found").alias("at", "x"))
    known = members.select("node", "n", "root", "weight").distinct()
    behind = F.col("alone") + F.col("at")
    rows = rows.join(known, "node").filter(behind * percent <= F.col("n") * (100 - percent))
    lead = behind * 2 * percent <= F.col("n") * (100 - percent)
    out, _ = work.keep(rows.select(F.struct("centre", "x.item").alias("bucket"), "weight", "node", "n", "root", "size", (F.col("size") - behind).alias("ahead"), lead.alias("lead")), "apart")
    work.drop(diffs)
    return out


def _open(work: Workspace, members: DataFrame) -> tuple[DataFrame, int]:
    """Members of buckets that hold different components and one that may lead, and their number."""
    mixed = members.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.max("lead").alias("any")).filter("x <> y AND any").select("bucket")
    mixed, some = work.keep(mixed, "mixed")
    if not some["rows"]:
        return members, 0
    found, seen = work.keep(members.join(mixed, "bucket"), "open")
    work.drop(mixed)
    work.drop(members)
    return found, seen["rows"]


def links(work: Workspace, docs: DataFrame, signs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(node, root)`` of nodes that have links, other than roots."""
    nodes, _ = work.keep(signs.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys")), "nodes")
    rows = nodes.select("node", "n", "doc_id", F.explode("keys").alias("bucket"))
    shared, _ = work.keep(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "shared")
    met, seen = work.keep(rows.join(shared, "bucket").select("bucket", "node", "n", "doc_id", "k"), "members")
    work.drop(nodes)
    work.drop(shared)
    roots = work.spark.createDataFrame([], "node binary, root binary")
    if not seen["rows"]:
        return roots
    wanted, _ = work.keep(met.groupBy("node").agg(F.first("doc_id").alias("of"), F.sum("k").alias("weight")), "wanted")
    with small_batches(work.spark):
        sets, _ = work.keep(full_sets(docs.join(wanted.select("of"), docs["doc_id"].eqNullSafe(F.col("of")), "left_semi"), words), "sets")
    members, _ = work.keep(met.join(wanted.select("node", "weight"), "node").select("bucket", "weight", "node", "n", F.col("node").alias("root"), F.lit(True).alias("lead")), "open")
    work.drop(met)
    work.drop(wanted)

    def sizes(c):
        return F.least("n", c("n")) * 100 >= F.greatest("n", c("n")) * percent

    def enough(c):
        shared = 2 * F.least("ahead", c("ahead"))
        return sizes(c) & (shared * (100 + percent) >= (F.col("size") + c("size")) * (100 + percent) - (F.col("n") + c("n")) * (100 - percent))

    tested, centres, can = None, 1, sizes
    while True:
        edges, picked = _stars(members, centres, can)
        picked, _ = work.keep(picked, "picked")
        if tested is not None:
            edges = edges.join(tested, ["low", "high"], "left_anti")
        edges, some = work.keep(edges, "edges")
        if some["rows"]:
            compared, found = work.keep(_compared(edges, sets, percent), "compared", links=F.count_if("link"))
            seen_now = compared.select("low", "high")
            tested = seen_now if tested is None else tested.union(seen_now)
            if found["links"]:
                label, named = roots.withColumnRenamed("node", "of"), compared.filter("link").select("a", "b")
                for c in ("a", "b"):
                    named = named.join(label.select(F.col("of").alias(f"of_{c}"), F.col("root").alias(f"root_{c}")), F.col(c) == F.col(f"of_{c}"), "left").withColumn(c, F.coalesce(f"root_{c}", c)).select("a", "b")
                new = components(work, named)
                moved = new.select(F.col("node").alias("of"), F.col("root").alias("to"))
                later = roots.join(moved, F.col("root") == F.col("of"), "left").select("node", F.coalesce("to", "root").alias("root"))
                roots, _ = work.keep(later.union(new.join(roots.select("node"), "node", "left_anti").select("node", "root")), "roots")
                columns = members.columns
                members = members.join(moved, F.col("root") == F.col("of"), "left").withColumn("root", F.coalesce("to", "root")).select(*columns)
        work.drop(edges)
        # Centres have met every other member of their bucket; a bucket of one component is done.
        left, _ = work.keep(members.join(picked, ["bucket", "node"], "left_anti"), "left")
        members, some = _open(work, left)
        if some and can is sizes:
            members, some = _open(work, _apart(work, members, picked, sets, percent))
            can, centres = enough, 2
        work.drop(picked)
        if not some:
            return roots
        centres *= 8


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    work = Workspace(docs.sparkSession)
    said = texts(docs, id_col, text_col)
    with small_batches(work.spark):
        signs, _ = work.keep(signatures(said, words, bands, rows), "signatures")
    roots = links(work, said, signs, words, percent)
    light = signs.select("doc_id", "n", "node")
    first = light.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    named = first.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named, _ = work.keep(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    groups, _ = work.keep(named.join(least, "root").select("node", "component_id"), "groups")
    work.clear(signs, groups)
    done = light.join(groups, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return done.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
each AS (SELECT DISTINCT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k
  FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * k >= 80 * (na + nb - k)),
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT a, a FROM sym UNION SELECT reach.doc_id, sym.b FROM reach JOIN sym ON reach.r = sym.a),
least_of AS (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM sets LEFT JOIN least_of USING (doc_id)
"""
