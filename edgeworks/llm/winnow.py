"""Operator 3: document fingerprints by winnowing.

Every ``K`` code points in a row are hashed. Of each ``WINDOW`` hashes in a row
the least is chosen, the rightmost one of equals, and every chosen hash is kept
once with its position. Two texts that share ``K + WINDOW - 1`` code points in a
row are sure to share a fingerprint, and its positions tell where.

DataFrame functions only. A text is worked on in chunks that overlap by what a
window needs, so that arrays of hashes stay short whatever the text's length;
the chunks' windows together are exactly the text's.

A text shorter than ``K`` is hashed whole; one with fewer hashes than a window
is one window. Null or empty text: an empty fingerprint. Equal texts have equal
fingerprints. Likeness is the share of common hashes among all of two
fingerprints (positions may shift); two empty ones are alike, one is like none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edgeworks.loop import Workspace

K = 8
WINDOW = 16
CHUNK = 1 << 14
_LOW = (1 << 16) - 1
#: Bits of an id that tell neighbours in one group apart.
NEAR = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _widened(h: Column, step: int, times: int) -> Column:
    """The least of each number and ``times`` others, ``step`` places apart; none beyond the end."""
    return _let(h, lambda all_: F.transform(all_, lambda x, i: F.least(x, *(F.get(all_, i + step * t) for t in range(1, times + 1)))))


def _sliding_least(h: Column, window: int) -> Column:
    """The least of each ``window`` numbers in a row; of all, where there are fewer."""
    span, out = 1, h
    while span < window:
        times = 3 if 4 * span <= window else 1
        step = span if 2 * span <= window else window - span
        out, span = _widened(out, step, times), step * times + span
    return _let(out, lambda m: F.slice(m, F.lit(1), F.greatest(F.size(m) - (window - 1), F.lit(1))))


def _chosen(chunk: Column, k: int, window: int) -> Column:
    """Chosen hashes of a chunk: 48 bits of hash above 16 of the position, counted down."""
    grams = F.when(F.char_length(chunk) >= k, F.regexp_extract_all(chunk, F.lit(f"(?s)(?=(.{{{k}}})).")))
    grams = F.coalesce(grams, F.array(chunk))

    def packed(gram: Column, i: Column) -> Column:
        # Equal hashes: the later position has the smaller rest, so the rightmost is the least.
        return F.xxhash64(gram).bitwiseAND(F.lit(~_LOW)) + (F.lit(_LOW) - i)

    return F.array_distinct(_sliding_least(F.transform(grams, packed), window))


def fingerprint(text: Column, k: int = K, window: int = WINDOW, chunk: int = CHUNK) -> Column:
    """``array<struct<hash bigint, position int>>`` in order of position."""
    span, empty = chunk + k + window - 2, F.array().cast("array<struct<hash:bigint,position:int>>")
    last = F.greatest(F.char_length(text) - (k + window - 1), F.lit(0))
    unpack = lambda at: lambda v: F.struct(
        F.shiftright(v, 16).alias("hash"), (at + F.lit(_LOW) - v.bitwiseAND(F.lit(_LOW))).cast("int").alias("position"))
    parts = F.transform(F.sequence(F.lit(0), last, F.lit(chunk)), lambda at: F.transform(_chosen(F.substring(text, at + 1, F.lit(span)), k, window), unpack(at)))
    # Positions ascend; the first of a chunk may be the last of the one before.
    once = _let(F.flatten(parts), lambda all_: F.filter(all_, lambda v, i: (i == 0) | (v["position"] != F.get(all_, i - 1)["position"])))
    return F.when(F.char_length(text) > 0, once).otherwise(empty)


def likeness(a: Column, b: Column) -> Column:
    """Common hashes by all hashes of two fingerprints."""
    x, y = F.array_distinct(F.transform(a, lambda v: v["hash"])), F.array_distinct(F.transform(b, lambda v: v["hash"]))
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.greatest(F.size(F.array_union(x, y)), F.lit(1)))


def written(found: Column) -> Column:
    """A fingerprint as text: ``hash@position`` in hexadecimal and decimal."""
    return F.array_join(F.transform(found, lambda v: F.concat(F.hex(v["hash"].bitwiseAND(F.lit((1 << 48) - 1))), F.lit("@"), v["position"].cast("string"))), " ")


def _successors(groups: DataFrame) -> DataFrame:
    """``(near, next)``: each group of ids with the next that exists; the last with the first.

    The groups are cut into ranges of about equal size, whatever the gaps
    between ids, and written with their range, so that one row for each range
    meets in one task.
    """
    parts = groups.repartitionByRange("near").select("near", F.spark_partition_id().alias("part"))
    rows, _ = Workspace(groups.sparkSession).keep(parts, "ranges")
    inside = rows.withColumn("next", F.lead("near").over(W.partitionBy("part").orderBy("near")))
    firsts = rows.groupBy("part").agg(F.min("near").alias("first"))
    every = W.partitionBy(F.lit(0)).orderBy("first")
    after = firsts.select("part", F.coalesce(F.lead("first").over(every), F.first("first").over(every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("after"))
    return inside.join(after, "part").select("near", F.coalesce("next", "after").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, own, next_text, next_own)`` of ``(doc_id, text)``.

    ``own`` is the text's fingerprint. Next is by ascending id, the first after
    the last. Ids are dealt out in groups of neighbours, so that texts are
    shuffled once; only the last of a group looks for its next in another.
    Rows of one id follow each other by text; a null id comes first.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", "text", key.alias("key"), F.shiftright(key, NEAR).alias("near")).repartition("near")
    order = W.partitionBy("near").orderBy("key", "text")
    inside = rows.withColumn("own", fingerprint(F.col("text"))).select(
        "doc_id", "text", "own", F.lead("text").over(order).alias("next_text"), F.lead("own").over(order).alias("next_own"))
    edge = F.struct("key", "text", "doc_id")
    edges = rows.groupBy("near").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    after = _successors(docs.select(F.shiftright(key, NEAR).alias("near")).distinct())
    last = edges.select("near", F.col("last.doc_id").alias("doc_id"), F.col("last.text").alias("text")).join(after, "near")
    first = edges.select(F.col("near").alias("next"), F.col("first.text").alias("next_text"))
    tail = last.join(first, "next").select("doc_id", "text", fingerprint(F.col("text")).alias("own"), "next_text", fingerprint(F.col("next_text")).alias("next_own"))
    return inside.filter(F.col("next_text").isNotNull()).unionByName(tail)


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by as much of the next text's beginning."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def edited_fingerprint(text: Column, own: Column, next_own: Column, whole: Column, k: int = K, window: int = WINDOW) -> Column:
    """The fingerprint of the edited text ``whole``, from those of the two texts it is made of.

    Whether a position is chosen depends on the windows that hold it alone.
    Where these lie inside the kept half, or inside the next text's beginning,
    the choice is known; only the places around the seam and before the end
    are hashed again. A short text is hashed whole.
    """
    reach = k + window - 1
    n, m = F.char_length(text), F.char_length(whole)
    kept_chars = n - F.floor(n / 2).cast("int")

    def joined(cut: Column) -> Column:
        """``cut`` has the lengths of the kept half (a) and of what follows (b), counted once."""
        a, b = cut["a"], cut["b"]

        def zone(begin: Column, end: Column) -> Column:
            """Chosen positions from ``begin`` to before ``end``, hashed anew."""
            start = F.greatest(begin - (window - 1), F.lit(0))
            part = F.substring(whole, start + 1, end + reach - start)
            moved = F.transform(_let(part, lambda x: fingerprint(x, k, window)), lambda v: F.struct(v["hash"].alias("hash"), (v["position"] + start).alias("position")))
            return F.filter(moved, lambda v: (v["position"] >= begin) & (v["position"] < end))

        kept = F.filter(own, lambda v: v["position"] <= a - reach)
        taken = F.transform(
            F.filter(next_own, lambda v: (v["position"] >= window - 1) & (v["position"] <= b - reach)),
            lambda v: F.struct(v["hash"].alias("hash"), (v["position"] + a).alias("position")))
        seam, last = a - reach + 1, a + b - reach + 1
        apart = b >= reach + window - 1
        return F.when(apart, F.concat(kept, zone(seam, a + window - 1), taken, zone(last, a + b))).otherwise(F.concat(kept, zone(seam, a + b)))

    lengths = F.struct(kept_chars.alias("a"), (m - kept_chars).alias("b"))
    return F.when(m < 8 * reach, fingerprint(whole, k, window)).otherwise(_let(lengths, joined))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every ``(doc_id, text)`` and its edited text, and their likeness."""
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    other = edited_fingerprint(F.col("text"), F.col("own"), F.col("next_own"), F.col("edited"))
    rows = rows.withColumn("other", other)
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"), written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"))
