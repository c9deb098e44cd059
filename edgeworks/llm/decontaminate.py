"""Operator 9: benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``WINDOW`` words (an item of fewer is
one window). A document is contaminated by a window when it holds exactly its
words in a row. As sets of shingles (``SHINGLE`` words, or the whole window if
that is shorter) the window must be contained whole, so with its shingles in
order of rarity the first alone is a necessary prefix:

1. count the benchmark's shingles in all documents;
2. of each window keep the rarest shingle and its offset;
3. join the shingles of the documents to these. A match at a position tells
   where the window would start: before the text or beyond its end it is out;
4. verify what is left word by word on the document's own words.

DataFrame functions only. The benchmark side is broadcast while it has at most
``BROADCAST_ROWS`` rows, which is counted, and joined by shuffle beyond that.
Documents are shuffled once, with their candidates; no pairs of documents are
ever formed.

Null or empty text, or one without word characters: no words, no hits. An item
without words has no window. Repeated items count once each by their id;
repeated documents are judged each on its own words. Candidates are gathered by
doc_id and a hash of the text, so rows without an id meet only their copies, and
are verified on each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 200_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z alone in lower case; the quick function will do where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Each different window once: ``(window, size, items)``, items as strings."""
    said = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - (width - 1), F.lit(1)))
    each = said.filter(n > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, F.lit(width)))).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("size", F.size("window"))


def shingle_hashes(tokens: Column, q: int) -> Column:
    """Hash of the ``q`` tokens from each position on; none where fewer are left."""
    one = F.transform(tokens, lambda w: F.xxhash64(w))
    if q == 1:
        return one
    # Nested so that the hashes of single words are computed once.
    rows = F.transform(F.array(one), lambda h: F.when(F.size(h) >= q, F.transform(
        F.sequence(F.lit(0), F.size(h) - q), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(q))))))
    return F.coalesce(rows[0], F.array().cast("array<bigint>"))


def _small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= most else rows


def rarest_shingles(docs: DataFrame, found: DataFrame, sizes: list[int], shingle: int = SHINGLE) -> DataFrame:
    """Windows with the offset and hash of the shingle that the documents hold least."""
    every = None
    for q in sizes:
        of_q = found.filter(F.least("size", F.lit(shingle)) == q).select("*", F.lit(q).alias("q"), F.posexplode(shingle_hashes(F.col("window"), q)).alias("offset", "hash"))
        every = of_q if every is None else every.unionByName(of_q)
    keys = _small(every.select("q", "hash").distinct())
    counts = _doc_shingles(docs, sizes).join(keys, ["q", "hash"]).groupBy("q", "hash").agg(F.count(F.lit(1)).alias("n"))
    ranked = every.join(counts, ["q", "hash"], "left").select(
        "window", "items", "size", "q", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset").alias("rare"))
    best = ranked.groupBy("window").agg(F.min("rare").alias("rare"), F.first("items").alias("items"), F.first("size").alias("size"), F.first("q").alias("q"))
    return best.select("q", F.col("rare.hash").alias("hash"), F.col("rare.offset").alias("offset"), "size", "window", "items")


def _doc_shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``(doc_id, of_text, n_words, q, position, hash)`` of every shingle of every document."""
    said = docs.select("doc_id", F.xxhash64("text").alias("of_text"), words(F.col("text")).alias("words"))
    every = None
    for q in sizes:
        of_q = said.select("doc_id", "of_text", F.size("words").alias("n_words"), F.lit(q).alias("q"), F.posexplode(shingle_hashes(F.col("words"), q)).alias("position", "hash"))
        every = of_q if every is None else every.unionByName(of_q)
    return every


def candidates(docs: DataFrame, prefix: DataFrame, sizes: list[int]) -> DataFrame:
    """``(doc_id, of_text, candidates)``: where windows may start, by their rarest shingle."""
    start = F.col("position") - F.col("offset")
    met = _doc_shingles(docs, sizes).join(_small(prefix), ["q", "hash"]).filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
    return met.groupBy("doc_id", "of_text").agg(F.collect_set(F.struct(start.alias("start"), "size", "window", "items")).alias("candidates"))


def find_leaks(docs: DataFrame, items: DataFrame, width: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` rows with ``words`` and the verified ``leaks``.

    Needs ``doc_id`` and ``text``; a column ``row`` is kept. ``leaks`` is an
    array of ``(start, size, window, items)``.
    """
    carried = [c for c in docs.columns if c == "row"]
    docs = docs.select("doc_id", "text", *carried)
    found = windows(items.select("item_id", "text"), width)
    sizes = sorted(x.q for x in found.select(F.least("size", F.lit(shingle)).alias("q")).distinct().collect())
    said = docs.withColumn("words", words(F.col("text")))
    if not sizes:
        kind = "array<struct<start:int,size:int,window:array<string>,items:array<string>>>"
        return said.withColumn("leaks", F.array().cast(kind))
    maybe = candidates(docs, rarest_shingles(docs, found, sizes, shingle), sizes)
    key = maybe.withColumnRenamed("doc_id", "of")
    same_row = docs["doc_id"].eqNullSafe(key["of"]) & (F.xxhash64(docs["text"]) == key["of_text"])
    joined = docs.join(key, same_row, "left").drop("of", "of_text").withColumn("words", words(F.col("text")))
    same = F.filter(F.coalesce("candidates", F.array()), lambda c: F.slice("words", c["start"] + 1, c["size"]) == c["window"])
    return joined.select("doc_id", "text", *carried, "words", same.alias("leaks"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.array_distinct(F.flatten(F.transform("leaks", lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1))))
    of = F.array_sort(F.array_distinct(F.flatten(F.transform("leaks", lambda x: x["items"]))))
    found = find_leaks(docs, items, width, shingle).select("doc_id", F.size("words").cast("long").alias("n_words"), F.size(hit).cast("long").alias("n_hit"), of.alias("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
items AS (
  SELECT item_id, least(len(w), 10) AS size,
    unnest(list_transform(generate_series(1, greatest(len(w) - 9, 1)), lambda i: array_to_string(w[i:i + 9], ' '))) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
pieces AS (
  SELECT r, size, unnest(generate_series(1, len(w) - size + 1)) AS i, w FROM d, sizes WHERE len(w) >= size),
met AS (
  SELECT r, i, p.size, item_id FROM (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS win FROM pieces) p
  JOIN items USING (win, size)),
hit AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS k FROM met) GROUP BY r),
ofs AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS said
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(ofs.n, 0)::BIGINT AS n_items,
  sha256(coalesce(said, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ofs USING (r)
"""
