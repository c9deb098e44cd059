"""Operator 13: how far the sources of each language differ in their use of words.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case.
A language keeps the terms in at least ``MIN_DOCS`` of its documents. A group is
a language and a source. In it, a kept term of ``count`` occurrences weighs
``p = 1 + floor(1000000000 * (count + 2) / (N + 2 * V))``, V being the number of
the language's kept terms and N the group's occurrences of them; so it is for a
whole language. Two weights are ``floor((p - q)^2 / (p + q))`` apart. All
numbers are whole.

*Pairs* of groups are compared on bitmaps of count levels: kept terms stand in
words of 64, and for each group, count and word a bitset tells which terms have
that count there. AND and popcount of two bitsets give the number of terms in a
joint cell of two counts, which is multiplied by the distance of the two
weights; terms that a group does not have are the complement of its bitsets.
Words hold terms of like frequency, so that they have few levels, and never
more than 64: a pair costs at most 64 operations a term. Words lie in buckets
of bounded size, and groups in tiles of ``TILE`` sources, so no task sees more
than a bucket of a tile however many terms or sources there are; each bucket
brings a row for every group, also for those that have none of its terms.

*Terms* of a group are compared with the language's, and the ``TOP`` that are
over-represented by most are kept.

Null text, language or source: as ''. A group without terms is compared all the
same; in a language without kept terms all distances are 0. Repeated rows are
documents of their own. Ties: smaller item in UTF-8 first. Texts of any length
are read whole. Extra columns do not matter. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edgeworks.llm.common import sliced
from edgeworks.loop import Workspace

MIN_DOCS, TOP = 10, 10
#: Rows (a term in a group) of a bucket, and sources of a tile, about.
BUCKET, TILE = 1 << 16, 128
#: Groups that may be broadcast; beyond it they are joined by shuffle.
FEW_GROUPS = 1 << 16
#: Bytes of text whose terms are counted together.
BATCH = 10 << 20
#: Cells of two groups' bitsets that are met at a time.
CELLS = 1 << 21

_LETTERS = np.array([32 if not (chr(b).isalpha() if b < 128 else True) else b | 32 if b < 128 else b for b in range(256)], np.uint8)


def _terms(text: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Row number of each term, and the terms."""
    text = pa.concat_arrays([text.cast(pa.large_string())])
    _, ends, raw = text.buffers()
    data = _LETTERS[np.frombuffer(raw, np.uint8)] if raw is not None else np.empty(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(text), ends, pa.py_buffer(data), offset=text.offset)
    words = pc.ascii_split_whitespace(plain)
    rows = np.repeat(np.arange(len(text), dtype=np.int32), np.diff(words.offsets.to_numpy()))
    return rows, words.flatten().dictionary_encode()


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows, coded = _terms(batch["text"])
    terms, at = coded.dictionary, coded.indices.to_numpy()
    numbers: dict[tuple, int] = {}
    group = np.fromiter((numbers.setdefault(x, len(numbers)) for x in zip(batch["lang"].to_pylist(), batch["source"].to_pylist())), np.int64, batch.num_rows)
    size = max(1, len(terms))
    key, n = np.unique(group[rows] * size + at, return_counts=True)
    held = np.unique(rows * np.int64(size) + at)
    again, docs = np.unique(group[held // size] * size + held % size, return_counts=True)
    assert np.array_equal(key, again)
    names = list(numbers)
    whose = pa.array(key // size)
    out = pa.RecordBatch.from_arrays([
        pa.array([x[0] for x in names], pa.string()).take(whose), pa.array([x[1] for x in names], pa.string()).take(whose),
        terms.take(pa.array(key % size)).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64()),
    ], ["lang", "source", "term", "n", "docs"])
    return out.filter(pc.not_equal(out["term"], ""))


def _grouped(docs: DataFrame, lang_col: str, source_col: str, text_col: str | None) -> DataFrame:
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in named.items() if c])


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents that hold the term.

    A task sums up what it reads, in pieces of bounded size, before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH):
            yield _counted(batch)

    found = _grouped(docs, lang_col, source_col, text_col).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, source, term, n, total, first)`` of terms in enough documents of their language; ``first`` marks one row a term."""
    all_ = W.partitionBy("lang", "term")
    seen = counts.select(
        "*", F.sum("docs").over(all_).alias("in_docs"), F.sum("n").over(all_).alias("total"),
        (F.row_number().over(all_.orderBy("source")) == 1).alias("first"))
    return seen.filter(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "total", "first")


def _weight(count: str, n: str, v: str) -> Column:
    return F.expr(f"1 + ((cast({count} AS decimal(20,0)) + 2) * 1000000000) div cast({n} + 2 * {v} AS decimal(20,0))")


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def group_totals(docs: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, group_n, lang_n, v, lang_rows, sources)`` of every group, also of those without terms."""
    groups = _grouped(docs, lang_col, source_col, None).distinct()
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count_if("first").alias("firsts"), F.count(F.lit(1)).alias("held"))
    rows = groups.join(of_group, ["lang", "source"], "left").na.fill(0, ["group_n", "firsts", "held"])
    of_lang = rows.groupBy("lang").agg(
        F.sum("group_n").alias("lang_n"), F.sum("firsts").alias("v"), F.sum("held").alias("lang_rows"), F.count(F.lit(1)).alias("sources"))
    return rows.drop("firsts", "held").join(of_lang, "lang")


def level_bitmaps(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, band, bucket, word, source, p, mask, last)``: which of a word's terms have weight ``p`` in a group."""
    sized = kept.join(totals.select("lang", "source", "group_n", "v", "lang_rows"), ["lang", "source"])
    band = F.floor(F.log2("total")).cast("int")
    bucket = F.pmod(F.xxhash64("term"), F.ceil(F.col("lang_rows") / BUCKET)).cast("int")
    inside = W.partitionBy("lang", "band", "bucket").orderBy(F.desc("total"), "term")
    placed = sized.withColumns({"band": band, "bucket": bucket}).withColumn("place", F.dense_rank().over(inside) - 1)
    word, bit = F.floor(F.col("place") / 64).cast("int"), F.pmod("place", F.lit(64)).cast("int")
    mask = F.call_function("bit_or", F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit")))
    levels = placed.withColumns({"word": word, "bit": bit}).groupBy("lang", "band", "bucket", "word", "source", "group_n", "v", "n").agg(
        mask.alias("mask"), F.max("place").alias("last"))
    return levels.select("lang", "band", "bucket", "word", "source", _weight("n", "group_n", "v").alias("p"), "mask", "last")


def _meet(left: tuple, right: tuple, sums: np.ndarray, ordered: bool) -> None:
    """Add what two sets of bitsets ``(source, p, mask)`` of one word have in common to ``sums``."""
    (s, p, m), (t, q, k) = left, right
    step = max(1, CELLS // max(1, len(t)))
    for a in range(0, len(s), step):
        cells = np.bitwise_count(m[a:a + step, None] & k[None, :])
        i, j = np.nonzero(cells)
        n, i = cells[i, j].astype(np.int64), i + a
        if ordered:
            use = s[i] < t[j]
            i, j, n = i[use], j[use], n[use]
        away = p[i] - q[j]
        np.add.at(sums, (s[i], t[j]), n * (away * away // (p[i] + q[j])))


def bucket_sums(rows: pa.Table) -> tuple[list[str], np.ndarray]:
    """Sources of a bucket's tile, and the distance of each two on the bucket's terms.

    ``rows`` has the bitsets, and of each source a row of word -1 with the
    weight of a term that it lacks and the number of the bucket's terms.
    """
    head = rows.filter(pc.equal(rows["word"], -1)).combine_chunks().sort_by("source")
    body = rows.filter(pc.greater_equal(rows["word"], 0)).combine_chunks()
    names, ordered = head["source"].to_pylist(), rows["i"][0].as_py() == rows["j"][0].as_py()
    absent, terms = head["p"].to_numpy(), int(head["last"][0].as_py()) + 1
    block = head["block"].to_numpy()
    source = pc.index_in(body["source"], value_set=head["source"].combine_chunks()).to_numpy().astype(np.int64)
    word, p, mask = body["word"].to_numpy(), body["p"].to_numpy(), body["mask"].to_numpy().view(np.uint64)
    order = np.lexsort((source, word))
    source, word, p, mask = source[order], word[order], p[order], mask[order]
    every = np.arange(len(names))
    sides = (every, every) if ordered else (np.flatnonzero(block == rows["i"][0].as_py()), np.flatnonzero(block == rows["j"][0].as_py()))
    sums, seen = np.zeros((len(names), len(names)), np.int64), 0
    cuts = np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        size = min(64, terms - 64 * int(word[a]))
        seen += size
        some = np.zeros(len(names), np.uint64)
        np.bitwise_or.at(some, source[a:b], mask[a:b])
        lacking = np.uint64((1 << size) - 1) & ~some
        s, q, m = np.append(source[a:b], every), np.append(p[a:b], absent), np.append(mask[a:b], lacking)
        left, right = ((s[x], q[x], m[x]) for x in (np.isin(s, side) for side in sides))
        _meet(left, right, sums, ordered)
    away = absent[:, None] - absent[None, :]
    sums += (terms - seen) * (away * away // (absent[:, None] + absent[None, :]))
    use = np.triu(np.ones_like(sums, bool), 1) if ordered else np.isin(every, sides[0])[:, None] & np.isin(every, sides[1])[None, :]
    return names, np.where(use, sums, -1)


def group_distances(bitmaps: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, source, other, value)``, both ways, of the groups of languages that keep terms."""
    blocks = F.ceil(F.col("sources") / TILE).cast("int")
    groups = totals.filter("v > 0").select("lang", "source", _weight("0L", "group_n", "v").alias("absent"), blocks.alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    buckets = bitmaps.groupBy("lang", "band", "bucket").agg(F.max("last").alias("last"))
    heads = buckets.join(groups, "lang").select(
        "lang", "band", "bucket", F.lit(-1).alias("word"), "source", F.col("absent").alias("p"), F.lit(0).cast("bigint").alias("mask"), "last", "block", "blocks")
    body = bitmaps.join(groups.select("lang", "source", "block", "blocks"), ["lang", "source"]).select(*heads.columns)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiled = heads.unionByName(body).select("*", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    def run(rows: pa.Table) -> pa.Table:
        names, sums = bucket_sums(rows)
        a, b = np.nonzero(sums >= 0)
        said = pa.array(names, pa.string())
        lang = pa.array([rows["lang"][0].as_py()] * len(a), pa.string())
        return pa.table([lang, said.take(pa.array(a)), said.take(pa.array(b)), pa.array(sums[a, b], pa.int64())], ["lang", "a", "b", "value"])

    needed = tiled.select("lang", "band", "bucket", "i", "j", "word", "source", "p", "mask", "last", "block")
    parts = needed.groupBy("lang", "band", "bucket", "i", "j").applyInArrow(run, "lang string, a string, b string, value long")
    found = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("other")) for x, y in ("ab", "ba")])
    return found.select("lang", "value", F.inline(ways)).select("lang", "source", "other", "value")


def salient_terms(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, source, term, value)`` of terms that weigh more in a group than in its language."""
    rows = kept.join(totals.select("lang", "source", "group_n", "lang_n", "v"), ["lang", "source"])
    rows = rows.select("lang", "source", "term", _weight("n", "group_n", "v").alias("p"), _weight("total", "lang_n", "v").alias("q"))
    return rows.filter("p > q").select("lang", "source", "term", _apart("p", "q").alias("value"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP,
    lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: pairs of groups, and the terms that stand out in a group."""
    work = Workspace(docs.sparkSession)
    kept, _ = work.keep(kept_terms(term_counts(docs, lang_col, source_col, text_col), min_docs), "kept")
    totals, seen = work.keep(group_totals(docs, kept, lang_col, source_col), "totals")
    small = F.broadcast(totals) if seen["rows"] <= FEW_GROUPS else totals
    bitmaps, _ = work.keep(level_bitmaps(kept, small), "bitmaps")
    same = totals.filter("v = 0").select("lang", "source")
    same = same.join(same.select("lang", F.col("source").alias("other")), "lang").filter("source != other")
    pairs = group_distances(bitmaps, small).unionByName(same.withColumn("value", F.lit(0).cast("bigint")))
    best = salient_terms(kept, small)

    def ranked(rows: DataFrame, part: str, item: str) -> DataFrame:
        order = W.partitionBy("lang", "source").orderBy(F.desc("value"), item)
        return rows.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair", "other").unionByName(ranked(best, "term", "term").filter(F.col("rank") <= top))


ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
said AS (
  SELECT id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term FROM said GROUP BY ALL HAVING count(DISTINCT id) >= 10),
found AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS m FROM groups LEFT JOIN found USING (lang, source) GROUP BY ALL),
langs AS (
  SELECT lang, sum(m) AS m, (SELECT count(*) FROM kept k WHERE k.lang = s.lang) AS v FROM sizes s GROUP BY lang),
weights AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 2)) // (s.m + 2 * l.v) AS p
  FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN found f ON (f.lang, f.source, f.term) = (s.lang, s.source, k.term)),
whole AS MATERIALIZED (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(l.m) + 2 * any_value(l.v)) AS q
  FROM found JOIN langs l USING (lang) GROUP BY ALL),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM weights a JOIN weights b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM weights JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""
