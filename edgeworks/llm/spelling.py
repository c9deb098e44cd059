"""Operator 11: spelling variants, grouped under their most frequent near word.

Runs of ASCII letters and U+00C0 to U+00FF are counted, A-Z in lower case. One
run in about 199, chosen by a checksum of document and run, loses one letter
first. Words are those of at least ``MIN_LENGTH`` code points and ``MIN_COUNT``
occurrences. Two are near if one insertion, deletion or replacement of a code
point makes one the other. A word's form is its most frequent near word (ties:
the smallest), if that is at least ``TIMES`` as frequent; its root is where
forms lead.

Near words are found by *Bloom-guided neighbourhoods*. The vocabulary's blocked
Bloom filters, one for each word length, are broadcast. Every word generates its
deletions, and the replacements of one letter by a greater one, so that each
near pair is generated once (an insertion is the other word's deletion); edits
that a filter denies end there, in numpy arrays of hashes. Only positives
become strings and are shuffled to the vocabulary table, where an exact join
removes the filter's mistakes.

Filters are broadcast in packs of at most ``PACK_BYTES``, one after the other:
a pack holds whole filters of neighbouring lengths, or one slice of a filter
that is larger; words longer than ``LONG`` share one. So broadcasts stay bounded
however large the vocabulary, and every edit meets the one slice that could hold
it. A word has at most about 180 near words for each code point, whatever the
corpus, so no join has an unbounded key. Roots are passed down from words
without a form, level by level; each level multiplies counts by ``TIMES``, so
there are few.

Null or empty text: no runs. A null document id counts as ''. Ids of any type
are taken as Spark casts them to strings. Very long runs are words like others;
their edits are generated in pieces. Repeated rows count as often as they stand
there. Extra columns do not matter. An empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.llm import bloom
from edgeworks.llm.common import sliced, texts
from edgeworks.loop import Workspace

MIN_LENGTH, MIN_COUNT, TIMES, ONE_IN = 6, 5, 5, 199
#: Words of this length and longer share one filter.
LONG = 64
#: Bytes of filters that are broadcast at a time.
PACK_BYTES = 16 << 20
#: Different words that a task counts before it hands them on, and edits that are probed at a time.
COUNTED, EDITS = 1 << 18, 1 << 20

_LETTER = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]
#: Bytes of Latin-1: letters as they are but for A-Z, all others a space.
_FOLDED = bytes((b | 0x20 if b < 0x5B else b) if b in _LETTER else 0x20 for b in range(256))
ALPHABET = np.array(sorted({_FOLDED[b] for b in _LETTER}), np.uint64)


def runs(text: str) -> list[bytes]:
    """The folded runs of a text in Latin-1, a byte for each code point."""
    return text.encode("latin-1", "replace").translate(_FOLDED).split()


def altered(run: bytes, start: int, one_in: int = ONE_IN) -> bytes:
    """The run, or in one case of ``one_in`` the run less one letter; ``start`` is the checksum of what stands before it."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % one_in:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, one_in: int = ONE_IN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(word, n)`` of all words; tasks add up theirs before the shuffle."""

    def offered(seen: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in seen], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(seen.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in sliced(batches):
            for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                start = crc32(f"{doc}:".encode())
                for found, n in Counter(runs(text)).items():
                    if len(found) >= min_length:
                        word = altered(found, start, one_in)
                        if len(word) >= min_length:
                            seen[word] += n
                if len(seen) > COUNTED:
                    yield offered(seen)
                    seen.clear()
        yield offered(seen)

    rows = texts(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


class Pack:
    """Filters that are broadcast together: ``{length: (first block, blocks)}``, of one slice of ``slices``."""

    def __init__(self, slices: int = 1, part: int = 0):
        self.where: dict[int, tuple[int, int]] = {}
        self.slices, self.part, self.blocks = slices, part, 0

    def add(self, length: int, keys: int) -> None:
        blocks = bloom.blocks_for(-(-keys // self.slices))
        self.where[length] = (self.blocks, blocks)
        self.blocks += blocks

    def here(self, sums: np.ndarray) -> np.ndarray:
        """Places of the keys that belong to this slice."""
        return np.arange(len(sums)) if self.slices == 1 else np.flatnonzero(bloom.slice_of(sums, self.slices) == self.part)


def packs(counts: dict[int, int], most: int | None = None) -> list[Pack]:
    """Filters of words of each length, packed in order; each pack at most ``most`` bytes."""
    most = (PACK_BYTES if most is None else most) // (8 * bloom.LANES)
    out: list[Pack] = []
    for length, keys in sorted(counts.items()):
        blocks = bloom.blocks_for(keys)
        if blocks > most:
            slices = -(-blocks // max(1, most - 1))
            for part in range(slices):
                out.append(Pack(slices, part))
                out[-1].add(length, keys)
            continue
        if not out or out[-1].slices > 1 or out[-1].blocks + blocks > most:
            out.append(Pack())
        out[-1].add(length, keys)
    return out


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their letters as a table of bounded size."""
    raw = [w.encode("latin-1") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        step = max(1, EDITS // (size * 4))
        for at in range(0, len(places), step):
            some = places[at:at + step]
            data = np.frombuffer(b"".join([raw[k] for k in some.tolist()]), np.uint8)
            yield some, data.reshape(len(some), size).astype(np.uint64)


def filter_table(words: DataFrame, pack: Pack) -> np.ndarray:
    """A pack's filters, built by the tasks block by block and gathered: at most ``PACK_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for _, letters in _by_length(batch["word"].to_pylist()):
                first, blocks = pack.where.get(min(letters.shape[1], LONG), (0, 0))
                if blocks:
                    sums = bloom.word_sums(letters)
                    block, bits = bloom.key_bits(sums[pack.here(sums)], blocks)
                    yield pa.RecordBatch.from_arrays([pa.array(block + first), *map(pa.array, bits.view(np.int64).T)], names)

    names = ["block", *(f"lane{k}" for k in range(bloom.LANES))]
    set_ = words.select("word").mapInArrow(run, ", ".join(f"{x} long" for x in names))
    found = set_.groupBy("block").agg(*[F.call_function("bit_or", F.col(x)).alias(x) for x in names[1:]]).toArrow()
    lanes = np.zeros((pack.blocks, bloom.LANES), np.uint64)
    at = found["block"].to_numpy()
    for k, name in enumerate(names[1:]):
        lanes[at, k] = found[name].to_numpy().view(np.uint64)
    return lanes


def _deletions(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of each different deletion of one letter."""
    size = letters.shape[1]
    numbers = bloom.place_numbers(size)
    with np.errstate(over="ignore"):
        kept, moved = letters * numbers, letters[:, 1:] * numbers[:-1]
        before = np.cumsum(kept, axis=1) - kept
        after = np.zeros_like(kept)
        after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1)[:, ::-1]
        sums = before + after
    # Of equal letters in a row, the last stands for all.
    last = np.ones(letters.shape, bool)
    last[:, :-1] = letters[:, :-1] != letters[:, 1:]
    row, place = np.nonzero(last)
    return row, place, sums[row, place]


def _replacements(letters: np.ndarray, sums: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Row, place, letter and hash of each replacement by a greater letter, place by place."""
    for place, number in enumerate(bloom.place_numbers(letters.shape[1])):
        now = letters[:, place]
        row, k = np.nonzero(ALPHABET[None, :] > now[:, None])
        with np.errstate(over="ignore"):
            yield row, place, ALPHABET[k], sums[row] + (ALPHABET[k] - now[row]) * number


def positives(words: DataFrame, pack: Pack, lanes) -> DataFrame:
    """``(word, n, edit)``: edits that a pack's filters, a broadcast table, do not deny."""

    def probe(length: int, sums: np.ndarray) -> np.ndarray:
        first, blocks = pack.where[min(length, LONG)]
        here = pack.here(sums)
        return here[bloom.may_hold(lanes.value[first:first + blocks], sums[here])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words, source, edits = batch["word"].to_pylist(), [], []
            for places, letters in _by_length(words):
                size = letters.shape[1]
                if min(size - 1, LONG) in pack.where:
                    row, place, sums = _deletions(letters)
                    hit = probe(size - 1, sums)
                    for k, p in zip(places[row[hit]].tolist(), place[hit].tolist()):
                        source.append(k)
                        edits.append(words[k][:p] + words[k][p + 1:])
                if min(size, LONG) in pack.where:
                    for row, p, letter, sums in _replacements(letters, bloom.word_sums(letters)):
                        hit = probe(size, sums)
                        for k, c in zip(places[row[hit]].tolist(), letter[hit].tolist()):
                            source.append(k)
                            edits.append(words[k][:p] + chr(c) + words[k][p + 1:])
                if len(edits) > EDITS // 8:
                    yield _rows(batch, source, edits)
                    source, edits = [], []
            yield _rows(batch, source, edits)

    return words.select("word", "n").mapInArrow(run, "word string, n long, edit string")


def _rows(batch: pa.RecordBatch, source: list[int], edits: list[str]) -> pa.RecordBatch:
    at = pa.array(source, pa.int64())
    return pa.RecordBatch.from_arrays([batch["word"].take(at), batch["n"].take(at), pa.array(edits, pa.string())], ["word", "n", "edit"])


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``, each near pair of a written vocabulary once."""
    spark = words.sparkSession
    shard = F.least(F.char_length("word"), F.lit(LONG)).alias("length")
    # At most LONG rows.
    counts = {r["length"]: r["count"] for r in words.groupBy(shard).count().collect()}
    found = [positives(words, p, spark.sparkContext.broadcast(filter_table(words, p))) for p in packs(counts)]
    if not found:
        return words.limit(0).select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n"))
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    edits = reduce(DataFrame.unionAll, found).withColumnRenamed("edit", "other")
    return edits.join(known, "other").select("word", "n", "other", "other_n")


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` of every word."""

    def side(word: str, other: str, other_n: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.struct((-F.col(other_n)).alias("less"), F.col(other).alias("other")).alias("near"))

    both = pairs.select(F.inline(F.array(side("word", "other", "other_n"), side("other", "word", "n"))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("near_words"), F.min("near").alias("best"))
    rows = words.join(best, "word", "left")
    good = -F.col("best.less") >= F.col("n") * times
    return rows.select(
        "word", "n", F.coalesce("near_words", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(good, F.col("best.other")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"))


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES, one_in: int = ONE_IN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the texts."""
    if times < 2:
        raise ValueError("times must be 2 at least, or forms could lead in a circle")
    work = Workspace(docs.sparkSession)
    words, _ = work.keep(vocabulary(docs, min_length, min_count, one_in, id_col, text_col), "words")
    known, _ = work.keep(forms(words, near_pairs(words), times), "forms")
    linked = known.filter("form IS NOT NULL").select("word", "form")
    level, rooted = known.filter("form IS NULL").select("word", F.col("word").alias("root")), []
    while True:
        above = level.select(F.col("word").alias("form"), "root")
        level, seen = work.keep(linked.join(above, "form").select("word", "root"), "level")
        if not seen.get("rows"):
            break
        rooted.append(level)
    if not rooted:
        rooted.append(level)
    roots = known.join(reduce(DataFrame.unionAll, rooted), "word", "left")
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = """
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS step
  FROM (SELECT unnest(range(256)) AS i)),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c:
      CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
    lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_table),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0
      THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM places),
shorter AS (SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS other FROM places),
pairs AS (
  SELECT a.word, b.word AS other FROM masked a JOIN masked b ON a.mask = b.mask AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.other = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.other = w.word),
ranked AS (
  SELECT p.word, p.other, o.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS place
  FROM pairs p JOIN words o ON o.word = p.other),
known AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
led AS (
  SELECT word, word AS root FROM known WHERE form IS NULL
  UNION ALL SELECT k.word, led.root FROM known k JOIN led ON k.form = led.word)
SELECT word, form, root, n, n_near, form_n FROM known JOIN led USING (word)
"""
