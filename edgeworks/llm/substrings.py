"""Operator 7: removal of repeated word sequences with an FM-index per shard.

A window is ``WINDOW`` words in a row. A word goes when a window that covers it
has the same words as one that starts earlier (smaller doc_id, or earlier in
the same document).

Sharding. A window's key is the least hash of the ``GRAM``-word grams inside it,
so equal windows have equal keys, and neighbouring windows mostly share theirs:
they travel together as one record, and a record's key names its shard. Grams
that very many records would share are found first (``HOT``) and ranked last;
a window of such grams only is its own record, keyed by all its words. So a key
gathers about ``HOT`` records, or one in ``HOT_SHARE`` of all, at most. Inside a
batch, a record whose words occurred earlier in the batch is settled at once
and not sent, so a common passage leaves a batch once.

In a shard the records, in order of (doc_id, start), are the text of an
FM-index. They are streamed through it: matching statistics by backward search
over the wavelet tree (narrow intervals by their suffixes) tell for each window whether it occurs elsewhere in the
shard, and the least text position among its suffixes whether earlier.
Intervals above the threshold go back to the documents.

Null or empty text: no words. Fewer words than a window: nothing is removed.
Rows that repeat a doc_id are read as the same document: none removes the
other. A null doc_id counts as the smallest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.llm.common import per_batch, sliced, texts
from edgeworks.llm.fm_index import FMIndex
from edgeworks.llm.shingles import folded, mixed
from edgeworks.loop import Workspace

WINDOW, GRAM = 20, 4
#: Records in a shard, about; records of one key beyond which its gram is hot; the share of all
#: records beyond which it is hot for sure.
SHARD_RECORDS, HOT, HOT_SHARE = 1 << 15, 2_000, 1 << 20
#: Text of the documents that are cut into records together.
BATCH_BYTES = 4 << 20
_END = b"\xff"
_TOP = np.uint64(1 << 63)
#: Words hashed together; their bytes fit a core's cache.
HASHED = 1 << 14
_SPACES = np.isin(np.arange(256), [*range(9, 14), 32])
with np.errstate(over="ignore"):
    _BYTES = np.where(_SPACES, np.uint64(0), mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def spaced(said: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text with one space between, as bytes, and where each begins."""
    text = np.frombuffer(said, np.uint8)
    gap = _SPACES[text]
    stays = ~gap
    stays[1:] |= stays[:-1] & gap[1:]
    if gap.any():
        text = np.where(gap, np.uint8(32), text)[stays]
    at = np.flatnonzero(text == 32) + 1
    return text, np.append(0, at) if len(text) else at


def hashed(text: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each word; equal words have equal ones."""
    out, edge = np.empty(len(begin), np.uint64), np.append(begin, len(text))
    for at in range(0, len(begin), HASHED):
        some = edge[at:at + HASHED + 1]
        sizes = np.diff(some)
        by_place = mixed(np.arange(1, int(sizes.max()) + 1, dtype=np.uint64) << np.uint64(8)) | np.uint64(1)
        place = np.arange(some[0], some[-1]) - np.repeat(some[:-1], sizes)
        with np.errstate(over="ignore"):
            out[at:at + HASHED] = np.add.reduceat(_BYTES[text[some[0]:some[-1]]] * by_place[place], some[:-1] - some[0])
    return mixed(out)


class Cut:
    """The words of a batch of documents and the keys of their windows.

    ``start`` and ``key`` are those of the windows; ``owner`` is the document
    of each word and ``begins`` where a document's words begin. ``grams`` are
    the hashes of the grams, and a window has so many: ``width``.
    """

    def __init__(self, said: list[str], window: int, gram: int, hot: np.ndarray | None):
        # No text in UTF-8 holds the byte that ends a document here.
        self.text, self.begin = spaced(b" ".join(x.encode() + b" " + _END for x in said))
        self.hashes = hashed(self.text, self.begin)
        over = self.text[self.begin] == _END[0]
        passed = np.concatenate([[0], np.cumsum(over)])
        self.owner = passed[:-1]
        self.begins = np.concatenate([[0], np.flatnonzero(over)[:-1] + 1])
        n = len(self.begin) - window + 1
        if n < 1:
            self.start, self.key = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        self.width = window - gram + 1
        m = len(self.begin) - gram + 1
        key = mixed(folded([self.hashes[i:i + m] for i in range(gram)])) >> np.uint64(1)
        if hot is not None and len(hot):
            key |= np.where(hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key, _TOP, np.uint64(0))
        self.grams, span, width = key, 1, self.width
        while 2 * span <= width:
            key, span = np.minimum(key[:-span], key[span:]), 2 * span
        if width > span:
            key = np.minimum(key[:-(width - span)], key[width - span:])
        self.start = np.flatnonzero(passed[:n] == passed[window:])
        self.key = key[self.start]

    def heads(self) -> np.ndarray:
        """Where records begin: the key changes, windows are no neighbours, or stand alone."""
        alone = (self.key & _TOP) != 0
        fresh = np.ones(len(self.start), bool)
        fresh[1:] = (np.diff(self.start) != 1) | (self.key[1:] != self.key[:-1]) | alone[1:] | alone[:-1]
        return np.flatnonzero(fresh)

    def twice(self, head: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Records of several windows that hold the gram of their key twice; no other repeats a window of its own."""
        out = np.zeros(len(head), bool)
        many = np.flatnonzero(count > 1)
        if len(many):
            sizes = count[many] + self.width - 1
            first = np.cumsum(sizes) - sizes
            at = np.repeat(self.start[head[many]] - first, sizes) + np.arange(int(sizes.sum()))
            same = self.grams[at] == np.repeat(self.key[head[many]], sizes)
            out[many] = np.add.reduceat(same, first, dtype=np.int64) > 1
        return out

    def said(self, first: np.ndarray, length: np.ndarray) -> list[bytes]:
        """The words of some stretches, joined by one space."""
        text, begin = self.text.tobytes(), self.begin[first]
        end = np.append(self.begin[1:], len(text) + 1)[first + length - 1] - 1
        return [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def hot_grams(work: Workspace, rows: DataFrame, window: int, gram: int, least: int = HOT, share: int = HOT_SHARE) -> tuple[np.ndarray, int]:
    """Sorted hot grams, and the number of records.

    A task offers the keys of two records or more, and of more than one in
    ``2 * share`` of its own. A key that holds one in ``share`` of all records
    does so in some task at least, and what other tasks leave out is half of
    that at most. So every such key is found, and there are fewer than
    ``2 * share`` that are called hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in sliced(batches, BATCH_BYTES):
            cut = Cut(batch["text"].to_pylist(), window, gram, None)
            found.append(cut.key[cut.heads()])
        keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        many = n >= max(2, n.sum() // (2 * share))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *keys[many].view(np.int64).tolist()], pa.int64()), pa.array([int(n.sum()), *n[many].tolist()], pa.int64())], ["key", "n"])

    offered = rows.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts, seen = work.keep(offered.filter(F.col("key").isNull() | (F.col("n") > least)), "grams", total=F.sum(F.when(F.col("key").isNull(), F.col("n"))))
    total = seen.get("total") or 0
    found = counts.filter(F.col("key").isNotNull() & (F.col("n") > total // (2 * share))).select("key").toArrow()["key"].to_numpy()
    work.clear()
    return np.sort(found.astype(np.int64).view(np.uint64)), total


def packed(docs: np.ndarray, starts: np.ndarray, counts: np.ndarray, keys: np.ndarray, twice: np.ndarray, said: bytes) -> bytes:
    """Records in one compressed blob: places, numbers of windows, half of the keys, whether they hold a key's gram twice, words."""
    parts = [np.int64(len(docs)), docs, starts.astype(np.int32), counts.astype(np.int32), keys.astype(np.uint32), twice]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x.tobytes() for x in parts) + said)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in (np.int64, np.int32, np.int32, np.uint32, np.bool_):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out[0], out[1].astype(np.int64), out[2].astype(np.int64), out[3], out[4], raw[at:]


def records(cut: Cut, ids: np.ndarray, window: int, shards: int) -> Iterator[tuple[int, bytes]]:
    """Blobs of a batch's records by shard; those without words are windows already settled."""
    if not len(cut.start):
        return
    head = cut.heads()
    count = np.diff(head, append=len(cut.start))
    start, key, twice = cut.start[head], cut.key[head], cut.twice(head, count)
    alone = (key & _TOP) != 0
    if alone.any():
        key[alone] = folded([cut.hashes[start[alone] + i] for i in range(window)])
    owner = cut.owner[start]
    local = start - cut.begins[owner]
    order = np.lexsort((local, ids[owner]))
    seen, settled, said = {}, np.zeros(len(head), bool), cut.said(start, count + window - 1)
    places = list(zip(ids[owner].tolist(), local.tolist(), strict=True))
    for r in order.tolist():
        settled[r] = seen.setdefault(said[r], places[r]) < places[r]
    to = np.where(settled, mixed(ids[owner].astype(np.uint64)), mixed(key)) % np.uint64(shards)
    by = np.lexsort((settled, to))
    fresh = (np.diff(to[by].astype(np.int64), prepend=-1) != 0) | (np.diff(settled[by].astype(np.int8), prepend=-1) != 0)
    for group in np.split(by, np.flatnonzero(fresh)[1:]):
        text = b"" if settled[group[0]] else b"\n".join(said[r] for r in group.tolist())
        yield int(to[group[0]]), packed(ids[owner[group]], local[group], count[group], key[group], twice[group], text)


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self) + 1
        return found


def repeated_windows(docs: np.ndarray, starts: np.ndarray, said: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated stretches ``(doc, begin, end)`` of the records of one shard, by an FM-index of them."""
    order = np.lexsort((starts, docs)).tolist()
    docs, starts = docs[order], starts[order]
    codes = _Codes()
    parts = [np.fromiter(map(codes.__getitem__, x.split(b" ")), np.int32) for x in (said[r] for r in order)]
    size = np.array([len(x) for x in parts], np.int64)
    # A 0 ends each record.
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    text = np.zeros(int((size + 1).sum()), np.int64)
    rec = np.repeat(np.arange(len(parts)), size + 1)
    inside = np.ones(len(text), bool)
    inside[begin + size] = False
    text[inside] = np.concatenate(parts)
    index = FMIndex(text, window)
    offset = np.arange(len(text)) - begin[rec]
    ends = np.flatnonzero(inside & (offset >= window - 1))
    reach, low, high = index.matching_statistics(text, ends)
    full = reach == window
    at = ends[full] - (window - 1)
    first = index.first_places(low[full], high[full])
    doc, place = docs[rec], starts[rec] + offset
    later = (doc[first] < doc[at]) | ((doc[first] == doc[at]) & (place[first] < place[at]))
    return runs(rec[at[later]], doc[at[later]], place[at[later]], window)


def runs(group: np.ndarray, doc: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows of a group joined into stretches."""
    if not len(place):
        return doc, place, place
    fresh = np.ones(len(place), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(place)) - 1
    return doc[head], place[head], place[tail] + window


def _shard(group: pa.Table, window: int) -> pa.Table:
    out, docs, starts, keys, own, said = [], [], [], [], [], []
    for blob in group["blob"]:
        doc, start, count, key, twice, words = unpacked(blob.as_py())
        if not words:
            out.append((doc, start, start + count + window - 1))
            continue
        docs.append(doc)
        starts.append(start)
        keys.append(key)
        own.append(twice)
        said += words.split(b"\n")
    if docs:
        # A record whose key stands alone shares no window with another; its own repeat only if the gram of its key does.
        key, doc, start = np.concatenate(keys), np.concatenate(docs), np.concatenate(starts)
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        keep = np.flatnonzero((times[back] > 1) | np.concatenate(own))
        if len(keep):
            out.append(repeated_windows(doc[keep], start[keep], [said[r] for r in keep.tolist()], window))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["doc", "begin", "end"])


def repeated_stretches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """``(doc, begin, end)``: word ranges, possibly overlapping, that repeat earlier ones."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), "text")
    found, total = hot_grams(Workspace(spark), rows, window, gram, hot)
    grams = spark.sparkContext.broadcast(found)
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // shard_records)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH_BYTES):
            made = Cut(batch["text"].to_pylist(), window, gram, grams.value)
            rows = list(records(made, batch["doc"].to_numpy(), window, shards))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], ["shard", "blob"])

    sent = rows.mapInArrow(cut, "shard int, blob binary")
    return sent.groupBy("shard").applyInArrow(lambda group: _shard(group, window), "doc long, begin long, end long")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_records: int = SHARD_RECORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``; kept is the words that stay, joined by one space."""
    rows = texts(docs, id_col, text_col)
    found = repeated_stretches(rows, window, gram, hot, shard_records)
    gone = found.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("gone"))
    joined = rows.join(gone, F.coalesce(rows["doc_id"].cast("long"), F.lit(-(1 << 63))) == gone["doc"], "left").select("doc_id", "text", "gone")

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, lost, kept = [], [], []
        for text, ranges in zip(batch["text"].to_pylist(), batch["gone"].to_pylist(), strict=True):
            said = text.encode().split()
            total.append(len(said))
            if ranges:
                edge = np.zeros(len(said) + 1, np.int64)
                for x in ranges:
                    edge[min(x["begin"], len(said))] += 1
                    edge[min(x["end"], len(said))] -= 1
                stays = np.cumsum(edge)[:-1] == 0
                said = [said[i] for i in np.flatnonzero(stays).tolist()]
            lost.append(total[-1] - len(said))
            kept.append(b" ".join(said).decode())
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return per_batch(joined, remove, f"doc_id {kind}, n_words long, n_removed long, kept string")


def report(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS said
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
first AS (SELECT said, min({'doc': doc_id, 'i': i}) AS f FROM win GROUP BY said HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS k
  FROM win JOIN first USING (said) WHERE f < {'doc': doc_id, 'i': i}),
lost AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS k, unnest(w) AS x FROM d WHERE len(w) > 0),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS said FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
