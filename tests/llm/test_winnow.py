import hashlib
import random

import pytest
from pyspark.sql import functions as F

from edgeworks.llm import winnow


def choose(text, hashes, k=winnow.K, window=winnow.WINDOW):
    """Winnowing as it is defined, on known gram hashes: position of the rightmost least of each window."""
    if not text:
        return set()
    grams = [text[i:i + k] for i in range(len(text) - k + 1)] or [text]
    h = [hashes[g] for g in grams]
    found = set()
    for s in range(max(1, len(h) - window + 1)):
        part = h[s:s + window]
        low = min(part)
        found.add((low, s + max(i for i, x in enumerate(part) if x == low)))
    return found


def sample():
    draw = random.Random(5)
    letters = "abcde fghi\njklé😀ß"
    sizes = [0, 1, 3, 7, 8, 9, 22, 23, 24, 60, 183, 184, 185, 200, 400, 401, 1000]
    texts = ["".join(draw.choices(letters, k=n)) for n in sizes]
    return texts + ["aaaa" * 60, "ab" * 300, "".join(draw.choices("ab", k=20_000)), None, texts[-1]]


@pytest.fixture(scope="module")
def found(spark):
    texts = sample()
    docs = spark.createDataFrame([(i * 37, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, near int")
    rows = winnow.fingerprints(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).collect()
    return [t or "" for t in texts], {r.doc_id // 37: r for r in rows}


def hashes_of(spark, texts, k=winnow.K):
    grams = sorted({t[i:i + k] for t in texts for i in range(max(1, len(t) - k + 1))})
    rows = spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.shiftright(F.xxhash64("g"), 16).alias("h")).collect()
    return {r.g: r.h for r in rows}


def read(written):
    return {(int(h, 16), int(p)) for h, _, p in (x.partition("@") for x in written.split())}


def unsigned(pairs):
    return {(h & (1 << 48) - 1, p) for h, p in pairs}


def test_fingerprints_are_those_of_the_definition(spark, found):
    texts, rows = found
    after = texts[1:] + texts[:1]
    edits = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, after)]
    hashes = hashes_of(spark, texts + edits)
    assert sorted(rows) == list(range(len(texts)))
    for i, (text, edit, nxt) in enumerate(zip(texts, edits, after)):
        row, own, other = rows[i], choose(text, hashes), choose(edit, hashes)
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert read(row.fingerprint) == unsigned(own), i
        assert read(row.edited_fingerprint) == unsigned(other), i
        for value, b in ((row.near_edited, other), (row.near_next, choose(nxt, hashes))):
            x, y = {h for h, _ in own}, {h for h, _ in b}
            assert value == pytest.approx(1.0 if not x and not y else len(x & y) / len(x | y))


def test_equal_texts_have_equal_fingerprints(found):
    texts, rows = found
    assert rows[16].fingerprint == rows[len(texts) - 1].fingerprint


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert winnow.fingerprints(docs).collect() == []


def test_one_document_and_a_null_id(spark):
    docs = spark.createDataFrame([(None, "abc")], "doc_id long, text string")
    row = winnow.fingerprints(docs).first()
    assert row.doc_id is None and row.near_next == 1.0


def test_next_of_sparse_ids_meets_one_row_a_range(spark, draw):
    ids = sorted({draw.randrange(-(1 << 62), 1 << 62) for _ in range(3000)})
    found = winnow._successors(spark.createDataFrame([(i,) for i in ids], "near long").repartition(5))
    assert {(r.near, r.next) for r in found.collect()} == set(zip(ids, ids[1:] + ids[:1]))
    # The ranges that the single task reads are as many as partitions, not as ids.
    table = found.inputFiles()[0].rsplit("/", 1)[0]
    parts = spark.read.parquet(table)
    assert parts.count() == 3000 and parts.select("part").distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
