import functools
import re
from collections import Counter, defaultdict

import pytest
from fixtures_llm import EXTRA

from edgeworks.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
ODD = ["", None, "a" * 100_000, "é É e-e'E", "x y", "12 3", "Ab aB AB ab", "中 國 \U0001f600a", "\x00a\x7fb_c"]


def rows_of(draw):
    """Languages with many sources, with no kept term, with one source; a source with a third of the rows."""
    rows = [(t, lang, s) for lang in ("en", None) for s in ("s0", "", None, "é", "z") for t in ODD]
    for k in range(400):
        source = "s0" if k % 3 == 0 else f"s{draw.randrange(9)}"
        words = [f"w{chr(97 + int(draw.paretovariate(0.8)) % 26)}{chr(97 + int(draw.paretovariate(0.4)) % 26)}" for _ in range(draw.randrange(60))]
        rows.append((" ".join(words), draw.choice(["en", "de"]), source))
    rows += [("same words here", "en", "s1")] * 30
    rows += [(f"few{k}x", "xx", f"s{k}") for k in range(5)] + [("lone " * 12, "yy", "only")] * 12
    return rows


def plainly(rows, min_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups.add((lang, source))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        terms = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(terms)
        mine = [s for x, s in groups if x == lang]
        total = {s: sum(counts[lang, s][t] for t in terms) for s in mine}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 2) // (total[s] + 2 * v) for t in terms} for s in mine}
        whole = {t: 1 + 10**9 * (sum(counts[lang, s][t] for s in mine) + 2) // (sum(total.values()) + 2 * v) for t in terms}
        def f(a, b):
            return (a - b) ** 2 // (a + b)
        pairs = [(sum(f(p[source][t], p[s][t]) for t in terms), s) for s in mine if s != source]
        said = [(f(p[source][t], whole[t]), t) for t in terms if counts[lang, source][t] and p[source][t] > whole[t]]
        for part, found, limit in (("pair", pairs, None), ("term", said, top)):
            for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(1, t, lang, s, 0, "w", 1, "n", "s", 1, "r", 0, 5) for t, lang, s in rows], EXTRA).repartition(3)


@pytest.mark.parametrize("small", [False, True])
def test_audit_by_hand(spark, draw, monkeypatch, small):
    if small:
        # Many buckets, tiles and pieces of cells, groups joined by shuffle.
        for name, value in (("TILE", 3), ("BUCKET", 120), ("CELLS", 50), ("BATCH", 2000), ("FEW_GROUPS", 0)):
            monkeypatch.setattr(divergence, name, value)
    rows = rows_of(draw)
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows), min_docs=3, top=4).collect())
    want = plainly(rows, 3, 4)
    # A language's only group stands alone: "yy" has no pair, and no term above its language's weight.
    assert {r[0] for r in want} == {"en", "", "de", "xx"} and any(r[4] > 0 for r in want if r[2] == "pair")
    assert got == want


def test_large_counts_are_exact(spark):
    kept = spark.createDataFrame([("l", "a", "t", 3 * 10**14, 4 * 10**14, True), ("l", "b", "t", 10**14, 4 * 10**14, False), ("l", "a", "u", 7, 7, True)],
                                 "lang string, source string, term string, n long, total long, first boolean")
    totals = divergence.group_totals(spark.createDataFrame([("l", "a"), ("l", "b")], "lang string, source string"), kept)
    rows = divergence.level_bitmaps(kept, totals).select("source", "p").collect()
    a, b = 3 * 10**14 + 7 + 4, 10**14 + 4
    assert sorted(tuple(r) for r in rows) == [
        ("a", 1 + 10**9 * 9 // a), ("a", 1 + 10**9 * (3 * 10**14 + 2) // a), ("b", 1 + 10**9 * (10**14 + 2) // b)]


def test_levels_are_sets_of_terms(spark):
    """Terms of one count in a group are bits of one set; no term stands in two sets of a group."""
    rows = [(f"{'t' + chr(97 + k // 26) + chr(97 + k % 26)} " * (1 + k % 4), "en", "s") for k in range(200)]
    docs = frame(spark, rows)
    kept = divergence.kept_terms(divergence.term_counts(docs), 1)
    found = divergence.level_bitmaps(kept, divergence.group_totals(docs, kept)).collect()
    assert sum((r.mask & (2**64 - 1)).bit_count() for r in found) == 200
    for word in {(r.band, r.bucket, r.word) for r in found}:
        masks = [r.mask & (2**64 - 1) for r in found if (r.band, r.bucket, r.word) == word]
        assert sum(m.bit_count() for m in masks) == functools.reduce(int.__or__, masks).bit_count()


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
