import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from fixtures_llm import documents

from edgeworks.llm import bloom, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(texts, ids, min_length=6, min_count=5, one_in=199):
    seen = Counter()
    for i, text in zip(ids, texts):
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= min_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plainly(words, times=5):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= times * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def crowd(draw):
    """Words and their edits, with chains of forms, ties, letters beyond ASCII, runs of one letter, very long words."""
    counts = {"receive": 300, "recieve": 6, "receiv": 60, "receivé": 12, "recéivé": 5, "reeeeive": 5, "aaaaaaa": 40, "aaaaaaaa": 8, "aaaaaa": 8,
              "ÿÀ×÷éé": 30, "ÿÀ×÷é": 9, "z" * 300: 90, "chainn": 900, "chainnn": 90, "chainnnn": 9, "z" * 299 + "y": 6, "z" * 301: 6, "y" * 63: 30, "y" * 64: 6, "y" * 65: 30, "y" * 66: 6}
    for _ in range(60):
        base = "".join(draw.choice("abcé") for _ in range(draw.randrange(6, 9)))
        counts[base] = draw.choice([5, 6, 30, 200])
    said = [w for w, n in counts.items() for _ in range(n)]
    said = [w.upper() if w.isascii() and draw.random() < 0.3 else w for w in said]
    draw.shuffle(said)
    texts = [", ".join(said[k:k + 40]) for k in range(0, len(said), 40)]
    return texts + [None, "", "short in-b.e..tween", "中receive國 _receive1receive"] + [texts[0]] * 2 + ["Ő" * 10]


@pytest.mark.parametrize("small", [False, True])
def test_groups_by_hand(spark, draw, monkeypatch, small):
    if small:
        # Filters in many packs, some of them divided, and tables of letters in pieces.
        for name, value in (("PACK_BYTES", 256), ("COUNTED", 20), ("EDITS", 64)):
            monkeypatch.setattr(spelling, name, value)
    texts = crowd(draw)
    words = plain_words(texts, range(len(texts)), one_in=7)
    want = plainly(words)
    got = sorted((tuple(r) for r in spelling.variants(documents(spark, texts), one_in=7).collect()), key=lambda r: r[0])
    assert got == want
    assert any(r[1] and r[2] != r[1] for r in want) and any(len(r[0]) > 200 and r[1] for r in want)


def test_divided_filters_hold_every_key_once(monkeypatch):
    counts = {6: 1000, 7: 10, 8: 10, 64: 500}
    found = spelling.packs(counts, most=1024)
    assert all(p.blocks * 64 <= 1024 for p in found) and len([p for p in found if 6 in p.where]) > 1
    sums = bloom.word_sums(np.arange(6000, dtype=np.uint64).reshape(1000, 6))
    parts = [p.here(sums) for p in found if 6 in p.where]
    assert sorted(np.concatenate(parts).tolist()) == list(range(1000))
    assert [p.where for p in spelling.packs(counts)] and len(spelling.packs(counts)) == 1


def test_filters_deny_most_and_never_a_key():
    rng = np.random.default_rng(5)
    keys, others = (rng.integers(0, 2**63, 20_000, dtype=np.uint64) for _ in range(2))
    blocks = bloom.blocks_for(len(keys))
    lanes = np.zeros((blocks, bloom.LANES), np.uint64)
    at, bits = bloom.key_bits(keys, blocks)
    np.bitwise_or.at(lanes, at, bits)
    assert len(bloom.may_hold(lanes, keys)) == len(keys)
    assert len(bloom.may_hold(lanes, others)) < 0.005 * len(others)


def test_hashes_of_edits_are_those_of_the_edited_words(draw):
    for word in ("abcdef", "aabbcc", "zzzzzzz", "éaébcÿ"):
        letters = np.frombuffer(word.encode("latin-1"), np.uint8).astype(np.uint64)[None, :]
        def hashed(x):
            return bloom.word_sums(np.frombuffer(x.encode("latin-1"), np.uint8).astype(np.uint64)[None, :])[0]
        _, place, sums = spelling._deletions(letters)
        cut = [word[:p] + word[p + 1:] for p in place]
        assert len(set(cut)) == len(cut) == len({word[:i] + word[i + 1:] for i in range(len(word))})
        assert [hashed(x) for x in cut] == sums.tolist()
        for _, p, letter, sums in spelling._replacements(letters, bloom.word_sums(letters)):
            for c, h in zip(letter.tolist(), sums.tolist()):
                assert hashed(word[:p] + chr(c) + word[p + 1:]) == h


def test_null_and_text_ids_repeated_rows(spark):
    ids = [None, "x", "x", None]
    rows = spark.createDataFrame([(i, "variant variant variant varian") for i in ids], "doc_id string, text string")
    got = {r.word: r.n for r in spelling.variants(rows, one_in=2, min_count=1, min_length=3).collect()}
    assert got == plain_words(["variant variant variant varian"] * 4, ids, 3, 1, 2)


def test_empty_table_and_refusals(spark):
    assert spelling.variants(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(documents(spark, []), times=1)
