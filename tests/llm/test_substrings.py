import hashlib
import re

import numpy as np
import pytest
from fixtures_llm import documents, prose

from edgeworks.llm import fm_index, substrings


def brute(texts, window=20):
    first, words = {}, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    gone = [set() for _ in texts]
    for d, w in enumerate(words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in first:
                gone[d].update(range(i, i + window))
            else:
                first[key] = (d, i)
    out = {}
    for d, w in enumerate(words):
        kept = " ".join(x for i, x in enumerate(w) if i not in gone[d])
        out[d] = (len(w), len(gone[d]), hashlib.sha256(kept.encode()).hexdigest())
    return out


def texts(draw):
    passage, base = prose(draw, 60), prose(draw, 150)
    out = [None, "", " ", "few words", base, base, base + " more", passage, "x " + passage + " y", passage + " " + passage]
    out += [prose(draw, 30) + " " + passage + " " + prose(draw, 30) for _ in range(25)]
    out += ["a " * 100, "a b " * 60, "b a " * 30, " ".join(f"u{i % 23}" for i in range(90))]
    out += [" ".join(passage.split()[i:i + 19 + i]) for i in range(6)]
    w = base.split()
    for at in range(0, 150, 30):
        out.append(" ".join([*w[:at], "edit", *w[at + 1:]]))
    out += ["Ünï\x1ccode x " * 25, prose(draw, 19), prose(draw, 20), prose(draw, 20, 2), prose(draw, 200, 2), prose(draw, 200, 2)]
    return out


@pytest.mark.parametrize("hot", [2, substrings.HOT])
def test_words_of_repeated_windows_go(spark, draw, hot):
    said = texts(draw)
    docs = documents(spark, said).repartition(3, "text")
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substrings.without_repeats(docs, hot=hot).collect()}
    assert got == brute(said)


def test_repeated_rows_and_null_ids(spark, draw):
    said = prose(draw, 40)
    docs = spark.createDataFrame([(5, said), (5, said), (8, said), (None, said)], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.n_removed) for r in substrings.without_repeats(docs).collect())
    assert rows == [("5", 40), ("5", 40), ("8", 40), ("None", 0)]
    docs = docs.filter("doc_id is not null")
    assert sorted((r.doc_id, r.n_removed) for r in substrings.without_repeats(docs).collect()) == [(5, 0), (5, 0), (8, 40)]


def test_empty_table(spark):
    assert substrings.without_repeats(documents(spark, [])).collect() == []


def test_index_counts_and_matching_statistics():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 5, 500), 0)
    index = fm_index.FMIndex(text, 12)
    order = sorted(range(len(text)), key=lambda i: text[i:i + 12].tolist())
    assert [text[i:i + 12].tolist() for i in index.order] == [text[i:i + 12].tolist() for i in order]
    ends = np.arange(12, 480)
    reach, low, high = index.matching_statistics(text, ends)
    rows = text.tolist()

    def count(pattern):
        return sum(rows[i:i + len(pattern)] == pattern for i in range(len(rows)))

    for e, n, a, b in zip(ends.tolist(), reach.tolist(), low.tolist(), high.tolist()):
        assert n == 0 or count(rows[e - n + 1:e + 1]) > 1
        assert n == 12 or count(rows[e - n:e + 1]) == 1
        if n == 12:
            assert b - a == count(rows[e - 11:e + 1])
    full = reach == 12
    first = index.first_places(low[full], high[full])
    for e, f in zip(ends[full].tolist(), first.tolist()):
        assert f == min(i for i in range(len(rows)) if rows[i:i + 12] == rows[e - 11:e + 1])


def test_rank_over_the_wavelet_tree():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 11, 300)
    tree = fm_index.WaveletMatrix(codes, 4)
    for c in range(11):
        at = np.arange(301)
        assert tree.rank(np.full(301, c), at).tolist() == [int((codes[:i] == c).sum()) for i in at]


def test_narrow_intervals_are_not_counted_in_the_tree(monkeypatch):
    rng = np.random.default_rng(3)
    once = rng.integers(1, 400, 600)
    text = np.concatenate([once, [0], once, [0], np.tile(rng.integers(1, 400, 40), 30), [0]])
    index, asked, rank = fm_index.FMIndex(text, 20), [], fm_index.WaveletMatrix.rank
    monkeypatch.setattr(fm_index.WaveletMatrix, "rank", lambda tree, codes, at: asked.append(len(codes)) or rank(tree, codes, at))
    ends = np.arange(19, 600)
    reach, low, high = index.matching_statistics(text, ends)
    assert (reach == 20).all() and (high - low == 2).all()
    ends = np.arange(1202 + 19, 1202 + 1200)
    reach, low, high = index.matching_statistics(text, ends)
    assert (reach == 20).all() and (high - low >= 29).all()
    # Each different interval once: 40 places of a period, 20 steps, two ends.
    assert sum(asked) < 2 * 2 * 40 * 20


def test_words_of_a_batch_and_their_hashes():
    said = ["a  b\tc\n", "", " ", "\x0bx\x0c\x0dy  é\x1cz q ", "w" * 70000 + " a", "ab ba"]
    cut = substrings.Cut(said, 3, 2, None)
    want = b" ".join(x.encode() + b" " + b"\xff" for x in said).split()
    got = cut.said(np.arange(len(want)), np.ones(len(want), np.int64))
    assert got == want and cut.said(np.array([0]), np.array([3])) == [b"a b c"]
    known = dict(zip(got, cut.hashes.tolist(), strict=True))
    assert len(set(known.values())) == len(known) and all(known[w] == h for w, h in zip(got, cut.hashes.tolist(), strict=True))


def test_only_records_with_a_gram_twice_may_repeat_their_own_windows():
    base = " ".join(f"u{i}" for i in range(15))
    cut = substrings.Cut([" ".join(f"v{i}" for i in range(90)), f"{base} {base} {base} {base}", "a " * 60], 20, 4, None)
    head = cut.heads()
    count = np.diff(head, append=len(cut.start))
    twice, of = cut.twice(head, count), cut.owner[cut.start[head]]
    assert not twice[of == 0].any() and twice[of == 1].any() and twice[of == 2].all()
