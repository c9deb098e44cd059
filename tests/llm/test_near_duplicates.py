import re

import numpy as np
from fixtures_llm import documents, prose

from edgeworks.llm import components, minhash, shingles
from edgeworks.loop import Workspace


def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(texts, k, percent=80):
    sets = []
    for t in texts:
        w = words_of(t)
        k_ = min(k, len(w))
        sets.append({tuple(w[i:i + k_]) for i in range(len(w) - k_ + 1)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def family(draw):
    """Exact copies, near copies, chains in which only neighbours are alike, borderline pairs, odd texts."""
    base = prose(draw, 120).split()
    texts = [" ".join(base)] * 5
    for edits in (1, 2, 3, 4, 5, 6, 7, 8, 10, 14):
        for _ in range(3):
            w = list(base)
            for at in draw.sample(range(len(w)), edits):
                w[at] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(w))
    chain = prose(draw, 100, 5000).split()
    for step in range(12):
        texts.append(" ".join(chain[step * 5:] + [f"c{step}_{i}" for i in range(step * 5)]))
    texts += [None, "", " \n", "One", "one", "ONE", "two words", "Two  Words", "Ünïcode É", "ünïcode é", "a b c", "a b c a b c"]
    texts += [prose(draw, n) for n in (1, 2, 3, 5, 8, 13, 400)] * 2
    draw.shuffle(texts)
    return texts


def test_components_are_those_of_all_links(spark, draw):
    texts = family(draw)
    for k in (2, 5):
        got = sorted(tuple(r) for r in minhash.near_duplicates(documents(spark, texts), words=k).collect())
        assert got == brute(texts, k)


def test_a_crowd_of_unlike_texts_in_shared_buckets(spark, draw, monkeypatch):
    """One band of one bin puts much together that is no match; further centres must still find every link."""
    base = prose(draw, 40, 60).split()
    texts = []
    for _ in range(60):
        w = list(base)
        for at in draw.sample(range(len(w)), draw.choice([1, 2, 6, 12])):
            w[at] = f"y{draw.randrange(50)}"
        texts.append(" ".join(w))
    got = sorted(tuple(r) for r in minhash.near_duplicates(documents(spark, texts), words=2, bands=60, rows=1).collect())
    assert got == brute(texts, 2)


def crowd(draw, size, edits, words=60):
    """Edits of one text, each at places and with words of its own; the text itself is not there."""
    base, texts = prose(draw, words, 5000).split(), []
    for _ in range(size):
        w = list(base)
        for at in draw.sample(range(words), draw.choice(edits)):
            w[at] = f"z{draw.randrange(10**9)}"
        texts.append(" ".join(w))
    return texts


def test_crowds_on_the_edge_of_likeness(spark, draw):
    """Without the text that they come from, some are links, most are not quite."""
    texts = crowd(draw, 60, [1, 2, 3]) + crowd(draw, 60, [3]) + crowd(draw, 40, [2, 4, 8]) + crowd(draw, 40, [1, 2], 25)
    for k, bands, rows in ((2, 48, 5), (5, 60, 1)):
        got = sorted(tuple(r) for r in minhash.near_duplicates(documents(spark, texts), words=k, bands=bands, rows=rows).collect())
        assert got == brute(texts, k)


def test_differences_bring_alike_texts_together(draw):
    """The bound itself, over random sets: alike ones meet in a difference where one may lead, or are linked to the centre."""
    for percent in (60, 80, 90):
        for _ in range(1500):
            base = set(range(draw.randrange(4, 40)))
            c, a, b = (frozenset((base - set(draw.sample(sorted(base), draw.randrange(0, 4)))) | {draw.randrange(100, 112) for _ in range(draw.randrange(4))}) for _ in range(3))
            if not (a and b and c and len({a, b, c}) == 3):
                continue

            def alike(x, y):
                return 100 * len(x & y) >= percent * len(x | y)

            def place(x, item):
                return sorted(x ^ c, reverse=True).index(item)

            if alike(a, b) and not (alike(a, c) and alike(b, c)):
                shared = (a ^ c) & (b ^ c)
                assert shared
                first = max(shared)
                assert all(place(x, first) * percent <= len(x) * (100 - percent) for x in (a, b))
                assert any(place(x, first) * 2 * percent <= len(x) * (100 - percent) for x in (a, b))
                ahead = min(len(x ^ c) - place(x, first) for x in (a, b))
                assert 2 * ahead * (100 + percent) >= (len(a ^ c) + len(b ^ c)) * (100 + percent) - (len(a) + len(b)) * (100 - percent)


def test_comparisons_grow_no_faster_than_a_crowd_of_unlike_texts(spark, draw, monkeypatch):
    kept, compared = Workspace.keep, []

    def keep(self, df, name="step", **metrics):
        found = kept(self, df, name, **metrics)
        if name == "compared":
            compared.append(found[1]["rows"])
        return found

    monkeypatch.setattr(Workspace, "keep", keep)
    sums = []
    for size in (100, 400):
        compared.clear()
        minhash.near_duplicates(documents(spark, crowd(draw, size, [8])), words=2).collect()
        sums.append(sum(compared))
    assert sums[1] <= 6 * sums[0]


def test_densified_bins_agree_as_often_as_sets(draw):
    look = minhash.orders(240)
    agree = []
    for _ in range(40):
        both, a, b = (np.unique(np.random.default_rng(draw.randrange(10**9)).integers(0, 2**64, n, np.uint64)) for n in (8, 1, 1))
        x, y = (minhash.signature(np.unique(np.concatenate([both, own])), look) for own in (a, b))
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - 0.8) < 0.05


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(7, "a b c"), (7, "a b c"), (None, "a b c"), (None, None), (9, "z")], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash.near_duplicates(docs, words=2).collect())
    assert rows == [("7", 2, "7", True), ("7", 2, "7", True), ("9", 1, "9", True), ("None", 0, "None", True), ("None", 2, "7", False)]
    assert minhash.near_duplicates(documents(spark, [])).collect() == []


def test_components_of_a_long_path(spark, draw):
    order = list(range(300))
    draw.shuffle(order)
    pairs = [(order[i], order[i + 1]) for i in range(199)] + [(order[i], order[i + 1]) for i in range(200, 299)]
    found = {r.node: r.root for r in components.components(Workspace(spark), spark.createDataFrame(pairs, "a long, b long")).collect()}
    for part in (order[:200], order[200:]):
        assert {found.get(x, x) for x in part} == {min(part)}


def test_shingles_ignore_case_of_ascii_alone():
    assert set(shingles.shingle_set("A b", 2)) == set(shingles.shingle_set("a\tB", 2)) != set(shingles.shingle_set("É b", 2))
    assert len(shingles.shingle_set("one two", 5)) == 1 and len(shingles.shingle_set(None, 5)) == 0


def test_python_gets_few_rows_at_once(spark, monkeypatch):
    name, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    usual, keep = spark.conf.get(name), Workspace.keep

    def kept(self, df, step="step", **metrics):
        if step in ("signatures", "sets"):
            sizes.append(int(spark.conf.get(name)))
        return keep(self, df, step, **metrics)

    monkeypatch.setattr(Workspace, "keep", kept)
    rows = [(i, " ".join(f"w{x}" for x in range(60)) + f" end{i // 2}") for i in range(6)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2, percent=80)
    assert [x.component_id for x in found.collect()] == [0] * 6
    assert len(sizes) == 2 and all(x <= 1000 for x in sizes) and spark.conf.get(name) == usual
    # A worker of a corpus with millions of words remembers some tens of MB of them.
    assert shingles.REMEMBERED <= 1 << 17
