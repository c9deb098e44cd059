import hashlib
import re

from fixtures_llm import documents, prose

from edgeworks.llm import decontaminate


def words(text):
    low = (text or "").translate(str.maketrans(decontaminate.UPPER, decontaminate.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, width=10):
    w, hit, of = words(text), set(), set()
    for item, said in items:
        v = words(said)
        size = min(width, len(v))
        for s in range(len(v) - size + 1) if size else ():
            for i in range(len(w) - size + 1):
                if w[i:i + size] == v[s:s + size]:
                    hit.update(range(i, i + size))
                    of.add(str(item))
    return len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)


def test_all_windows_are_found(spark, draw, monkeypatch):
    items = [(i, prose(draw, draw.choice([3, 9, 10, 11, 25]), 60)) for i in range(12)]
    items += [(90, "the"), (91, "the END"), (92, None), (93, "...!"), (94, items[4][1]), (95, " ".join(["the"] * 14)), (100, "É é ünï 日本 語")]
    texts = [None, "", "!!", "the the the", " ".join(["the"] * 40), "É é ünï 日本 語", "é é ünï 日本 語"]
    for _, said in items[:12]:
        w = said.split()
        texts += [prose(draw, 30, 60) + " " + said.upper() + ", " + prose(draw, 5, 60), " ".join(w[:10]), " ".join(w[1:]), " ".join(w[-10:] + w[:10]), "-".join(w)]
    texts += [prose(draw, 200, 60) for _ in range(5)] + [items[2][1]] * 2
    docs, bench = documents(spark, texts), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    want = {i: brute(t, items) for i, t in enumerate(texts)}
    for most in (decontaminate.BROADCAST_ROWS, -1):
        monkeypatch.setattr(decontaminate._small, "__defaults__", (most,))
        got = {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination(docs, bench).collect()}
        assert got == want
    assert sum(x[4] for x in want.values()) > 20


def test_empty_tables(spark):
    docs, bench = documents(spark, ["a b c"]), spark.createDataFrame([], "item_id long, text string")
    row = decontaminate.contamination(docs, bench).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (3, 0, 0, False)
    assert decontaminate.contamination(documents(spark, []), bench).collect() == []
    full = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(documents(spark, []), full).collect() == []


def test_the_rarest_shingle_is_the_prefix(spark):
    docs = documents(spark, ["a b c d"] * 5 + ["b c d e"])
    found = decontaminate.windows(spark.createDataFrame([(1, "a b c d e")], "item_id long, text string"))
    row = decontaminate.rarest_shingles(docs, found, [3]).first()
    assert row.offset == 2 and row.q == 3


def test_rows_without_an_id_do_not_pool_their_candidates(spark):
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(None, f"x a{i} b{i} c{i} y") for i in range(20)] + [(None, None)], "doc_id long, text string")
    found = decontaminate.windows(items)
    got = decontaminate.candidates(docs, decontaminate.rarest_shingles(docs, found, [3]), [3]).collect()
    assert len(got) == 20 and all(len(r.candidates) == 1 for r in got)
    assert [len(r.leaks) for r in decontaminate.find_leaks(docs, items).orderBy("text").collect()] == [0] + [1] * 20
