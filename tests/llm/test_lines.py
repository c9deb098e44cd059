import hashlib
from collections import Counter

from pyspark.sql import functions as F

from edgeworks.llm import lines


def test_frequent_lines_of_a_site_go(spark):
    texts = [("a", f"menu\nown {i}\n  menu \n\nfoot") for i in range(20)] + [("b", "menu\nonly b")] + [("c", f"c {i}\nrare" if i < 2 else f"c {i}") for i in range(40)]
    texts += [(None, "menu\nmenu"), ("a", None), ("a", ""), ("d", "one\ntwo")]
    docs = spark.createDataFrame([(i, s, t, 1, "x") for i, (s, t) in enumerate(texts)], "doc_id long, site string, text string, n int, digest string")
    got = {r.doc_id: list(r.kept) for r in lines.drop_boilerplate(docs.withColumn("lines", lines.text_lines(F.col("text")))).collect()}
    split = [[x.strip(" \t\r") for x in (t or "").split("\n") if x.strip(" \t\r")] for _, t in texts]
    total, seen = Counter(s for s, _ in texts), Counter((s, x) for (s, _), ls in zip(texts, split) for x in set(ls))
    for i, ((s, _), ls) in enumerate(zip(texts, split)):
        want = ls if s is None else [x for x in ls if not (seen[s, x] >= lines.MIN_PAGES and seen[s, x] > lines.RATIO * total[s])]
        assert got[i] == want, i
    assert got[0] == ["own 0"] and got[20] == ["menu", "only b"] and len(got) == len(texts)


def test_pages(spark):
    rows = [(i, f"HTTPS://Me@Host.example:80/{i}", f"<html><script>x</p>y</script><li>Home</li><p>Text <b>{i}</b></p><!-- <p>no</p> -->", 3) for i in range(10)]
    rows += [(10, None, "<p>Home</p>", 3), (11, "no address", None, 3), (11, "no address", None, 3)]
    found = {r.page_id: r for r in lines.page_report(spark.createDataFrame(rows, "page_id long, url string, html string, site int")).collect()}
    assert (found[3].site, found[3].n_lines, found[3].n_dropped) == ("host.example", 2, 1)
    assert found[3].kept_sha256 == hashlib.sha256(b"Text 3").hexdigest()
    assert (found[10].site, found[10].n_dropped) == (None, 0) and found[11].n_lines == 0


def test_empty_table(spark):
    assert lines.page_report(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "s", ["menu", str(i)]) for i in range(9)], "doc_id long, site string, lines array<string>")
    monkeypatch.setattr(lines, "BROADCAST_LINES", -1)
    assert sorted(r.kept[0] for r in lines.drop_boilerplate(docs).collect()) == [str(i) for i in range(9)]


def test_columns_of_any_name_are_kept(spark):
    docs = spark.createDataFrame([(i, "s", ["menu", str(i)], "x", "y", "z") for i in range(9)], "doc_id long, site string, lines array<string>, __dropped string, dropped_0 string, kept string")
    got = lines.drop_boilerplate(docs).collect()
    assert all((r["__dropped"], r.dropped_0, r.kept) == ("x", "y", [str(r.doc_id)]) for r in got) and len(got) == 9


def test_a_small_site_goes_by_the_ratio_alone(spark):
    docs = spark.createDataFrame([(i, "s", ["menu", str(i)]) for i in range(4)] + [(9, "t", ["alone"])], "doc_id long, site string, lines array<string>")
    assert sorted((r.doc_id, r.kept) for r in lines.drop_boilerplate(docs).collect()) == [(i, [str(i)]) for i in range(4)] + [(9, ["alone"])]
    assert all("menu" in r.kept for r in lines.drop_boilerplate(docs, min_pages=5).filter("site = 's'").collect())
