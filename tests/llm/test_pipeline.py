import hashlib
import os
import sys

from fixtures_llm import prose
from test_decontaminate import brute as leaks
from test_near_duplicates import brute as groups

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402

from edgeworks.llm import bpe  # noqa: E402

KIND = "doc_id long, text string, lang string, source string, n_chars long, words string, kept int"


def corpus(draw):
    passage = prose(draw, 30, 5000)
    rows = [(prose(draw, 60, 5000) + "\nfoot of the page", "a") for _ in range(30)] + [(prose(draw, 60, 5000), "b") for _ in range(10)]
    rows += [(rows[3][0], "b"), (rows[3][0] + " more", "b"), (None, "a"), ("12 34 !", "a"), ("foot of the page", "a")]
    rows += [(prose(draw, 40, 5000) + " " + passage, "b"), ("Foot\n\nof  the page", "c")]
    return passage, [(i, t, "en", s, len(t or ""), "w", 1) for i, (t, s) in enumerate(rows)]


def test_stages_follow_each_other(spark, draw, path):
    passage, rows = corpus(draw)
    docs = spark.createDataFrame(rows + [rows[5]], KIND)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    seen = [docs]
    for _, stage in pipeline.STAGES:
        out = stage(spark, seen[-1], path)
        seen.append(spark.createDataFrame(out.collect(), out.schema))
    assert all(x.columns == docs.columns for x in seen[:-1])
    after = [{r.doc_id: r for r in x.collect()} for x in seen]
    assert set(after[0]) - set(after[1]) == {42, 43}
    # Lines: the foot goes from site a alone, and untouched texts stay as they are.
    assert all("foot" not in after[2][i].text for i in range(30)) and after[2][44].text == "" and after[2][46].text == "Foot\n\nof  the page"
    assert all(after[2][i].n_chars == len(after[2][i].text) for i in after[2])
    ids = sorted(after[2])
    want = {ids[i] for i, _, _, kept in groups([after[2][i].text for i in ids], 5) if kept}
    assert set(after[3]) == want and 40 not in want and 41 not in want
    assert seen[3].count() == len(want)
    assert set(after[4]) == {i for i in after[3] if not leaks(after[3][i].text, [(1, passage)])[4]} == set(after[3]) - {45}
    for i, r in after[5].items():
        assert r.ids == bpe.encode(after[4][i].text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(after[4][i].text.encode()).hexdigest()
    whole = {r.doc_id: r.ids for r in pipeline.run(spark, path).collect()}
    assert whole == {i: r.ids for i, r in after[5].items()}


def test_empty_documents(spark, path):
    spark.createDataFrame([], KIND).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert pipeline.run(spark, path).collect() == []


def test_copies_do_not_make_a_text_boilerplate(spark, draw, path):
    """A third of a source are copies of one text: one of them comes out, with its text whole."""
    copied = prose(draw, 60, 5000) + "\n" + prose(draw, 60, 5000)
    texts = [prose(draw, 60, 5000) + "\nfoot of the page" for _ in range(20)] + [copied] * 8 + [copied.replace("\n", " \n\n")] * 2
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), "w", 1) for i, t in enumerate(texts)], KIND)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "no such words")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    cut = {r.doc_id: r.text for r in pipeline.without_boilerplate(spark, docs, path).collect()}
    assert all("foot" not in cut[i] for i in range(20)) and all(cut[i] == texts[i] for i in range(20, 30))
    out = {r.doc_id: r for r in pipeline.run(spark, path).collect()}
    assert set(out) == set(range(21)) and out[20].decoded_sha256 == hashlib.sha256(copied.encode()).hexdigest()


def test_rows_are_told_apart_by_id_and_text(spark, draw, path):
    """Different texts under one id, or none, are judged each on its own."""
    passage = prose(draw, 30, 5000)
    a, b, c, d, e, f = (prose(draw, 60, 5000) for _ in range(6))
    ids = [(None, a), (None, a + " more"), (None, a), (None, b), (None, c), (1, c), (5, d), (5, e), (5, e), (2, d + " more"), (7, f), (7, passage), (None, passage + " x")]
    rows = [(i, t, "en", f"s{k}", len(t), "w", 1) for k, (i, t) in enumerate(ids)]
    docs = spark.createDataFrame(rows, KIND)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    once = pipeline.without_near_copies(spark, docs, path)
    near = [(r.doc_id, r.text) for r in once.collect()]
    first = [x for x in near if x[1] in (a, a + " more")]
    # c stays under its id, d under the smaller one; both texts of 5 and of 7 have their own say.
    passages = [x for x in near if passage in x[1]]
    assert len(first) == 1 and first[0][0] is None and passages == [(7, passage)]
    assert sorted((x for x in near if x not in (*first, *passages)), key=str) == sorted([(None, b), (1, c), (5, e), (2, d + " more"), (7, f)], key=str)
    clean = pipeline.without_benchmark(spark, docs, path)
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted((x for x in ids if passage not in x[1]), key=str)


def test_a_line_goes_from_all_sources_that_have_it_at_about_a_tenth(spark, path):
    """Rates of 8.6 to 13.2%, as sf0.1 has them: the line is boilerplate on both sides of a tenth."""
    rows = [(s * 1000 + i, f"own {s} {i}" + ("\nfoot of the page" if i < n else ""), "en", f"s{s}", 1, "w", 1) for s, n in enumerate((43, 50, 51, 66)) for i in range(500)]
    out = pipeline.without_boilerplate(spark, spark.createDataFrame(rows, KIND), path)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(r[0], r[1].split("\n")[0]) for r in rows]
