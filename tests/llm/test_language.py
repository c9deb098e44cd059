import random
import zlib

import numpy as np
from fixtures_llm import documents

from edgeworks.llm import language

STEMS = {"en": ["the", "ing", "wh", "tion"], "de": ["sch", "ung", "ä", "keit"], "fr": ["eau", "que", "é", "oux"]}


def made(draw, lang):
    return " ".join("".join(draw.choices(STEMS[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(3, 40)))


def corpus(n=240):
    draw = random.Random(9)
    langs = [draw.choice(list(STEMS)) for _ in range(n)]
    return langs, [made(draw, x) for x in langs]


def test_held_out_documents_are_known(spark):
    langs, texts = corpus()
    rows = [(i, t, x, "s", 1, 0.0) for i, (t, x) in enumerate(zip(texts, langs))]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 ... 456 ☃", "en"), (1003, "sch " * 100_000, "de"), (1004, "schung keit", None)]
    rows += [(i, t, x, "s", 1, 0.0) for i, t, x in odd] + [(None, "eau queé oux", "fr", "s", 1, 0.0), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    found = language.report(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i, lang in enumerate(langs):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    aside = [i for i in range(len(langs)) if by[i].held_out]
    assert sum(by[i].lang_pred == langs[i] for i in aside) >= 0.98 * len(aside) > 50
    assert all(0 <= r.score <= 1 for r in found)
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and by[1000].score == 0
    assert by[1003].lang_pred == by[1004].lang_pred == "de" and by[None].lang_pred == "fr"


def test_labels_of_held_out_documents_change_nothing(spark):
    langs, texts = corpus(90)
    aside = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(90)]
    make = lambda wrong: spark.createDataFrame([(i, t, wrong if a else x) for i, (t, x, a) in enumerate(zip(texts, langs, aside))], "doc_id long, text string, lang string")
    a, b = (language.train(make(x)) for x in ("xx", "de"))
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_most_weights_are_zero(spark):
    langs, texts = corpus()
    model = language.train(spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string"))
    assert 0 < np.count_nonzero(model.weights) < 0.1 * model.weights.size


def test_temperature_makes_scores_honest():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 4000)
    said = np.where(rng.random(4000) < 0.8, truth, rng.integers(0, 3, 4000))
    logits = np.eye(3)[said] * 20.0
    t = language.fit_temperature(logits, truth)
    p = language.softmax(logits / t).max(1).mean()
    assert abs(p - (said == truth).mean()) < 0.03


def test_long_texts_are_counted_whole(monkeypatch):
    text = "".join(random.Random(1).choices("abcdé ", k=5000))
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "_STEP", 7)
    parts = language.gram_counts(text)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language.report(docs).first().lang_pred == "und"
    assert language.report(documents(spark, [])).collect() == []
