import math
import random
from collections import Counter

import numpy as np
import pytest
from fixtures_llm import documents

from edgeworks.llm import language_model as lm


def chain(draw, n):
    """Words of which each tells its neighbours."""
    at, out = draw.randrange(50), []
    for _ in range(n):
        out.append(f"w{at}")
        at = (at * 3 + draw.choice([1, 2])) % 50
    return " ".join(out)


@pytest.fixture(scope="module")
def learned(spark):
    draw = random.Random(6)
    texts = [chain(draw, 400) for _ in range(150)]
    docs = documents(spark, texts).select("doc_id", "text").repartition(3)
    words = lm.vocabulary(docs)
    return texts, words, lm.train(docs, words, rounds=4)


def log_prob(net, near, target):
    """The same in plain steps."""
    x = net.bias.astype(float)
    for j, w in enumerate(near):
        x = x + net.embed[w].astype(float) @ net.mix[j]
    h = np.tanh(x)
    c = target // lm.CLASS
    a, b = h @ net.classes + net.class_bias, h @ net.members[c] + net.member_bias[c]
    return a[c] - np.log(np.exp(a).sum()) + b[target % lm.CLASS] - np.log(np.exp(b).sum())


def test_scores_are_sums_over_all_words(spark, learned):
    texts, words, net = learned
    odd = [None, "", "w1", "unknown words here", texts[0], texts[0].upper(), "w1 " * 50_000]
    got = {r.doc_id: r for r in lm.score(lm.texts(documents(spark, odd)), net, words).collect()}
    for i, text in enumerate(odd[:-1]):
        ids = words.encode(lm.split(text)).tolist()
        row = [lm.BEYOND] * lm.SIDE + ids + [lm.BEYOND] * lm.SIDE
        want = 0.0
        for k, w in enumerate(ids):
            near = [row[k + lm.SIDE + p] for p in lm._PLACES]
            want += log_prob(net, near, w) - (math.log(words.unknown) if w == lm.OTHER else 0)
        assert got[i].n_tokens == len(ids) and got[i].log_likelihood == pytest.approx(want, rel=1e-4, abs=1e-4)
    assert got[6].n_tokens == 50_000 and got[4].log_likelihood == pytest.approx(got[5].log_likelihood)


def test_both_sides_say_more_than_frequency(spark, learned):
    _, words, net = learned
    draw = random.Random(77)
    fresh = [chain(draw, 300) for _ in range(10)]
    counts = Counter(w for t in fresh for w in t.split())
    n = sum(counts.values())
    unigram = sum(c * math.log(c / n) for c in counts.values()) / n
    rows = lm.score(lm.texts(documents(spark, fresh)), net, words).collect()
    mean = sum(r.log_likelihood for r in rows) / n
    assert mean > unigram + 0.5
    mixed = [" ".join(random.Random(3).sample(t.split(), 300)) for t in fresh]
    other = lm.score(lm.texts(documents(spark, mixed)), net, words).collect()
    assert sum(r.log_likelihood for r in other) / n < mean - 0.5


def test_every_place_is_a_target_once(spark):
    """With the rounds of production, and what is learned in them says more than frequency."""
    draw = random.Random(6)
    texts = [chain(draw, 400) for _ in range(150)] + [None, "", "w1"]
    docs = lm.texts(documents(spark, texts)).repartition(3)
    words = lm.vocabulary(docs)
    due = [lm.turns([t.encode()], [len(t.split())], lm.ROUNDS) for t in texts if t]
    assert np.array_equal(np.concatenate(due), lm.turns([t.encode() for t in texts if t], [len(t.split()) for t in texts if t], lm.ROUNDS))
    share = np.bincount(np.concatenate(due), minlength=lm.ROUNDS) / sum(map(len, due))
    assert len(share) == lm.ROUNDS and abs(share - 1 / lm.ROUNDS).max() < 0.02
    net = lm.train(docs, words)
    assert net.learned == np.bincount(np.concatenate(due)).tolist() and sum(net.learned) == sum(len(t.split()) for t in texts if t)
    fresh = [chain(draw, 300) for _ in range(10)]
    counts = Counter(w for t in fresh for w in t.split())
    n = sum(counts.values())
    unigram = sum(c * math.log(c / n) for c in counts.values()) / n
    assert sum(r.log_likelihood for r in lm.score(lm.texts(documents(spark, fresh)), net, words).collect()) / n > unigram + 0.5


def test_other_words_are_told_apart_by_their_counts(spark, monkeypatch):
    """Words the network does not know share their token by their counts, in repeated rows too."""
    monkeypatch.setattr(lm, "most_frequent", lambda counts, size=0, real=lm.most_frequent: real(counts, 2))
    texts = ["a a a a b b b c c c d", "a b c", "a b d", "a b c", None, "a b"]
    ids = [0, 1, 1, 1, None, 2]
    docs = spark.createDataFrame([*zip(ids, texts), (None, "a b d"), (None, "a b c")], "doc_id long, text string")
    got = lm.score_documents(docs).collect()
    # a 10, b 9, c 6, d 3: of nine occurrences of other words six are c.
    assert len(got) == 8 and sum(r.n_tokens == 0 for r in got) == 1
    by = lambda i: sorted(r.log_likelihood for r in got if r.doc_id == i and r.n_tokens == 3)
    d, c, copy = by(1)
    assert c == copy and c - d == pytest.approx(math.log(6 / 3)) and by(None) == pytest.approx([d, c])


def test_gradients(monkeypatch):
    net = lm.Network()
    rng = np.random.default_rng(0)
    near, targets = rng.integers(0, lm.WORDS + 1, (6, len(lm._PLACES))), rng.integers(0, lm.WORDS, 6)
    before = net.log_probs(near, targets).sum()
    for _ in range(30):
        net.learn(near, targets, 0.1)
    assert net.log_probs(near, targets).sum() > before + 10


def test_vocabulary_counts_everything(spark):
    docs = documents(spark, ["a b b c c c", "C d", None]).select("doc_id", "text")
    words = lm.vocabulary(docs, size=2)
    assert words.ids == {b"c": 0, b"b": 1} and words.unknown == 2


def test_no_rows_and_no_words(spark):
    assert lm.score_documents(documents(spark, [])).collect() == []
    row = lm.score_documents(documents(spark, [None])).first()
    assert (row.n_tokens, row.log_likelihood, row.mean_log_prob) == (0, 0.0, None)


def test_a_step_learns_the_same_with_few_calls(monkeypatch):
    rng, net, calls, error = np.random.default_rng(5), lm.Network(), [], lm._error
    monkeypatch.setattr(lm, "_error", lambda logits, at: calls.append(len(at)) or error(logits, at))
    near, targets = rng.integers(0, lm.WORDS + 1, (500, len(lm._PLACES))), rng.integers(0, lm.WORDS, 500)
    before = net.flat.copy()
    net.learn(near, targets, 0.1)
    # Once for the classes, once for the words within all of them.
    assert calls == [500, 500]
    # Against the members' gradient of one class, row by row.
    c = targets[0] // lm.CLASS
    start = lm.Network(before)
    h = start.hidden(start.embed[near].reshape(500, -1))
    want = np.zeros((lm.WIDTH, lm.CLASS))
    for i in np.flatnonzero(targets // lm.CLASS == c):
        e = np.exp(h[i] @ start.members[c] + start.member_bias[c])
        e /= e.sum()
        e[targets[i] % lm.CLASS] -= 1
        want += np.outer(h[i], e) / 500
    moved = 0.1 * want / np.sqrt(1e-6 + want * want)
    assert np.allclose(start.members[c] - net.members[c], moved, atol=1e-4)
