"""Operator 6: language identification by sparse multinomial logistic regression.

Features are the character n-grams (1 to ``LONGEST_GRAM``) of the lower-cased
text, hashed into ``BINS`` and weighted by TF-IDF; document frequencies are
counted over all training documents. Weights are learned by
follow-the-regularised-leader with elastic-net penalties, so most are exactly
zero. A part of the sample that is not trained on sets a temperature, by which
the scores become probabilities.

Learned from: documents with a language and a text whose crc32(doc_id as text)
mod 3 is not 1, and of these at most about ``PER_LANGUAGE`` of each language,
picked by a hash (the documented bound of the sample that is gathered). Every
whole text is predicted, from the text alone.

Null text, or one without a letter: ``und`` with score 0. With nothing to learn
from every text is ``und``. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.llm.common import sliced

BINS, LONGEST_GRAM = 1 << 16, 3
PER_LANGUAGE = 1000
UNKNOWN = "und"
#: The penalties and learning rate of the leader.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
EPOCHS = 3
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_LETTER = regex.compile(r"\p{L}")
#: Code points of a text that are turned to n-grams together.
_STEP = 1 << 18


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text's n-grams and how often each occurs."""
    total = np.zeros(BINS, np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(points), _STEP):
        part = points[at:at + _STEP + LONGEST_GRAM - 1]
        rolled = np.zeros(len(part), np.uint32)
        for n in range(1, LONGEST_GRAM + 1):
            grams = len(part) - n + 1
            if grams < 1:
                break
            rolled = (rolled[:grams] ^ part[n - 1:]) * _ODD[n - 1]
            rolled ^= rolled >> np.uint32(15)
            # The next step has the grams that begin beyond this one.
            total += np.bincount((rolled[:_STEP] + np.uint32(n)) >> np.uint32(16), minlength=BINS)
    found = np.flatnonzero(total)
    return found, total[found]


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vector of TF-IDF weights, frequencies by their logarithm."""
    x = (1.0 + np.log(counts)) * idf[found]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


class Leader:
    """Follow the regularised leader, proximally, for a softmax over the languages."""

    def __init__(self, languages: int):
        self.z, self.n = np.zeros((BINS + 1, languages)), np.zeros((BINS + 1, languages))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, language: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[language] -= 1.0
        g = np.outer(x, p)
        moved = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - moved * w
        self.n[at] += g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        found, counts = gram_counts(text)
        p = softmax((weighted(found, counts, self.idf) @ self.weights[found] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least loss on examples that were not trained on."""
    if not len(truth):
        return 1.0

    def loss(t: float) -> float:
        x = logits / t
        top = x.max(1, keepdims=True)
        return float((np.log(np.exp(x - top).sum(1)) + top[:, 0] - x[np.arange(len(truth)), truth]).mean())

    return min(np.geomspace(0.25, 25.0, 120), key=loss)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each bin occurs, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BINS + 1, np.int64)
        for batch in sliced(batches):
            for text in batch["text"].to_pylist():
                seen[gram_counts(text)[0]] += 1
                seen[BINS] += 1
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(seen[found], pa.int64())], ["bin", "n"])

    rows = train.select("text").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BINS + 1, np.int64)
    out[rows["bin"].to_numpy()] = rows["n"].to_numpy()
    return out[:BINS], int(out[BINS])


def _sample(train: DataFrame, counts: dict[str, int], per_language: int) -> pa.Table:
    """``(lang, bins, counts)`` of about ``per_language`` documents of each language."""
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))))
    drawn = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = train.filter(drawn < share[F.col("lang")]).limit(2 * per_language * len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [gram_counts(x) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], pa.array([x[0].astype(np.int32) for x in found], pa.list_(pa.int32())), pa.array([x[1].astype(np.int32) for x in found], pa.list_(pa.int32()))],
                ["lang", "bins", "counts"])

    return picked.select("lang", "text").mapInArrow(run, "lang string, bins array<int>, counts array<int>").toArrow()


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, epochs: int = EPOCHS) -> Model:
    """Learn from ``(doc_id, text, lang)``, leaving out what is held out."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    counts = {x.lang: x.n for x in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros(BINS), np.zeros((BINS + 1, 0)), 1.0)
    seen, total = _document_frequencies(rows)
    idf = np.log((1.0 + total) / (1.0 + seen)) + 1.0
    sample = _sample(rows, counts, per_language)
    truth = np.array([languages.index(x) for x in sample["lang"].to_pylist()], np.int64)
    bins, often = sample["bins"], sample["counts"]

    def example(i: int) -> tuple[np.ndarray, np.ndarray]:
        found = bins[i].values.to_numpy().astype(np.int64)
        # The last weight is the bias.
        return np.append(found, BINS), np.append(weighted(found, often[i].values.to_numpy(), idf), 1.0)

    order = np.random.default_rng(7).permutation(len(truth))
    aside, learned = order[:len(order) // 5], order[len(order) // 5:]
    leader = Leader(len(languages))
    for _ in range(epochs):
        for i in learned.tolist():
            leader.learn(*example(i), truth[i])
    w = leader.weights(slice(None))
    logits = np.array([x @ w[at] for at, x in map(example, aside.tolist())]).reshape(-1, len(languages))
    return Model(languages, idf, w.astype(np.float32), float(fit_temperature(logits, truth[aside])))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; all other columns are kept, ``doc_id`` and ``text`` are needed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    kept = [c for c in names if c not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [shared.value.predict(x) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*kept, "lang_pred", "score"])

    schema = rows.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every document."""
    model = train(docs.select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
