"""Operator 2: documents scored by masked pseudo-likelihood.

A network sees the ``SIDE`` words before a place and the ``SIDE`` after it and
predicts the word between. A document's score is the sum of the logarithms of
the probabilities of all its words, each given its neighbours on both sides.

- Words are what lies between ASCII white space, A-Z in lower case. The
  ``WORDS - 1`` most frequent of the corpus (counted over all documents) are
  known to the network; to it all others are one token. That token's probability
  is shared among its words by how often each occurs in the corpus: their counts
  are a written table that grows with the corpus, joined by word. As neighbours
  these words are still alike.
- The network: embeddings, one matrix for each neighbour's place, tanh, and a
  softmax in two steps, over 64 classes of words and within the class.
- Training is distributed: the places of all documents are dealt out to the
  ``ROUNDS`` rounds by a hash of document and place, so that each is a target in
  exactly one. In a round every task starts from the shared weights, goes over
  all its documents (the places that are due are masked and predicted), and the
  tasks' weights are averaged by the number of places, in two steps so that no group holds more than about the square root
  of the number of tasks. What is learned from grows with the corpus; the model
  does not.

Null or empty text: no words, a sum of 0 and no mean. Repeated rows give
repeated results. An empty table: no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.llm.common import per_batch, sliced, texts
from edgeworks.loop import Workspace

WORDS, CLASS, WIDTH, SIDE = 4096, 64, 32, 2
ROUNDS, RATE, BATCH = 2, 0.15, 2048
COUNTED = 1 << 19
OTHER = WORDS - 1
#: The id that stands for what is beyond the ends of a document.
BEYOND = WORDS
BLOCK = 1 << 14
#: Places scored together; their arrays fit a core's cache.
CHUNK = 1 << 12
_PLACES = [p for p in range(-SIDE, SIDE + 1) if p]


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


class Vocabulary:
    def __init__(self, words: list[bytes], unknown: int):
        self.ids = {w: i for i, w in enumerate(words)}
        #: How many different words the token of other words stands for.
        self.unknown = max(1, unknown)

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.get, words, repeat(OTHER)), np.int64, len(words))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        seen: Counter[bytes] = Counter()
        for batch in sliced(batches):
            for text in batch["text"].to_pylist():
                seen.update(split(text))
                if len(seen) > COUNTED:
                    yield made(seen)
                    seen = Counter()
        yield made(seen)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, size: int = WORDS - 1) -> Vocabulary:
    """The most frequent words of all documents; ties in the order of the words."""
    return most_frequent(word_counts(docs), size)


def most_frequent(counts: DataFrame, size: int = WORDS - 1) -> Vocabulary:
    best = counts.orderBy(F.desc("n"), "word").limit(size).toArrow()["word"].to_pylist()
    distinct = counts.agg(F.count(F.lit(1))).first()[0] if len(best) == size else len(best)
    return Vocabulary(best, distinct - len(best))


class Network:
    """The weights, by name, and what is computed from them."""

    SHAPES = {
        "embed": (WORDS + 1, WIDTH), "mix": (len(_PLACES), WIDTH, WIDTH), "bias": (WIDTH,),
        "classes": (WIDTH, WORDS // CLASS), "class_bias": (WORDS // CLASS,),
        "members": (WORDS // CLASS, WIDTH, CLASS), "member_bias": (WORDS // CLASS, CLASS),
    }

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            draw = np.random.default_rng(3)
            flat = np.concatenate([(draw.standard_normal(int(np.prod(s))) * (0.3 if len(s) > 1 else 0.0)).astype(np.float32) if k not in ("classes", "members", "member_bias") else np.zeros(int(np.prod(s)), np.float32) for k, s in self.SHAPES.items()])
        self.flat = flat.astype(np.float32)
        self._view(self.flat)
        #: A gradient and what it is computed from, made when first needed.
        self.grad: Network | None = None
        self.room: np.ndarray | None = None
        self.sums = np.full_like(self.flat, 1e-6)
        #: How many places were targets, by round.
        self.learned: list[int] = []

    def _view(self, flat: np.ndarray) -> None:
        at = 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at:at + size].reshape(shape))
            at += size

    def hidden(self, seen: np.ndarray) -> np.ndarray:
        """From the embeddings of the words around each place, side by side."""
        x = seen @ self.mix.reshape(-1, WIDTH) + self.bias
        return np.tanh(x, out=x)

    def within(self, h: np.ndarray, classes: list[tuple[int, int, int]], group: np.ndarray) -> np.ndarray:
        """What the softmax within the class is made of, for places in the order of their classes."""
        q = np.empty((len(h), CLASS), np.float32)
        for c, a, b in classes:
            np.matmul(h[a:b], self.members[c], out=q[a:b])
        q += self.member_bias[group]
        return q

    def log_probs(self, around: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each target given the words around it."""
        h = self.hidden(self.embed[around].reshape(len(around), -1))
        group = targets // CLASS
        out = _picked(h @ self.classes + self.class_bias, group)
        order, classes = _by(group)
        out[order] += _picked(self.within(h[order], classes, group[order]), targets[order] % CLASS)
        return out

    def learn(self, around: np.ndarray, targets: np.ndarray, rate: float) -> None:
        """One step of gradient descent, scaled by what each weight has moved (Adagrad)."""
        if self.grad is None:
            self.grad, self.room = Network.__new__(Network), np.empty_like(self.flat)
            self.grad.flat = np.empty_like(self.flat)
            self.grad._view(self.grad.flat)
        g, grad, n, group = self.grad, self.grad.flat, len(targets), targets // CLASS
        grad.fill(0)
        seen = self.embed[around].reshape(n, -1)
        h = self.hidden(seen)
        p = _error(h @ self.classes + self.class_bias, group)
        p /= n
        g.classes += h.T @ p
        g.class_bias += p.sum(0)
        back = p @ self.classes.T
        order, classes = _by(group)
        inner, below = h[order], np.empty_like(h)
        q = _error(self.within(inner, classes, group[order]), targets[order] % CLASS)
        q /= n
        for c, a, b in classes:
            np.matmul(inner[a:b].T, q[a:b], out=g.members[c])
            np.add.reduce(q[a:b], axis=0, out=g.member_bias[c])
            np.matmul(q[a:b], self.members[c].T, out=below[a:b])
        back[order] += below
        back *= 1 - h * h
        g.bias += back.sum(0)
        for j in range(len(_PLACES)):
            np.matmul(seen[:, j * WIDTH:(j + 1) * WIDTH].T, back, out=g.mix[j])
            moved = back @ self.mix[j].T
            # Numbers of 16 bits are sorted by counting.
            ids = around[:, j].astype(np.uint16)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            first = np.append(0, np.flatnonzero(ids[1:] != ids[:-1]) + 1)
            g.embed[ids[first]] += np.add.reduceat(moved[order], first)
        np.multiply(grad, grad, out=self.room)
        self.sums += self.room
        np.sqrt(self.sums, out=self.room)
        grad *= rate
        grad /= self.room
        self.flat -= grad


def _by(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by class, and in it each class with where it begins and ends."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    of = group[order]
    first = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1) if len(of) else np.zeros(0, np.int64)
    return order, list(zip(of[first].tolist(), first.tolist(), np.append(first[1:], len(of)).tolist(), strict=True)) if len(of) else []


def _picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = logits[np.arange(len(at)), at]
    top = logits.max(1)
    logits -= top[:, None]
    np.exp(logits, out=logits)
    return found - top - np.log(logits.sum(1))


def _error(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    e = logits
    e -= e.max(1, keepdims=True)
    np.exp(e, out=e)
    e /= e.sum(1, keepdims=True)
    e[np.arange(len(at)), at] -= 1
    return e


def laid(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Some documents in one row, with gaps between, and where their words lie in it."""
    gap = np.full(SIDE, BEYOND, np.int64)
    row = np.concatenate([gap, *(x for doc in ids for x in (doc, gap))])
    return row, np.flatnonzero(row != BEYOND)


def near(row: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The words around some places of a row."""
    return row[where[:, None] + np.array(_PLACES)]


def around(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words of some documents, and the words around each."""
    row, where = laid(ids)
    return row[where], near(row, where)


def turns(docs: list[bytes], sizes: list[int], rounds: int) -> np.ndarray:
    """The round in which each place of some documents, of so many words, is a target."""
    n = np.array(sizes, np.int64)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.repeat(np.array([zlib.crc32(x) for x in docs], np.uint64), n) << np.uint64(32) | place.astype(np.uint64)
    for shift in (33, 29):
        key = (key ^ (key >> np.uint64(shift))) * np.uint64(0x9E3779B97F4A7C15)
    return ((key >> np.uint64(32)) % np.uint64(rounds)).astype(np.int64)


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> Network:
    """Average of what the tasks have learned, ``rounds`` times over; every place is a target once."""
    context = docs.sparkSession.sparkContext
    net, known = Network(), context.broadcast(words)
    rows = docs.select("text")
    parts = max(16, math.isqrt(rows.rdd.getNumPartitions()))
    size = len(net.flat)
    for turn in range(rounds):
        start = context.broadcast(net.flat)

        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            own, seen = Network(start.value.copy()), 0
            task = TaskContext.get().partitionId()
            draw = np.random.default_rng([turn, task])
            for batch in sliced(batches, 1 << 20):
                said = batch["text"].to_pylist()
                docs = [known.value.encode(split(x)) for x in said]
                row, where = laid(docs)
                due = turns([x.encode() for x in said], list(map(len, docs)), rounds)
                masked = where[draw.permutation(np.flatnonzero(due == turn))]
                for at in range(0, len(masked), BATCH):
                    pick = masked[at:at + BATCH]
                    own.learn(near(row, pick), row[pick], rate / (1 + turn))
                seen += len(masked)
            if seen:
                blocks = range(0, size, BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b // BLOCK for b in blocks], pa.int32()), pa.array([task % parts] * len(blocks), pa.int32()), pa.array([float(seen)] * len(blocks)),
                     pa.array([(own.flat[b:b + BLOCK].astype(np.float64) * seen).tobytes() for b in blocks], pa.binary())], ["block", "part", "n", "sums"])

        learned = rows.mapInArrow(run, "block int, part int, n double, sums binary")
        inner = learned.groupBy("block", "part").applyInArrow(_added, "block int, part int, n double, sums binary")
        outer = inner.withColumn("part", F.lit(0)).groupBy("block").applyInArrow(_added, "block int, part int, n double, sums binary")
        flat, n = net.flat.copy(), 0
        for x in outer.toArrow().to_pylist():
            flat[x["block"] * BLOCK:(x["block"] + 1) * BLOCK] = np.frombuffer(x["sums"]) / x["n"]
            n = int(x["n"])
        net, learned = Network(flat), [*net.learned, n]
        net.learned = learned
    return net


def _added(group: pa.Table) -> pa.Table:
    sums = sum(np.frombuffer(x.as_buffer()) for x in group["sums"])
    total = sum(group["n"].to_pylist())
    return pa.table({"block": group["block"][:1], "part": group["part"][:1], "n": pa.array([total], pa.float64()), "sums": pa.array([sums.tobytes()], pa.binary())})


def score(docs: DataFrame, net: Network, words: Vocabulary, counts: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood)`` of ``(doc_id, text)``.

    With ``counts``, a table ``(word, n)`` of the words of these documents, the
    token of other words is shared by their counts; else evenly.
    """
    context = docs.sparkSession.sparkContext
    flat, known = context.broadcast(net.flat), context.broadcast(words)
    even = counts is None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, share = Network(flat.value), math.log(known.value.unknown) if even else 0.0
        ids = [known.value.encode(split(x)) for x in batch["text"].to_pylist()]
        row, where = laid(ids)
        targets, said = row[where], np.zeros(len(where))
        for at in range(0, len(targets), CHUNK):
            said[at:at + CHUNK] = model.log_probs(near(row, where[at:at + CHUNK]), targets[at:at + CHUNK])
        said[targets == OTHER] -= share
        n = np.array(list(map(len, ids)), np.int64)
        # Summed document by document, so that the words of others in the batch change nothing.
        ends = np.cumsum(n)
        total = [float(said[e - k:e].sum()) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
        others = pa.array([int((x == OTHER).sum()) for x in ids], pa.int64())
        kept = [] if even else [batch["of_text"], others]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n), pa.array(total, pa.float64()), *kept], ["doc_id", "n_tokens", "log_likelihood", *([] if even else ["of_text", "others"])])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, log_likelihood double"
    if even:
        return per_batch(docs, run, schema)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("of_text"))
    done = per_batch(keyed, run, f"{schema}, of_text long, others long")
    means = _mean_log_shares(keyed, words, counts).select(F.col("doc_id").alias("of_doc"), F.col("of_text").alias("same"), "mean")
    joined = done.join(means, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("of_text") == F.col("same")), "left")
    shared = F.when(F.col("others") > 0, F.col("log_likelihood") + F.col("others") * F.col("mean")).otherwise(F.col("log_likelihood"))
    return joined.select("doc_id", "n_tokens", shared.alias("log_likelihood"))


def _mean_log_shares(keyed: DataFrame, words: Vocabulary, counts: DataFrame) -> DataFrame:
    """``(doc_id, of_text, mean)``: of each document's words that the network does not know.

    ``mean`` is that of the logarithms of their shares in all such occurrences;
    as a mean it is the same however often a row is repeated.
    """
    known = keyed.sparkSession.sparkContext.broadcast(words)
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, rows, said, n = known.value.ids, [], [], []
        for i, text in enumerate(batch["text"].to_pylist()):
            seen = Counter(w for w in split(text) if w not in ids)
            rows += [i] * len(seen)
            said += seen.keys()
            n += seen.values()
        at = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays([batch["doc_id"].take(at), batch["of_text"].take(at), pa.array(said, pa.binary()), pa.array(n, pa.int64())], ["doc_id", "of_text", "word", "k"])

    each = per_batch(keyed, run, f"doc_id {kind}, of_text long, word binary, k long")
    best = keyed.sparkSession.createDataFrame(pa.table({"word": pa.array(list(words.ids), pa.binary())}))
    rare = counts.join(F.broadcast(best), "word", "left_anti")
    total = rare.agg(F.sum("n")).first()[0] or 1
    met = each.join(rare, "word").groupBy("doc_id", "of_text").agg(F.sum(F.col("k") * F.log("n")).alias("sum"), F.sum("k").alias("k"))
    return met.select("doc_id", "of_text", (F.col("sum") / F.col("k") - math.log(total)).alias("mean"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from all documents, then score each: sum, mean, and pseudo-perplexity."""
    rows = texts(docs, id_col, text_col)
    counts, _ = Workspace(docs.sparkSession).keep(word_counts(rows), "words")
    words = most_frequent(counts)
    net = train(rows, words)
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return score(rows, net, words, counts).select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_prob"), F.exp(-mean).alias("pseudo_perplexity"))
