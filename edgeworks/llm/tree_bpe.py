"""Operator 12: byte-level BPE encoding and decoding by segment trees.

The vocabulary file gives the merges; its own tokenizer serves only to find the
pre-tokens of words with characters outside Latin, about whose classes versions
of Unicode differ. Every pre-token is merged by a segment tree over the ranks
of its adjacent pairs (``segment_tree``), those of a batch side by side. A
worker remembers a bounded number of short words and what they became.

Null or empty text: no tokens, an empty text. The string of an added token
inside a text is that token. A stretch without a safe cut is one pre-token,
however long: its tree takes ``n log n`` steps. Repeated rows give repeated
results; ids of documents may have any type and be null. Ids that do not form
UTF-8 decode with replacement characters. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from edgeworks.llm.common import sliced, texts, vocabulary_path
from edgeworks.llm.segment_tree import Merges, merged_many
from edgeworks.llm.text_cuts import led_words, safe_pieces
from edgeworks.llm.token_counts import SAFE, TOKENIZER, _byte_names, tokenizer

#: Words that a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 1 << 20, 48
_STOPS = frozenset(".,;:!?")
#: Bytes of text that are worked on at a time.
BATCH = 4 << 20


class Vocabulary:
    """Symbols, merges and added tokens of a byte-level vocabulary file."""

    def __init__(self, name: str):
        with open(vocabulary_path(name), encoding="utf-8") as file:
            said = json.load(file)
        model, ids = said["model"], said["model"]["vocab"]
        if (said.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or said.get("normalizer") or said["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{name} is not a plain byte-level vocabulary")
        if any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{name} merges in ways that are not known here")
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        named = _byte_names()
        self.name = name
        self.byte_ids = np.array([ids[named[b]] for b in range(256)], np.int32)
        self.merges = Merges([(ids[a], ids[b]) for a, b in pairs], [ids[a + b] for a, b in pairs], max(ids.values()) + 1)
        back = {c: b for b, c in named.items()}
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in ids.items()}
        self.added = {x["content"]: x["id"] for x in said.get("added_tokens", [])}
        self.bytes_of |= {i: x.encode() for x, i in self.added.items()}
        said_as = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.spelled = np.frombuffer(b"".join(said_as), np.uint8)
        self.lengths = np.fromiter(map(len, said_as), np.int64, len(said_as))
        self.starts = np.cumsum(self.lengths) - self.lengths
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None


@lru_cache(maxsize=2)
def vocabulary(name: str = TOKENIZER) -> Vocabulary:
    return Vocabulary(name)


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


def pretokens(word: str, name: str) -> list[str]:
    """The matches of the vocabulary's pattern in a word with the white space that leads it."""
    body = word[1:] if word[0] == " " else word
    if body.isascii():
        if body.isalpha():
            return [word]
        if body[-1:] in _STOPS and body[:-1].isalpha():
            return [word[:-1], body[-1]]
    if SAFE.fullmatch(word):
        return _pattern().findall(word)
    return [word[a:b] for _, (a, b) in tokenizer(name).pre_tokenizer.pre_tokenize_str(word)]


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; remembers words from one batch to the next.

    ``led`` has words that a single space leads, without it, and ``whole`` all others.
    """

    def __init__(self, name: str = TOKENIZER):
        self.vocabulary = vocabulary(name)
        self.led: dict[str, bytes] = {}
        self.whole: dict[str, bytes] = {}

    def encode(self, said: list[str]) -> list[bytes]:
        cut = [self._cut(text) for text in said]
        parts = [x for text in cut for x in text if not isinstance(x, bytes)]
        new_led = self._new(self.led, (x[1] for x in parts))
        new_whole = self._new(self.whole, (x[0] for x in parts), (x[2] for x in parts))
        found = self._words([f" {x}" for x in new_led] + new_whole)
        led, whole = self.led, self.whole
        led.update(zip(new_led, found))
        whole.update(zip(new_whole, found[len(new_led):]))
        out = [b"".join(chain.from_iterable((x,) if isinstance(x, bytes) else chain(
            map(whole.__getitem__, x[0]), map(led.__getitem__, x[1]), map(whole.__getitem__, x[2])) for x in text)) for text in cut]
        for kept, new in ((led, new_led), (whole, new_whole)):
            for word in new:
                # Frequent words come early, so those that are in stay.
                if len(word) > LONGEST or len(kept) > REMEMBERED:
                    del kept[word]
        return out

    def _cut(self, text: str) -> list:
        """A text in order: the id of an added token as bytes, or words as (whole, led, whole)."""
        special = self.vocabulary.special
        kept = special.split(text) if special and special.search(text) else [text]
        out: list = []
        for k, segment in enumerate(kept):
            if k % 2:
                out.append(np.array(self.vocabulary.added[segment], "<u4").tobytes())
                continue
            for piece in safe_pieces(segment):
                head, led, odd = led_words(piece)
                out.append(([head] if head else [], led, odd))
        return out

    @staticmethod
    def _new(known: dict[str, bytes], *words: Iterable[list[str]]) -> list[str]:
        return list(set(chain.from_iterable(chain(*words))).difference(known))

    def _words(self, words: list[str]) -> list[bytes]:
        """Each word's ids: those of its pre-tokens, which are merged all together."""
        v = self.vocabulary
        cut = [pretokens(x, v.name) if x else [] for x in words]
        distinct = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(distinct, merged_many([x.encode() for x in distinct], v.byte_ids, v.merges), strict=True))
        return [ids[x[0]] if len(x) == 1 else b"".join(map(ids.__getitem__, x)) for x in cut]

    def decode(self, said: list[bytes]) -> list[str]:
        """The texts that ids stand for."""
        v, ids = self.vocabulary, np.frombuffer(b"".join(said), "<u4")
        lengths = v.lengths[ids]
        ends = np.append(0, np.cumsum(lengths))
        raw = v.spelled[np.arange(ends[-1]) + np.repeat(v.starts[ids] - ends[:-1], lengths)].tobytes()
        cuts = ends[np.append(0, np.cumsum([len(x) // 4 for x in said], dtype=np.int64))].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def encoder(name: str = TOKENIZER) -> Encoder:
    """This worker's encoder, kept from one task to the next."""
    return Encoder(name)


def _per_slice(rows: DataFrame, fn, schema: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, size):
            yield fn(batch)

    return rows.mapInArrow(run, schema.format(rows.schema["doc_id"].dataType.simpleString()))


def encode_documents(docs: DataFrame, name: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in encoder(name).encode(batch["text"].to_pylist())]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _per_slice(texts(docs, id_col, text_col), run, "doc_id {}, ids array<int>", BATCH)


def decode_documents(encoded: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``; null ids are none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        back = encoder(name).decode([np.array(x or [], "<u4").tobytes() for x in batch["ids"].to_pylist()])
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(back, pa.string())], ["doc_id", "text"])

    return _per_slice(encoded.select("doc_id", "ids"), run, "doc_id {}, text string", BATCH)


def round_trip(docs: DataFrame, name: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded, and its ids decoded again."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(name)
        ids = coder.encode(batch["text"].to_pylist())
        return pa.RecordBatch.from_arrays([
            batch["doc_id"],
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in coder.decode(ids)], pa.string()),
        ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _per_slice(texts(docs, id_col, text_col), run, schema, BATCH)
