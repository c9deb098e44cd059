"""Operator 1: token counts by a two-tier lookup of pre-token lengths.

A pre-token here is a word with the white space that leads it: no match of the
vocabulary's own pattern crosses from a character to white space after it, so
the tokens of a text are those of its pre-tokens.

A first pass finds frequent pre-tokens: each task counts its own in a table of
bounded size (when full, the rarer half goes), and only the ``PER_TASK`` most
frequent of a task leave it, so pre-tokens themselves are never shuffled. The
``FREQUENT`` best of all tasks, with the number of tokens each stands for,
become a compact table that is broadcast: at most ``FREQUENT`` strings of at
most ``LONGEST`` characters. The second pass looks every pre-token up there; a
miss goes to a cache in the worker and from there to the tokenizer. Which
pre-tokens are in which tier changes the time, never a count.

Strings of added special tokens inside a text count as one token each, as the
tokenizer's default has it.

Null or empty text: no bytes, no tokens. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.llm.common import sliced, texts, vocabulary_path
from edgeworks.llm.text_cuts import led_words, safe_pieces

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
#: Bounds: entries of the broadcast table, of what a task offers, of what a task counts, of a worker's cache.
FREQUENT, PER_TASK, COUNTED, CACHED = 1 << 16, 1 << 13, 1 << 17, 1 << 20
#: Latin characters, on whose classes all versions of Unicode in use agree. Words with others go to
#: the tokenizer whole, which splits by the tables of its own version.
SAFE = regex.compile(r"[\x00-\xff\u0100-\u024f]*")
#: Longer pre-tokens are neither counted nor cached.
LONGEST = 32

@lru_cache(maxsize=4)
def tokenizer(name: str = TOKENIZER):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary_path(name))
    found.no_padding()
    found.no_truncation()
    return found


@lru_cache(maxsize=4)
def _special(name: str):
    """Splits a text at the strings of added tokens, keeping them; None when there are none."""
    added = [x.content for x in tokenizer(name).get_added_tokens_decoder().values()]
    return regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None


@lru_cache(maxsize=4)
def _merger(name: str):
    """The tokenizer's merges alone, for one of its own pre-tokens."""
    return tokenizer(name).model.tokenize


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


def _byte_names() -> dict[int, str]:
    """Byte-level vocabularies name a byte by itself where Latin-1 prints it, and else by the next character from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


_NAMES = _byte_names()


def _length(text: str, name: str) -> int:
    """Tokens of a text without special strings."""
    if not SAFE.fullmatch(text):
        return len(tokenizer(name).encode(text, add_special_tokens=False).ids)
    merge, total = _merger(name), 0
    for x in _pattern().findall(text):
        total += len(merge(x.encode().decode("latin-1").translate(_NAMES)))
    return total


def _led_lengths(words: list[str], name: str) -> list[int]:
    """Tokens of each word with a space before it; a word of ASCII letters is one pre-token of the library's as well."""
    merge, space = _merger(name), _NAMES[32]
    return [len(merge(space + x)) if x.isascii() and x.isalpha() else _length(" " + x, name) for x in words]


def _segments(text: str, name: str) -> tuple[list[str], int]:
    """The ordinary stretches of a text, and how many special strings lie between them."""
    special = _special(name)
    if special is None or not special.search(text):
        return [text], 0
    kept = special.split(text)
    return kept, len(kept) - 1


@lru_cache(maxsize=4)
def _cache(name: str) -> dict[str, int]:
    """This worker's lengths, kept from one task to the next."""
    return {}


class Lengths:
    """Tokens of a text: broadcast table, then this worker's cache, then the tokenizer.

    Both tables have the words that a single space leads, without it.
    """

    def __init__(self, frequent: dict[str, int], name: str):
        self.frequent, self.name, self.cache = frequent, name, _cache(name)

    def count(self, text: str) -> int:
        kept, total = _segments(text, self.name)
        for segment in kept:
            for piece in safe_pieces(segment):
                head, led, odd = led_words(piece)
                whole = [head, *odd] if head else odd
                total += sum(_length(x, self.name) for x in whole)
                total += self._led(led)
        return total

    def _led(self, words: list[str]) -> int:
        sizes = list(map(self.frequent.get, words))
        if None not in sizes:
            return sum(sizes)
        cache = self.cache
        missed = Counter(x for x, n in zip(words, sizes, strict=True) if n is None)
        new = [x for x in missed if x not in cache]
        known = dict(zip(new, _led_lengths(new, self.name), strict=True)) if new else {}
        total = sum(filter(None, sizes)) + sum(k * (known.get(x) or cache[x]) for x, k in missed.items())
        if len(cache) + len(known) > CACHED:
            cache.clear()
        cache.update((x, n) for x, n in known.items() if len(x) <= LONGEST)
        return total


def frequent_pretokens(rows: DataFrame, name: str = TOKENIZER) -> dict[str, int]:
    """The broadcast tier: frequent pre-tokens of all texts and their numbers of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in sliced(batches):
            for text in batch["text"].to_pylist():
                for segment in _segments(text, name)[0]:
                    for piece in safe_pieces(segment):
                        seen.update(led_words(piece)[1])
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 2)))
        best = [(x, n) for x, n in seen.most_common(PER_TASK) if len(x) <= LONGEST]
        words, counts = pa.array([x for x, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())
        yield pa.RecordBatch.from_arrays([words, counts], ["pretoken", "n"])

    offered = rows.select("text").mapInArrow(run, "pretoken string, n long")
    best = offered.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(FREQUENT)
    words = [x.pretoken for x in best.select("pretoken").collect()]
    return dict(zip(words, _led_lengths(words, name), strict=True)) if words else {}


def count_tokens(
    docs: DataFrame, name: str = TOKENIZER, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every whole text."""
    rows = texts(docs, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(frequent_pretokens(rows, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(shared.value, name)
        for batch in sliced(batches):
            said = batch["text"].to_pylist()
            n_bytes = pa.array([len(x.encode()) for x in said], pa.int64())
            n_tokens = pa.array([lengths.count(x) for x in said], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
