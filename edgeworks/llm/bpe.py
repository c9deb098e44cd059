"""Operator 10: byte-level BPE encoding and decoding with tiktoken.

The rank file is read once by each Python worker. Long texts are cut at places
that no pre-token crosses, so memory and the regular expression's stack stay
bounded; a stretch of white space that is too long for the expression is
merged directly, being one pre-token. Ids are decoded to bytes, not to text,
since a prefix of ids may end inside a character.

Null or empty text: no tokens, no bytes. A text in special-token notation is
ordinary text. Repeated rows give repeated results. A null id stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from edgeworks.llm.common import per_batch, texts, vocabulary_path
from edgeworks.llm.text_cuts import PIECE, is_space, safe_pieces

RANKS = "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def encoding(ranks: str = RANKS):
    """The tiktoken encoding of a rank file: one token in base64 and its rank a line."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(ranks), "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


@lru_cache(maxsize=4)
def _decimals(ranks: str) -> list[str]:
    return [str(i) for i in range(encoding(ranks).n_vocab)]


def encode_pieces(text: str, ranks: str = RANKS) -> Iterator[list[int]]:
    """Token ids of a text, piece by piece."""
    coder = encoding(ranks)
    for piece in safe_pieces(text):
        if len(piece) > PIECE and is_space(piece):
            yield coder._encode_single_piece(piece)
        elif piece:
            yield coder.encode_ordinary(piece)


def encode(text: str, ranks: str = RANKS) -> list[int]:
    return [i for ids in encode_pieces(text, ranks) for i in ids]


def decode(ids: list[int], ranks: str = RANKS) -> bytes:
    return encoding(ranks).decode_bytes(ids)


def encode_documents(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` of every text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = pa.array([encode(x, ranks) for x in batch["text"].to_pylist()], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    rows = texts(docs, id_col, text_col)
    return per_batch(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``(doc_id, bytes binary)`` of ``(doc_id, ids)``; null ids give no bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = pa.array([decode(x or [], ranks) for x in batch["ids"].to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([batch["doc_id"], raw], ["doc_id", "bytes"])

    rows = encoded.select("doc_id", "ids")
    return per_batch(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary")


DIGESTS = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digest(text: str, ranks: str = RANKS) -> tuple[int, str, str]:
    """Number of tokens, digest of the ids in decimal, digest of the decoded bytes."""
    coder, said_as, count = encoding(ranks), _decimals(ranks), 0
    ids_hash, raw_hash = hashlib.sha256(), hashlib.sha256()
    for ids in encode_pieces(text, ranks):
        said = ",".join(map(said_as.__getitem__, ids))
        ids_hash.update((f",{said}" if count and ids else said).encode())
        raw_hash.update(coder.decode_bytes(ids))
        count += len(ids)
    return count, ids_hash.hexdigest(), raw_hash.hexdigest()


def round_trip(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass, keeping counts and digests.

    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``; the ids themselves are
    what ``encode_documents`` returns.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [digest(x, ranks) for x in batch["text"].to_pylist()]
        counts, ids, raw = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids), pa.array(raw)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = texts(docs, id_col, text_col)
    return per_batch(rows, run, DIGESTS.format(rows.schema["doc_id"].dataType.simpleString()))


def tokenized(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)`` of every text, decoded again as a proof."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [encode(x, ranks) for x in batch["text"].to_pylist()]
        raw = [hashlib.sha256(decode(x, ranks)).hexdigest() for x in ids]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(list(map(len, ids)), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(raw, pa.string())],
            ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    rows = texts(docs, id_col, text_col)
    return per_batch(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>, decoded_sha256 string")
