import hashlib

import pytest
from fixtures_llm import documents, prose

from edgeworks.llm import bpe, text_cuts, token_counts

ODD = [
    None, "", " ", "  ", "a", "don't!'s I'LL 12a", "a  b \n c  d ", " <|endoftext|> x<|endoftext|>", "\n\n x\n", "\x1c \x85 b",
    "x　 y ", "naïve café — 日本語 ք̈ 😀👍🏽", "ՠx ࢏1 z", "end ", "a\tb \t c", "<|endoftext|>", "İstanbul ǅ", "no break   em",
]
LONG = ["a" * 200_000 + "   ", " " * 150_000 + "x y", "ab1!" * 40_000, ("word " * 30_000) + "\n" * 70_000 + "end", "é" * 70_000 + "1" * 70_000]


@pytest.fixture(scope="module")
def texts():
    import random

    draw = random.Random(3)
    return ODD + LONG + [prose(draw, 300), prose(draw, 300)] + ["same text"] * 3


def test_counts_are_the_librarys(spark, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(token_counts.vocabulary_path(token_counts.TOKENIZER))
    rows = {r.doc_id: r for r in token_counts.count_tokens(documents(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        n = len(coder.encode(text or "", add_special_tokens=False).ids)
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((text or "").encode()), n, n > 512), (i, (text or "")[:30])


def test_safe_characters_are_split_alike():
    """Where pre-tokens are split here and not by the tokenizer, both must split alike."""
    coder, pattern = token_counts.tokenizer(), token_counts._pattern()
    safe = [chr(c) for c in range(0x250) if token_counts.SAFE.fullmatch(chr(c))]
    for c in safe:
        text = f"a{c}1{c}.{c} {c}"
        assert [text[a:b] for _, (a, b) in coder.pre_tokenizer.pre_tokenize_str(text)] == pattern.findall(text), repr(c)
    assert not token_counts.SAFE.fullmatch("՘")


def test_the_broadcast_tier_is_bounded(spark, texts, monkeypatch):
    rows = token_counts.texts(documents(spark, texts * 3))
    found = token_counts.frequent_pretokens(rows)
    assert 0 < len(found) <= token_counts.FREQUENT and max(map(len, found)) <= token_counts.LONGEST


def test_ids_are_the_librarys_and_decode_to_the_text(spark, texts):
    coder = bpe.encoding()
    docs = documents(spark, texts)
    found = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    whole = {r.doc_id: r for r in bpe.tokenized(docs).collect()}
    ids = bpe.encode_documents(docs)
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode_documents(ids).collect()}
    for i, text in enumerate(texts):
        want = coder.encode_ordinary(text or "")
        assert found[i].n_tokens == len(want)
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert found[i].decoded_sha256 == whole[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert whole[i].ids == want and back[i] == (text or "").encode()


def test_white_space_beyond_the_pattern_of_the_library():
    text = " " * 2_500_000 + "x"
    assert bpe.decode(bpe.encode(text)) == text.encode()


def test_pieces_are_the_text():
    for text in LONG + ODD[1:]:
        assert "".join(text_cuts.safe_pieces(text, 100)) == text


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert token_counts.count_tokens(docs).collect() == []
    assert bpe.round_trip(docs).collect() == [] and bpe.tokenized(docs).collect() == []
