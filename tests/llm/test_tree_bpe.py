import hashlib

import numpy as np
import pytest
from fixtures_llm import documents, prose
from test_tokens import LONG, ODD

from edgeworks.llm import segment_tree, tree_bpe
from edgeworks.llm.token_counts import tokenizer


def plainly(ids, merges):
    """Merge the leftmost pair of lowest rank again and again."""
    ids = list(ids)
    while True:
        found = [(merges.of[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges.of]
        if not found:
            return ids
        _, i = min(found)
        ids[i:i + 2] = [merges.of[ids[i], ids[i + 1]][1]]


def test_trees_merge_as_a_plain_search_does(draw):
    v = tree_bpe.vocabulary()
    made_up = segment_tree.Merges([(0, 0), (1, 0), (3, 3), (4, 0), (0, 1), (5, 3), (1, 1)], [3, 4, 5, 6, 7, 8, 9], 10)
    for merges, symbols, byte_ids in ((v.merges, b"etaoin sh\xc3\xa9", v.byte_ids), (made_up, b"\0\1\2", np.arange(256, dtype=np.int32))):
        said = [bytes(draw.choice(symbols) for _ in range(draw.randrange(90))) for _ in range(400)] + [b"", b"a"[:0], symbols[:1] * 64, symbols[:1] * 65]
        said = [x for x in said if max(byte_ids[list(x)], default=0) < merges.symbols]
        got = segment_tree.merged_many(said, byte_ids, merges)
        for x, found in zip(said, got, strict=True):
            want = plainly(byte_ids[list(x)].tolist(), merges)
            assert np.frombuffer(found, "<u4").tolist() == want == segment_tree.merged(byte_ids[list(x)].tolist(), merges)


def test_ids_are_the_librarys_and_decode_to_its_text(spark, draw):
    coder = tokenizer()
    mixed = ["".join(draw.choice("ab'ste 12.,!\n\t éő中क\U0001f600‍|<>") for _ in range(200)) for _ in range(60)]
    texts = ODD + LONG + mixed + [prose(draw, 300)] * 3 + ["<|endoftext|><|endoftext|>", "a<|endoftext|> b", "<|endoftext", "x   y", "ab\x00c"]
    docs = documents(spark, texts)
    found = {r.doc_id: r for r in tree_bpe.round_trip(docs).collect()}
    encoded = tree_bpe.encode_documents(docs)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    back = {r.doc_id: r.text for r in tree_bpe.decode_documents(encoded).collect()}
    assert len(found) == len(ids) == len(back) == len(texts)
    for i, text in enumerate(texts):
        want = coder.encode(text or "", add_special_tokens=False).ids
        said = coder.decode(want, skip_special_tokens=False)
        assert ids[i] == want and back[i] == said, (i, (text or "")[:40])
        assert found[i].n_tokens == len(want)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_ids_that_are_no_text_decode_as_the_library_does(draw):
    coder, own = tokenizer(), tree_bpe.Encoder()
    for _ in range(200):
        ids = [draw.randrange(50257) for _ in range(draw.randrange(12))] + [own.vocabulary.byte_ids[draw.randrange(256)].item() for _ in range(4)]
        assert own.decode([np.array(ids, "<u4").tobytes()]) == [coder.decode(ids, skip_special_tokens=False)]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tree_bpe, "REMEMBERED", 50)
    own = tree_bpe.Encoder()
    want = tokenizer()
    for n in range(5):
        said = [" ".join(f"w{n}x{k}" for k in range(30)), "y" * 60]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(said)] == [x.ids for x in want.encode_batch(said, add_special_tokens=False)]
        assert len(own.led) <= 51 and not any(len(x) > tree_bpe.LONGEST for x in own.whole)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tree_bpe.Vocabulary("word_bpe_49k.json")


def test_empty_table_and_null_ids(spark):
    assert tree_bpe.round_trip(documents(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "a b"), ("x", None), ("x", None)], "doc_id string, text string")
    assert sorted((str(r.doc_id), r.n_tokens) for r in tree_bpe.round_trip(rows).collect()) == [("None", 2), ("x", 0), ("x", 0)]
