from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import no_documents, odd_documents, odd_rows
from wattloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.ByteBpe(PATH)

ODD = ["  two   spaces ", "\n\n\t x\r\n", "don't I'LL we're 'tis", "<|endoftext|>a<|endoftext|><|endoftext|>", "<|endof", "中文 abc", "a\x1cb\x85c\xa0d e", "é́", "😀😀 12³½", ""]


def library(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own(text: str) -> list[int]:
    return np.frombuffer(OWN.encode([text])[0], "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs", "Cn"]), st.sampled_from("aBs't'ré  \n\n.,1½\xa0"))))
def test_encoding_and_decoding_equal_the_library(text):
    ids = library(text)
    assert own(text) == ids
    assert OWN.decode(OWN.encode([text])[0]) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_all_pairs_of_latin_characters():
    texts = ["".join(f"x{chr(a)}{chr(b)}y{chr(a)} {chr(b)}" for b in range(256)) for a in range(256)]
    for text, found in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own(text) == found.ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert own(text) == library(text)


def test_one_long_piece():
    drawn = random.Random(1)
    text = "".join(drawn.choice("abcdeth") for _ in range(60_000))
    assert own(text) == library(text)
    assert own("a" * 100_000) == library("a" * 100_000)


def test_the_root_is_the_leftmost_least():
    drawn = random.Random(2)
    for n in (1, 2, 3, 7, 64, 65):
        keys = [drawn.randrange(50) for _ in range(n)]
        tree = bpe.PairTree(list(keys), 99)
        for _ in range(100):
            assert tree.root() == min(keys)
            at, key = drawn.randrange(n), drawn.randrange(100)
            keys[at] = key
            tree.set(at, key)


def test_rows_of_trees_equal_single_trees():
    drawn = random.Random(3)
    pieces = sorted({bytes(drawn.choice(b" abcdehinorst") for _ in range(drawn.randrange(1, 33))) for _ in range(800)})
    merged = OWN.merge_all([p.decode() for p in pieces])
    for piece in pieces:
        ids = np.frombuffer(merged[piece.decode()], "<u4").tolist()
        assert ids == OWN.merge(piece) == library(piece.decode())


def test_more_pieces_than_are_kept(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    small = bpe.ByteBpe(PATH)
    for text in ("one two three four", "five six seven eight nine ten", "one " + "x" * 200):
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == library(text)
        assert len(small.pieces) <= 5


def test_broken_and_unknown_ids():
    part = library("\N{MUSICAL SYMBOL G CLEF}")[:1]
    packed = np.array(part, "<u4").tobytes()
    assert OWN.decode(packed) == LIBRARY.decode(part, skip_special_tokens=False)
    assert "\ufffd" in OWN.decode(packed)
    assert OWN.decode(packed + np.array([10**6], "<u4").tobytes()) == OWN.decode(packed)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))


def test_documents(spark):
    docs = odd_documents(spark)
    found = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    expected = [(r[0], r[1] or "") for r in odd_rows()]
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(expected, key=repr)
    for r in found:
        ids = library(r.text)
        assert r.n_tokens == len(ids) and bytes(r.ids) == np.array(ids, "<u4").tobytes()
    empty = bpe.decoded(bpe.encoded(no_documents(spark), PATH), PATH)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "ids", "text"]


def test_null_ids_and_other_columns(spark):
    rows = spark.createDataFrame([("k", None, 1)], "name string, ids binary, text int")
    assert bpe.decoded(rows, PATH).collect() == [("k", None, None)]
    named = spark.createDataFrame([("k", "a b")], "name string, body string")
    assert bpe.encoded(named, PATH, "name", "body").first().name == "k"


def test_query_equals_the_library(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").collect()
    found = {r.doc_id: r for r in queries.op13_bpe(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    texts = [d.text or "" for d in docs]
    for doc, encoding in zip(docs, LIBRARY.encode_batch(texts, add_special_tokens=False), strict=True):
        row = found[doc.doc_id]
        packed = np.array(encoding.ids, "<u4").tobytes()
        text = LIBRARY.decode(encoding.ids, skip_special_tokens=False)
        assert row.n_tokens == len(encoding.ids)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
