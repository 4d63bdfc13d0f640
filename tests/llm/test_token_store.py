from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import no_documents, odd_documents, odd_rows
from wattloom.llm import token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
OWN = token_store.Encoder(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aBs't'éß \n.,<|endoftext|>"))))
def test_encoder_equals_the_library(text):
    assert np.frombuffer(OWN.encode(text), "<u2").tolist() == ids(text)


def test_other_tokenizers_go_through_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    text = "Two  words, don't\n\nsplit <|endoftext|> é"
    found = token_store.Encoder(path).encode(text)
    assert np.frombuffer(found, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    store = token_store.write_store(odd_documents(spark), PATH, 1)
    rows = sorted(token_store.read_store(store).collect(), key=lambda r: r.start)
    expected = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [r[0] for r in expected]
    start, known = 0, sorted(ids(r[1]) + [1] for r in expected)
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    files = {r.file: token_store.TokenFile(store.folder, r.file) for r in rows}
    read = [files[r.file].ids(r.position).tolist() for r in rows]
    assert sorted(read) == known
    for r, own in zip(rows, read, strict=True):
        assert r.n_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        assert files[r.file].doc_id(r.position) == r.doc_id


def test_empty_table(spark):
    store = token_store.write_store(no_documents(spark), PATH, 1)
    assert token_store.read_store(store).collect() == []


def test_a_wrong_dictionary_is_refused(spark, tmp_path):
    store = token_store.write_store(odd_documents(spark), PATH, 1, folder=str(tmp_path / "store"))
    file = store.manifest.first().file
    dictionary = next((tmp_path / "store").glob("*.dictionary"))
    dictionary.write_bytes(dictionary.read_bytes() + b"x")
    with pytest.raises(ValueError, match="another dictionary"):
        token_store.TokenFile(store.folder, file)


def test_the_dictionary_makes_short_documents_smaller(spark):
    import zstandard

    texts = [r[1] for r in odd_rows() if r[1]]
    packed = [OWN.encode(t) for t in texts] * 40
    dictionary = token_store.train_dictionary(packed)
    own = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert len(own.compress(packed[0])) < len(zstandard.ZstdCompressor().compress(packed[0]))
    assert token_store.train_dictionary([]) == b""
    assert token_store.train_dictionary([b"ab"]) == b"ab"
