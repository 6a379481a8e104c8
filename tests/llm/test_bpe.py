"""Byte-level BPE against the tokenizer library, and round trips."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import docs_frame, with_odd_columns
from hypothesis import given, settings
from hypothesis import strategies as st

from tideframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "a", "hello world", "a" * 5000, "the " * 300, "\n\n  x\t", "éß漢字😀", "<|endoftext|>", "1234567890 " * 40, "==" * 200 + "abc" * 33]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return bpe.merge_table(PATH, public_tokenizers.PATTERN)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab e\n1.é", max_size=80)), max_size=6))
def test_any_text(texts, table, library):
    got = [np.frombuffer(ids, "<u4").tolist() for ids in bpe.encode_texts(table, texts, {})]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_table_is_emptied(table, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 20)
    texts = [f"word{i} and some more {i * 7}" for i in range(30)]
    known = {}
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_texts(table, texts, known)] == [library.encode_ordinary(t) for t in texts]


def test_documents(spark, library):
    docs = with_odd_columns(docs_frame(spark, [*TEXTS, "a"]), "row", "ids", "n_tokens")
    found = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in found.collect():
        ids = library.encode_ordinary(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
