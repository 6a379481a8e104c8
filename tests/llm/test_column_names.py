"""Columns whose names hold spaces, dots, colons and backticks, through every operator that hands rows on."""

import public_tokenizers
import pytest
from helpers import docs_frame, with_odd_columns

import corpus_pipeline
from tideframe.llm import bpe, exactdedup, linededup, neardup, secrets, toxicity

NAMES = ("my col", "a.b", "a:b", "tick`mark", "row")


@pytest.fixture(scope="module")
def docs(spark):
    frame = docs_frame(spark, ["some words of a text\nand a line", None, "password = abcdefgh12345678"])
    return with_odd_columns(frame, *[n.replace("`", "``") for n in NAMES])


@pytest.mark.parametrize(
    "operator",
    [
        secrets.scan_documents,
        linededup.drop_recurring,
        neardup.drop_duplicates,
        exactdedup.drop_copies,
        lambda docs: toxicity.score_documents(docs, None),
        lambda docs: bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
        lambda docs: corpus_pipeline.drop_lines(docs.sparkSession, docs, ""),
    ],
)
def test_names_are_kept(docs, operator):
    out = operator(docs)
    assert set(docs.columns) <= set(out.columns)
    for row in out.collect():
        assert all(row[n] == "x" for n in NAMES)
